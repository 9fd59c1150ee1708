"""A static range asymmetric numeral coder for arrays of symbols, many states at once.

A block's symbols are dealt to LANES states in turn (symbol i goes to lane i mod LANES); all lanes of all blocks at hand
take a step together, as array operations. A block's words lie in the order its decoder reads them, step by step, lane by
lane. Every STRIDE steps the states and the place in the words are kept: a checkpoint, from which decoding can begin, so the
runs between checkpoints decode side by side too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols' frequencies sum to 2 ** BITS.
BITS = 20
LANES = 64
#: Symbols of a block at most, and steps between checkpoints.
BLOCK = 65_536
STRIDE = 256
#: States lie in [LOW, LOW * 2 ** 32) between symbols; words have 32 bits.
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)


def frequencies(counts: dict[int, int], bits: int = BITS) -> dict[int, int]:
    """Frequencies of sum 2 ** `bits` in about the proportion of `counts`, none below 1. Symbols that do not occur have none."""
    counts = {s: n for s, n in sorted(counts.items()) if n > 0}
    if len(counts) > 1 << bits:
        raise ValueError(f"{len(counts)} symbols do not fit into 2 ** {bits} slots")
    total = sum(counts.values())
    shares = {s: max(1, (n << bits) // total) for s, n in counts.items()}
    over = sum(shares.values()) - (1 << bits)
    for s in sorted(counts, key=lambda s: (-counts[s], s)) if counts else []:
        if over <= 0:
            shares[s] -= over  # what rounding down has left over, or nothing
            break
        taken = min(over, shares[s] // 2)
        shares[s] -= taken
        over -= taken
    return shares


class Table:
    """Frequencies as arrays by symbol and by slot."""

    def __init__(self, shares: dict[int, int], bits: int = BITS):
        if shares and sum(shares.values()) != 1 << bits:
            raise ValueError(f"frequencies do not sum to 2 ** {bits}")
        symbols = np.array(sorted(shares), np.int64)
        sizes = np.array([shares[s] for s in symbols.tolist()], np.int64)
        self.bits = np.uint64(bits)
        width = int(symbols[-1]) + 1 if len(symbols) else 1
        self.freq, self.below = np.zeros(width, np.uint64), np.zeros(width, np.uint64)
        self.freq[symbols] = sizes
        self.below[symbols] = np.cumsum(sizes) - sizes
        self.at_slot = np.repeat(symbols, sizes).astype(np.int32)


@dataclass
class Block:
    """One coded block. states and places have a row per checkpoint; places count words from the block's first."""

    n: int
    states: np.ndarray
    places: np.ndarray
    words: np.ndarray


def encode(blocks: list[np.ndarray], table: Table, lanes: int = LANES, stride: int = STRIDE) -> list[Block]:
    """Each array of symbols as a block of its own."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    steps = -(-int(sizes.max(initial=0)) // lanes)
    symbols = np.zeros((len(blocks), steps * lanes), np.int32)
    for row, block in zip(symbols, blocks, strict=True):
        row[: len(block)] = block
    symbols = np.ascontiguousarray(symbols.reshape(len(blocks), steps, lanes).swapaxes(0, 1))
    if symbols.size and (table.freq[symbols] == 0).any():
        for block in blocks:
            if len(block) and (table.freq[block] == 0).any():
                raise ValueError("a symbol has no frequency")
    x = np.full((len(blocks), lanes), LOW, np.uint64)
    words = np.empty((steps, len(blocks), lanes), np.uint32)
    sent = np.zeros((steps, len(blocks), lanes), bool)
    states = np.empty((max(1, -(-steps // stride)), len(blocks), lanes), np.uint64)
    states[0] = x
    lane = np.arange(lanes)
    room = np.uint64(63) - table.bits
    for t in range(steps - 1, -1, -1):
        live = t * lanes + lane < sizes[:, None]
        s = symbols[t]
        freq = np.where(live, table.freq[s], np.uint64(1))
        out = live & (x >= freq << room)
        words[t], sent[t] = x, out  # the lower 32 bits
        x = np.where(out, x >> WORD, x)
        quotient, rest = np.divmod(x, freq)
        x = np.where(live, (quotient << table.bits) + rest + table.below[s], x)
        if t % stride == 0:
            states[t // stride] = x
    coded = []
    for b, n in enumerate(sizes.tolist()):
        runs = max(1, -(-(-(-n // lanes)) // stride))
        each = sent[:, b].sum(axis=1)
        places = np.append(0, np.cumsum(each))[np.arange(runs) * stride]
        coded.append(Block(n, states[:runs, b].copy(), places.astype(np.int32), words[:, b][sent[:, b]]))
    return coded


def decode(blocks: list[Block], table: Table, lanes: int = LANES, stride: int = STRIDE) -> list[np.ndarray]:
    """The symbols of each block, all runs between checkpoints side by side."""
    run = stride * lanes
    sizes = [min(run, b.n - i * run) for b in blocks for i in range(len(b.states))]
    if not sizes:
        return []
    x = np.concatenate([b.states for b in blocks])
    shift = np.cumsum([0, *(len(b.words) for b in blocks)])
    place = np.concatenate([b.places + at for b, at in zip(blocks, shift[:-1].tolist(), strict=True)]).astype(np.int64)
    words = np.append(np.concatenate([b.words for b in blocks]), np.uint32(0)).astype(np.uint64)
    size, lane = np.array(sizes), np.arange(lanes)
    steps = -(-int(size.max()) // lanes)
    symbols = np.zeros((steps, len(size), lanes), np.int32)
    mask = np.uint64((1 << int(table.bits)) - 1)
    for t in range(steps):
        live = t * lanes + lane < size[:, None]
        slot = x & mask
        s = table.at_slot[slot.view(np.int64)]
        symbols[t] = s
        x = np.where(live, table.freq[s] * (x >> table.bits) + slot - table.below[s], x)
        low = live & (x < LOW)
        order = low.cumsum(axis=1)
        at = np.where(low, place[:, None] + order - 1, len(words) - 1)
        x = np.where(low, (x << WORD) | words[at], x)
        place += order[:, -1]
    flat = symbols.swapaxes(0, 1).reshape(len(size), steps * lanes)
    pieces, out = iter(zip(flat, sizes, strict=True)), []
    for b in blocks:
        out.append(np.concatenate([row[:n] for row, n in (next(pieces) for _ in range(len(b.states)))]))
    return out


def _times(matrix: list[int], vector: int) -> int:
    total, i = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


def crc32_join(first: int, second: int, length: int) -> int:
    """The CRC-32 of two byte strings one after the other, from theirs and the second one's length.

    Appending a zero bit is a linear map of the register; the map for `length` bytes comes by squaring.
    """
    shift = [0xEDB88320, *(1 << i for i in range(31))]
    for _ in range(3):  # eight bits
        shift = [_times(shift, column) for column in shift]
    while length:
        if length & 1:
            first = _times(shift, first)
        shift = [_times(shift, column) for column in shift]
        length >>= 1
    return first ^ second
