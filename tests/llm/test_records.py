"""Token files, source divergence and the dataset manifest against plain Python, on the given tables and on awkward rows."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from roadstrata.llm import divergence, manifest, rans, token_files
from tests.llm.edges import SCHEMA, documents, no_documents, rows
from tests.llm.test_documents import LOWER, same, source  # noqa: F401

# --- the coder ---


def test_frequencies_fill_the_slots():
    assert rans.frequencies({}) == {}
    assert rans.frequencies({7: 3}, 4) == {7: 16}
    rng = np.random.default_rng(1)
    for n in (2, 15, 16):
        shares = rans.frequencies({i: int(c) for i, c in enumerate(rng.integers(1, 10**14, n))}, 4)
        assert sum(shares.values()) == 16 and min(shares.values()) >= 1
    assert sum(rans.frequencies({**{i: 1 for i in range(1000)}, 1000: 10**15}, 10 + 1).values()) == 2048
    with pytest.raises(ValueError):
        rans.frequencies({i: 1 for i in range(17)}, 4)


def test_blocks_round_trip_and_begin_at_checkpoints():
    rng = np.random.default_rng(2)
    symbols = np.minimum(rng.zipf(1.3, 70_000), 5000).astype(np.int64)
    table = rans.Table(rans.frequencies({int(s): int(n) for s, n in zip(*np.unique(symbols, return_counts=True), strict=True)}))
    run = rans.STRIDE * rans.LANES
    sizes = [1, rans.LANES - 1, rans.LANES, rans.LANES + 1, run - 1, run, run + 1, 65_536]
    blocks = [symbols[i : i + n] for i, n in enumerate(sizes)]
    coded = rans.encode(blocks, table)
    for got, want in zip(rans.decode(coded, table), blocks, strict=True):
        assert (got == want).all()
    last = coded[-1]
    assert len(last.states) == 4 and 4 * len(last.words) < 65_536 * 2
    # Decoding begins at any checkpoint with the words from there on.
    at = int(last.places[2])
    tail = rans.Block(last.n - 2 * run, last.states[2:], last.places[2:] - at, last.words[at:])
    assert (rans.decode([tail], table)[0] == blocks[-1][2 * run :]).all()
    assert rans.decode(rans.encode([], table), table) == []
    with pytest.raises(ValueError):
        rans.encode([np.array([4_999_999 % 5000 + 1, 0])], table)
    one = rans.Table(rans.frequencies({3: 9}))
    assert (rans.decode(rans.encode([np.full(1000, 3)], one), one)[0] == 3).all()


def test_checksums_join():
    for a, b in ((b"", b""), (b"a", b""), (b"", b"bc"), (b"some", b"thing" * 4001)):
        assert rans.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


# --- token files ---


@pytest.fixture(scope="module")
def by_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, token_files.END]


def test_encoder_agrees_with_the_library(by_library):
    with open(public_tokenizers.path(token_files.VOCABULARY), "rb") as f:
        encode = token_files.Encoder(f.read(), token_files.END)
    texts = [
        None, "", "  a  b ", "x\x1cy !\x1d! z", "It's THE ’s 'S don't", "İstanbul Σ ΑΣ ﬁ é <|endoftext|>x<|startoftext|>",
        "naïve_co-op 12a3 ß Straße ÿ Ö×÷", " a　b\x85c", "\x00\x01 a\x00b", "µª º² ½ ́a é 中文字 テスト", "x" * 3000, "a<b |c|",
        "[]\\^_`{}~ @?>=<;:/.-,+*)(&%$#\"!",
    ]
    for some in (texts, texts[:3], texts[::-1]):
        ids, sizes = encode(pa.array(some, pa.string()))
        assert sizes.tolist() == [len(by_library(t)) for t in some]
        assert ids.tolist() == [i for t in some for i in by_library(t)]


def test_token_files(source, by_library):  # noqa: F811
    df, docs = source
    out = token_files.token_file_report(df).collect()
    want = Counter((d, tuple(by_library(t))) for d, t, *_ in docs)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == Counter(
        {(d, len(i), zlib.crc32(np.array(i, "<u4"))): n for (d, i), n in want.items()}
    )
    out.sort(key=lambda r: r.start)
    at, ids = 0, [-1 << 63 if r.doc_id is None else r.doc_id for r in out]
    for r in out:
        assert r.start == at
        at += r.n_tokens
    assert ids == sorted(ids)


def test_token_files_hold_the_ids(spark, by_library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "TOGETHER", 2)
    path = str(tmp_path / "files")
    token_files.write_ids(documents(spark), path)
    back = token_files.read_ids(spark, path)
    assert Counter((r.doc_id, tuple(r.ids)) for r in back.collect()) == Counter((d, tuple(by_library(t))) for d, t, *_ in rows())
    # Documents that go over several blocks are there, and damage is noticed.
    long = "word salad with some 7 numbers " * 40_000
    token_files.write_ids(spark.createDataFrame([(1, "a"), (2, long), (3, "b")], "doc_id long, text string").coalesce(1), path + "-2")
    report = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_report(spark, path + "-2").collect()}
    n = len(by_library(long))
    assert n > 3 * rans.BLOCK
    assert report[2] == (2, n, zlib.crc32(np.array(by_library(long), "<u4"))) and report[3][0] == n + 2
    harm = F.concat(F.expr("substring(words, 1, octet_length(words) - 1)"), F.lit(b"x"))
    spark.read.parquet(path + "-2/blocks").withColumn("words", harm).write.parquet(path + "-3/blocks")
    spark.read.parquet(path + "-2/table").write.parquet(path + "-3/table")
    with pytest.raises(Exception, match="damaged"):
        token_files.read_report(spark, path + "-3")


def test_empty_tables(spark):
    assert token_files.token_file_report(no_documents(spark)).count() == 0
    assert divergence.divergence(no_documents(spark)).count() == 0
    assert manifest.manifest_report(no_documents(spark)).count() == 0


# --- source divergence ---

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def divergence_by_hand(docs, documents_):
    held, counts, groups = defaultdict(set), defaultdict(Counter), set()
    for i, (_, text, lang, src, _) in enumerate(docs):
        lang, src = lang or "", src or ""
        groups.add((lang, src))
        for t in TERM.findall((text or "").translate(LOWER)):
            held[lang, t].add(i)
            counts[lang, src][t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (l, t), d in held.items() if l == lang and len(d) >= documents_]
        names = sorted(s for l, s in groups if l == lang)

        def shares(count, total, v):
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in kept}

        every = {s: shares(counts[lang, s], sum(counts[lang, s][t] for t in kept), len(kept)) for s in names}
        both = sum((counts[lang, s] for s in names), Counter())
        q = shares(both, sum(both[t] for t in kept), len(kept))
        for s in names:
            pairs = [(-sum(abs(every[s][t] - every[o][t]) for t in kept), o.encode(), o) for o in names if o != s]
            far = [(q[t] - every[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and every[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(far)[:50])]
    return out


def test_divergence(source, monkeypatch):  # noqa: F811
    df, docs = source
    for rows_per_bucket, k in ((divergence.ROWS, 30), (97, 2)):
        monkeypatch.setattr(divergence, "ROWS", rows_per_bucket)
        monkeypatch.setattr(divergence, "MERGED", 3)
        same(divergence.divergence(df, k), divergence_by_hand(docs, k))


def test_skyband_is_exact():
    rng = np.random.default_rng(3)
    for n, k, top in ((0, 3, 4), (1, 1, 4), (300, 5, 4), (3000, 50, 60), (2500, 1, 9)):
        more, less, name = rng.integers(0, top, n), rng.integers(0, top, n), rng.permutation(n)
        dominated = ((more[:, None] >= more) & (less[:, None] <= less) & (name[:, None] < name)).sum(axis=0)
        assert (divergence.skyband(more, less, name, k) == (dominated < k)).all()


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([0, 1, 10**12, 9 * 10**17])
    assert divergence.shares(counts, 10**18, 7).tolist() == [1 + 10**9 * (int(c) + 5) // (10**18 + 35) for c in counts]
    text = "Aa-b é7É " * 400_000
    assert divergence.terms_of(text.encode()) == {b"aa": 400_000, b"b": 400_000, "é".encode(): 400_000, "É".encode(): 400_000}
    assert divergence.terms_of(b"") == {} and divergence.terms_of(b"x" * 3_000_000) == {b"x" * 3_000_000: 1}


# --- manifest ---


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(doc_id, text, lang, src, n_chars):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(field, (doc_id, src, lang, n_chars, text)))


def tree_by_hand(nodes):
    """(root, each leaf's [(before, after) per level])"""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for leaf, at in enumerate(where):
            run = runs[at // 8]
            paths[leaf].append((run[: at % 8], run[at % 8 + 1 :]))
        where = [at // 8 for at in where]
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def manifest_by_hand(docs):
    by_lang = defaultdict(list)
    for doc_id, text, lang, src, n_chars in docs:
        leaf = leaf_by_hand(doc_id, text, lang, src, n_chars)
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        low = leaf_by_hand(doc_id, text and text.translate(LOWER), lang, src, n_chars) if tampered else leaf
        by_lang[lang].append((doc_id is not None, doc_id or 0, leaf, low, doc_id))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree_by_hand([r[2] for r in sorted(by_lang[x])]) for x in langs}
    root, tops = tree_by_hand([trees[x][0] for x in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        subroot, paths = trees[lang]
        for (_, _, leaf, low, doc_id), path in zip(sorted(by_lang[lang]), paths, strict=True):
            folded = low
            for before, after in path + top:
                folded = h(*before, folded, *after)
            proof = h(*[n for before, after in path + top for n in (*before, *after)])
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return out


@pytest.mark.parametrize("height", [1, 3])
def test_manifest(source, height):  # noqa: F811
    df, docs = source
    report = manifest.manifest_report(df, height)
    wanted = manifest_by_hand(docs)
    # Rows alike in all columns may swap places, and so proofs.
    alike = {d for (d, *_), n in Counter((d, t, a, s, c) for d, t, a, s, c in docs).items() if n > 1}
    same(report.drop("tampered", "log_place").filter(~F.coalesce(F.col("doc_id").isin(list(alike)), F.lit(False))), [r for r in wanted if r[0] not in alike])
    same(report.select("doc_id", "leaf", "subroot", "root", "proof_sha256"), [r[:5] for r in wanted])
    places = sorted(r.log_place for r in report.filter("doc_id is not null").select("log_place").collect())
    assert places[0] >= 0 and places[-1] <= max(manifest.post(i, 0) for i in range(len(docs)))


def test_many_languages_and_one(spark):
    for langs in (1, 9, 70):
        docs = [(i, f"Text {i}", f"l{i % langs:03}", "s", i) for i in range(4 * langs)]
        same(manifest.manifest_report(spark.createDataFrame(docs, SCHEMA), 1).drop("tampered", "log_place"), manifest_by_hand(docs))
    same(manifest.manifest_report(spark.createDataFrame(docs[:1], SCHEMA)).drop("tampered", "log_place"), manifest_by_hand(docs[:1]))


def test_log_positions_are_closed_form():
    for n in (1, 2, 7, 8, 9, 64, 65, 100, 513):
        levels = manifest.levels_for(n)
        leaves = [h(str(i)) for i in range(n)]
        log = manifest.build(leaves, levels)
        segment = manifest.Segment(log, n, levels)
        assert len(log) == 32 * sum(manifest.shape(n, levels))
        nodes = leaves
        for level in range(levels + 1):
            assert [segment.node(level, i) for i in range(len(nodes))] == nodes
            nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        root, paths = tree_by_hand(leaves)
        assert segment.node(levels, 0) == root
        assert all(segment.path(i) == paths[i] and manifest.fold(leaves[i], paths[i]) == root for i in range(0, n, 5))


def test_rows_are_numbered_although_they_are_alike(spark):
    df = spark.range(3000).select(F.lit("a").alias("tree"), F.lit(1).alias("doc_id")).repartition(7)
    out = manifest.numbered(df, "tree", ["doc_id"], "alike").collect()
    assert sorted(r.at for r in out) == list(range(3000)) and {r.leaves for r in out} == {3000}
