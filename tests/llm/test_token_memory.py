"""What the encoder of token files keeps, and how ids are counted."""

import collections

import numpy as np
import public_tokenizers
import pyarrow as pa

from roadstrata.llm import token_files


def test_words_outlive_the_pieces_they_came_in(monkeypatch):
    with open(public_tokenizers.path(token_files.VOCABULARY), "rb") as f:
        encode = token_files.Encoder(f.read(), token_files.END)
    texts = [pa.array(["some (words) again"]), pa.array(["some. words, again!", None, ""])]
    expected = [t.ids for t in encode.library.encode_batch_fast([s or "" for s in texts[1].to_pylist()], add_special_tokens=False)]
    monkeypatch.setattr(token_files, "REMEMBERED", 0)
    learned = []
    plain = encode._plain_words
    monkeypatch.setattr(encode, "_plain_words", lambda words: learned.append(words.to_pylist()) or plain(words))
    encode(texts[0])
    ids, sizes = encode(texts[1])
    assert [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])] == [[*e, token_files.END] for e in expected]
    assert {"some", "words", "again"} <= set(learned[0]) and not {"some", "words", "again"} & {w for some in learned[1:] for w in some}
    # Words have a bound of their own.
    monkeypatch.setattr(token_files, "WORDS", 0)
    encode(texts[0])
    assert {"some", "words", "again"} <= set(learned[-1])


def test_ids_are_counted_over_whole_batches(spark):
    rows = [[1, 2, 2, 60_000], [], None, [2, 7]] * 30
    data = [(None if r is None else bytearray(np.array(r, "<u2").tobytes()),) for r in rows]
    assert token_files.id_counts(spark.createDataFrame(data, "ids binary").repartition(3), 2) == dict(collections.Counter(i for r in rows for i in r or []))
    array = pa.array([None if r is None else np.array(r, "<u2").tobytes() for r in rows], pa.binary())
    for some in (array, array.slice(2, 5), array.slice(1, 2), array.slice(0, 0)):
        assert bytes(token_files._joined(some)) == b"".join(v for v in some.to_pylist() if v)
