"""Operators over documents against plain Python, on the given tables and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from roadstrata.llm import bpe, common, lang_id, licenses, line_dedup, mixing, sharding, simhash, token_counts
from roadstrata.llm.license_rules import ANCHORS, FAMILIES, GRANT, families
from tests.llm.edges import documents, no_documents, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module", params=["edges", "given"])
def source(request, spark, sf_dir):
    """(DataFrame, rows in Python) of awkward rows and of the given table."""
    if request.param == "edges":
        return documents(spark).cache(), rows()
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df, [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def same(df, wanted):
    assert Counter(tuple(r) for r in df.collect()) == Counter(wanted)


def test_empty_tables(spark):
    empty = no_documents(spark)
    for report in (
        bpe.bpe_report, lang_id.language_report, licenses.license_report, line_dedup.line_report, mixing.mix_report,
        sharding.shard_slots, simhash.simhash_groups, token_counts.token_report, lang_id.keep_identified,
        line_dedup.drop_repeated_lines, mixing.mix_documents, simhash.keep_one,
    ):
        assert report(empty).count() == 0, report


# --- sharding ---


def jump_one(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_is_stable_and_even():
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64) * np.uint64(2)
    for n in (1, 2, 24, 25, 1000):
        assert sharding.jump(keys[:300], n).tolist() == [jump_one(int(k), n) for k in keys[:300]]
    old, new = sharding.jump(keys, 24), sharding.jump(keys, 25)
    assert set(new[old != new]) == {24}
    assert abs((new == 24).mean() - 1 / 25) < 0.01
    assert np.bincount(old).min() > 0.8 * len(keys) / 24


def test_slots(source):
    df, docs = source
    out = sharding.shard_slots(df).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    by_shard, by_id = defaultdict(list), defaultdict(set)
    for r in out:
        by_shard[r.shard].append(r.slot)
        by_id[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in by_id.values())


def test_shards_written_by_key(spark, source, tmp_path):
    df = source[0]
    sharding.write_shards(df.select("doc_id", "text"), "doc_id", str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count()
    assert back.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0


# --- line dedup ---


def lines_by_hand(docs):
    key = lambda line: line.strip(SPACES).translate(LOWER)
    holders = defaultdict(set)
    rank = lambda d: -(1 << 63) if d is None else d
    for d, t, *_ in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(rank(d))
    for d, t, *_ in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 3 or rank(d) == max(holders[key(x)])]
        yield d, t, len(lines), len(lines) - len(kept), "\n".join(kept)


def test_line_report(source):
    df, docs = source
    want = [(d, n, gone, hashlib.sha256(k.encode()).hexdigest()) for d, _, n, gone, k in lines_by_hand(docs)]
    same(line_dedup.line_report(df), want)


def test_dropped_lines_keep_columns(source):
    df, docs = source
    out = line_dedup.drop_repeated_lines(df)
    assert out.columns == df.columns
    same(out.select("doc_id", "text", "n_chars"), [(d, t if t is None else k, None if t is None else len(k)) for d, t, _, _, k in lines_by_hand(docs)])


def test_runs_are_levelled(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for d in range(5):
        runs.add(spark.createDataFrame([(d, 1, 1), (d, d, 2)], "doc long, h1 long, h2 long"))
        assert all(len(level) < 2 for level in runs.levels)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    before = sorted(map(tuple, runs.losing(3).collect()))
    runs.compact()
    assert before == sorted(map(tuple, runs.losing(3).collect())) == [(1, 1, 4)]


def test_runs_are_neither_dealt_nor_sorted_again(spark):
    """Merging runs, and joining a batch with them, reads runs as they lie."""
    runs = line_dedup.LineRuns(spark, 4)
    batch = lambda low: spark.range(low, low + 50).select(F.col("id").alias("doc"), (F.col("id") % 70).alias("h1"), F.col("id").alias("h2"))
    for low in (0, 100, 200):
        runs.add(batch(low))
    assert [len(level) for level in runs.levels] == [1, 1]
    with runs._layout():
        merged = runs.merged(*runs.runs())
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
        joined = runs.told_apart(batch(220))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # The batch is dealt to count its documents and to its buckets, and sorted once.
        assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") <= 2 and plan.count("Sort [") == 1
    # The third batch and two runs: what a run holds only raises its counts.
    known = {(r.h1, r.h2): r.known for r in joined.collect()}
    assert known == {(i % 70, i): i < 250 for i in range(220, 270)}
    runs.add(batch(220))
    assert {r.h2: r.top for r in runs.losing(2).collect()} == {i: i for i in range(220, 250)}
    runs.discard()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_many_rows_without_id_do_not_meet(spark):
    """Rows without doc_id are one document for the law, and each loses its own lines only."""
    lines = [f"A line that is shared by many, number {i}" for i in range(6)]
    docs = [(None, f"{lines[i % 6]}\nown {i}") for i in range(60)] + [(d, "\n".join(lines)) for d in (1, 2, 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    gathered = line_dedup.lost_keys(df).collect()
    assert max(len(r.lost) for r in gathered if r.doc == line_dedup.NO_ID) == 2
    out = line_dedup.drop_repeated_lines(df).collect()
    assert Counter(tuple(r) for r in out) == Counter([*((None, f"own {i}") for i in range(60)), (1, ""), (2, ""), (3, "\n".join(lines))])


# --- SimHash ---


def print_by_hand(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))


def groups_by_hand(codes, bits=4):
    codes = np.array(codes, np.uint64)
    label = list(range(len(codes)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def test_simhash_groups(source):
    df, docs = source
    codes = [print_by_hand(t) for _, t, *_ in docs]
    groups = groups_by_hand(codes)
    least = defaultdict(list)
    for g, (d, *_) in zip(groups, docs, strict=True):
        least[g] += [] if d is None else [d]
    want = [(d, format(c, "016x"), min(least[g], default=None)) for (d, *_), c, g in zip(docs, codes, groups, strict=True)]
    same(simhash.simhash_groups(df), want)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(groups))
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {min(v, default=None) for v in least.values()}


def test_families_larger_than_a_cell(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 64)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 5).astype(np.uint64)
    codes = [int(b) for b in rng.integers(0, 2**63, 300).astype(np.uint64)]
    for b in base:
        for _ in range(150):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            codes.append(int(b) ^ sum(1 << int(f) for f in flips))
    codes = sorted(set(codes))
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x, x) for x in signed], "doc_id long, fp long")
    roots = {r.fp: r.root for r in simhash._groups(table.select("fp"), 4).collect()}
    ours = [roots[s] for s in signed]
    want = groups_by_hand(codes)
    assert len(set(ours)) == len(set(want)) == len(set(zip(ours, want, strict=True)))


def test_gray_order_and_index():
    codes = np.arange(1 << 10, dtype=np.uint64)
    gray = codes ^ (codes >> np.uint64(1))
    assert (simhash.gray_rank(gray) == codes).all()
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 2**20, 3000).astype(np.uint64))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    index = simhash.GrayIndex(codes)
    labels = np.arange(len(codes))
    q, at = index.near(codes, 2, labels, labels, labels)
    assert set(zip(q.tolist(), at.tolist(), strict=True)) == {
        (i, int(j)) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= 2) if j > i
    }


# --- licences ---


def base_by_hand(text):
    words = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]:
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_base(source):
    df, docs = source
    out = licenses.license_report(df)
    same(out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"), [(d, *base_by_hand(t)) for d, t, *_ in docs])
    for r in out.collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base) and (r.score > 0) == bool(r.labels)


LICENSED = {
    "SPDX-License-Identifier: MIT": "mit",
    "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "released under the GNU Lesser General Public License version 2.1 or any later version": "gpl,lgpl-2.1",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "under the Mozilla Public License 2.0": "mpl",
    "Distributed under the Boost Software License, Version 1.0": "bsl-1.0",
    "CC BY-NC-SA 4.0": "cc-by,cc-by-nc-sa",
    "licensed under CC BY 4.0": "cc-by",
    "https://creativecommons.org/publicdomain/zero/1.0/": "cc0-1.0",
    "simplified BSD license": "bsd-2-clause",
    "the license of the house is not given": "",
    "a permit for fishing, mit freundlichen": "",
    "Copyright (c) 2019-2021 Somebody. All Rights Reserved": "all-rights-reserved,copyright-notice,reserved",
    "MIT License or ISC license; zlib license": "isc,mit,zlib",
}


def test_license_rules(spark):
    df = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_report(df).collect()}
    assert got == dict(enumerate(LICENSED.values()))


def test_rules_compile_and_pass_their_gates(spark):
    rules = [(f, r) for f in families() for r in f["rules"]]
    assert len(rules) > 300
    for f, r in rules:
        re.compile(r["pattern"])
    # What the identifiers match in a licence tag passes the family's gate and the anchors.
    assert any(a in " spdx license identifier mit " for a in ANCHORS)
    many = spark.createDataFrame([(0, "MIT license. " * 2000)], "doc_id long, text string")
    assert licenses.license_report(many).first().labels == "mit"


def matched(pattern):
    """All texts that the pattern matches, with every choice of optional parts; what repeats without end stands as a gap, once or not at all."""
    from re import _parser as parser

    def of(items):
        out = [""]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                part = [chr(arg)]
            elif name == "IN":
                part = [chr(c) for kind, v in arg if str(kind) != "CATEGORY" for c in ([v] if str(kind) == "LITERAL" else range(v[0], v[1] + 1))]
                part = part or ["0"]
            elif name == "BRANCH":
                part = [t for branch in arg[1] for t in of(branch)]
            elif name == "SUBPATTERN":
                part = of(arg[3])
            elif name == "ASSERT":
                continue  # the end of a word in a run
            else:
                low, high, what = arg
                assert name in ("MAX_REPEAT", "POSSESSIVE_REPEAT") and low == 0, name
                part = ["", *(of(what) if high == 1 else ["\0"])]
            out = [a + b for a in out for b in part]
        return out

    return of(parser.parse(pattern))


def test_every_text_of_a_family_passes_its_keywords():
    for label, keywords, *regexes in FAMILIES:
        for text in (t for r in regexes for t in matched(r)):
            assert any(k in f" {text} " for k in keywords), (label, text)


def test_every_text_of_a_rule_passes_its_anchors():
    for text in matched(GRANT):
        assert any(a in f" {text} " for a in ANCHORS), text
    for f in families():
        for r in f["rules"]:
            if r["priority"] in (1, 5):
                assert all(any(a in f" {t} " for a in r["anchors"]) for t in matched(r["pattern"][6:-5])), r
            else:
                assert r["anchors"] == (ANCHORS if r["priority"] == 2 else ()), r


GRANTED = {
    "released under MIT": "mit", "distributed under the terms of the Apache 2.0": "apache-2.0", "available under BSD 3-Clause": "bsd-3-clause",
    "published under the MPL 2.0": "mpl", "shared according to UPL 1.0": "upl-1.0", "creative commons zero": "cc0-1.0",
    "creative commons by 4.0": "cc-by", "png reference library version": "libpng", "provided by LGPL 2.1 or later": "lgpl-2.1",
}


def test_grants_without_other_words(spark):
    df = spark.createDataFrame(list(enumerate(GRANTED)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_report(df).collect()}
    assert got == dict(enumerate(GRANTED.values()))


def test_gates_close_no_hit(spark):
    """One text per alternative of every rule gives what the rules give without gates."""
    texts = sorted({
        text
        for _, _, *regexes in FAMILIES
        for form, r in zip(("spdx license identifier", "offered under the", "see", "in"), (regexes[1], *regexes), strict=True)
        for t in {m.split()[0] + str(len(m.split())): m.replace("\0", "") for m in matched(r)}.values()
        for text in (" ".join(x.split()) for x in (f"{form} {t}", f"{t} license"))
    })
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: set(r.labels.split(",")) - {"reserved", ""} for r in licenses.license_report(df).collect()}
    rules = [(f["label"], r["priority"], re.compile(r["pattern"])) for f in families() for r in f["rules"]]
    for i, text in enumerate(texts):
        hits = sorted((p, -m[0].count(" "), m.start(), m.end(), label) for label, p, rule in rules for m in rule.finditer(f" {text} "))
        kept = []
        for h in hits:
            if not any(k[2] <= h[2] and h[3] <= k[3] for k in kept):
                kept.append(h)
        want = {h[4] for h in kept}
        base = {label for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl")) if f" {phrase} " in f" {text} "}
        assert got[i] == want | base, (text, want, got[i])


def test_license_runs_and_hits_of_any_number(spark):
    """Long runs of fillers and years, and very many hits, give what short ones give; a run ends at whole words."""
    texts = [
        "licensed under " + "the " * 2_500_000 + "mit license", "copyright " + "1999 " * 2_000_000, "MIT license. " * 100_000,
        "copyright 1999 20001 and more", "licensed under an apache license", "available under the gnu gpl 2.0", "licensed under the unlicense",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.labels, r.n_words, r.score) for r in licenses.license_report(df).collect()}
    assert got == {
        0: ("mit", 2_500_004, 0.95), 1: ("copyright-notice", 2_000_001, 0.8), 2: ("mit", 200_000, 0.8), 3: ("copyright-notice", 5, 0.8),
        4: ("apache-2.0", 5, 0.95), 5: ("gpl-2.0", 7, 0.95), 6: ("unlicense", 4, 0.95),
    }
    # Many hits that cover one another in all ways.
    rng = np.random.default_rng(4)
    words = ["mit", "license", "the", "gnu", "gpl", "2", "0", "or", "later", "licensed", "under", "general", "public", "apache", "x"]
    mixed = [" ".join(words[i] for i in rng.integers(0, len(words), 4000)) for _ in range(3)]
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.license_report(spark.createDataFrame(list(enumerate(mixed)), "doc_id long, text string")).collect()}
    rules = [(f["label"], r["priority"], re.compile(r["pattern"])) for f in families() for r in f["rules"]]
    for i, text in enumerate(mixed):
        hits = sorted((p, -m[0].count(" "), m.start(), m.end(), label) for label, p, rule in rules for m in rule.finditer(f" {text} "))
        kept = []
        for h in hits:
            if not any(k[2] <= h[2] and h[3] <= k[3] for k in kept):
                kept.append(h)
        assert got[i] == {h[4] for h in kept} | ({"gpl"} if "general public license" in text else set())


SHORT = {
    "SPDX-License-Identifier: MPL-2.0": "mpl", "SPDX-License-Identifier: BSL-1.0": "bsl-1.0", "SPDX-License-Identifier: EPL-2.0": "epl",
    "SPDX-License-Identifier: OFL-1.1": "ofl-1.1", "SPDX-License-Identifier: BUSL-1.1": "busl-1.1", "SPDX-License-Identifier: WTFPL": "wtfpl",
    "licensed under the GPL": "gpl", "gnu gpl license": "gpl", "LGPL license": "lgpl", "LGPL-2.1 licensed": "lgpl-2.1", "license: expat license": "mit",
    "licensed under HPND": "hpnd", "the unlicense": "unlicense",
}


def test_short_identifiers(spark):
    df = spark.createDataFrame(list(enumerate(SHORT)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_report(df).collect()}
    assert got == dict(enumerate(SHORT.values()))


# --- token counts ---


def test_token_counts(source):
    from tokenizers import Tokenizer

    df, docs = source
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t, *_ in docs:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 2048))
    same(token_counts.token_report(df), want)


@pytest.mark.parametrize("text", ["aaaa" * 50, "a" * 999, "<|endoftext|>a<|startoftext|>", "<|endoftext|", "ΑΣ Σ", "don't I'LL", "각é é"])
def test_token_counts_of_odd_texts(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        counter = token_counts.Counter(f.read())
    want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    assert counter.texts([text, text]) == [want, want]


# --- BPE ---


def test_bpe(source, library):
    df, docs = source
    want = []
    for d, t, *_ in docs:
        ids = library.encode_ordinary(t or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((d, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids)))
    got = bpe.bpe_report(df, with_ids=True).collect()
    assert Counter((*r[:4], tuple(r[4])) for r in got) == Counter(want)


def test_bpe_of_small_blocks(spark, library, monkeypatch):
    """Many blocks, words that many blocks share, and gathering in small steps give the same ids."""
    monkeypatch.setattr(bpe, "CHUNK", 7)
    docs = [(i, f"the word {i % 5} and again the word") for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.ids for r in bpe.bpe_report(df, with_ids=True).collect()}
    assert got == {d: library.encode_ordinary(t) for d, t in docs}


def test_each_distinct_word_is_encoded_once(spark, monkeypatch):
    """Over all blocks and all tasks: one call per word, and blocks dealt evenly."""
    docs = [(i, f"the word {i % 50} and again w{i % 7} the word") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    buckets = 16
    dealt = bpe.dealt_words(df, buckets).withColumn("task", F.spark_partition_id()).toPandas()
    assert set(dealt.task) <= set(range(buckets)) and (dealt.bucket.isin([bpe.PAYLOAD]) | (dealt.bucket == dealt.task)).all()
    blocks = dealt[dealt.bucket == bpe.PAYLOAD].groupby("task").size()
    assert blocks.sum() == 40 and blocks.max() <= 3
    calls = Counter()
    monkeypatch.setattr(bpe, "encoder", lambda ranks: lambda word: calls.update([word]) or [1])
    monkeypatch.setattr(bpe, "read_ranks", lambda raw: {})
    ranks = type("Held", (), {"value": b""})
    for _, rows_of_task in dealt.groupby("task"):
        packed = bpe._rows([tuple(r) for r in rows_of_task[["block", "bucket", "data"]].itertuples(index=False)])
        assert sum(batch.num_rows for batch in bpe.encode_packets(ranks)(iter([packed]))) == len(rows_of_task)
    words = {w for _, t in docs for w in regex.findall(public_tokenizers.PATTERN, t)}
    assert calls == Counter(words)


def test_buckets_follow_the_text(spark, monkeypatch):
    df = spark.range(64).selectExpr("id as doc_id", "repeat('word ', 1000) as text")
    few = bpe.bucket_count(df)
    monkeypatch.setattr(bpe, "BYTES_PER_BUCKET", 1000)
    assert few == 16 and bpe.bucket_count(df) == 320 and bpe.bucket_count(df.filter("false")) == 16
    # A width far above the number of words of a block.
    got = bpe.bpe_report(df.unionByName(df.limit(1).withColumn("text", F.lit(None).cast("string")))).collect()
    assert sorted(r.n_tokens for r in got)[0] == 0 and len({r.ids_sha256 for r in got}) == 2 and len(got) == 65


def test_packing_round_trips():
    words = [b"", b"a", b"\xff\x00", "wörd".encode()] * 3
    assert bpe.unpack_words(bpe.pack_words(words)) == words
    arrays = [np.array([], np.uint32), np.array([0, 1, 2**32 - 1], np.uint32)]
    assert all((a == b).all() for a, b in zip(arrays, bpe.unsqueeze(bpe.squeeze(*arrays)), strict=True))


# --- language ---


def test_language(source):
    df, docs = source
    got = lang_id.language_report(df).collect()
    assert len(got) == len(docs)
    by_id = {r.doc_id: r for r in got}
    right = tried = 0
    for d, t, lang, *_ in docs:
        r = by_id[d]
        if d is not None:
            assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
            if not any(c.isalpha() for c in t or ""):
                assert (r.lang_pred, r.score) == ("und", 0.0)
            elif r.held_out and len(docs) > 100:
                tried += 1
                right += r.lang_pred == lang
        assert 0 <= r.score <= 1
    assert right >= 0.97 * tried
    kept = {r.doc_id for r in lang_id.keep_identified(df).select("doc_id").collect()}
    assert kept == {r.doc_id for r in got if r.lang_pred != "und" and r.score >= 0.4}


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "ab", "b", "▁ab", "bb"]
    vocabulary = lang_id.Pieces(sorted(pieces))
    table = np.random.default_rng(2).random((len(pieces) + 2, 2))
    table[-1] = 0

    def total(word, g):
        if not word:
            return 1.0
        out = 0.0
        for n in range(1, len(word) + 1):
            head = word[:n]
            if head in vocabulary.pieces:
                out += table[vocabulary.pieces.index(head), g] * total(word[n:], g)
            elif n == 1:
                out += table[vocabulary.unknown, g] * total(word[n:], g)
        return out

    words = ["▁abba", "▁xbaz", "▁ab", "▁" + "ab" * 30]
    for some, codes in lang_id.by_length(words):
        logs = lang_id.forward(vocabulary.lookup(codes), table)
        for i, row in zip(some, logs, strict=True):
            if len(words[i]) < 10:
                assert np.allclose(row, [math.log(total(words[i], g)) for g in (0, 1)])
            assert np.isfinite(row).all()
    # Expected counts of one word add up to its characters.
    found = vocabulary.lookup(np.array([[ord(c) for c in "▁abba"]], np.uint32))
    counts = lang_id.expected(found, table[:, 0], np.array([2.0]))
    sizes = np.array([*map(len, vocabulary.pieces), 1, 0])
    assert np.isclose((counts * sizes).sum(), 2 * 5)


# --- mixing ---


def targets_by_hand(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, full, target = sum(sizes.values()), {}, {}
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(full.values())
        shares = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if shares[s] > 3 * sizes[s]]
        if not over:
            return {**full, **shares}
        full |= {s: 3 * sizes[s] for s in over}


def test_mix(source):
    df, docs = source
    out = mixing.mix_report(df)
    size = lambda t: len(regex.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, source_of = defaultdict(int), {}
    for d, t, _, s, _ in docs:
        sizes[s] += size(t)
        source_of.setdefault((d, size(t)), set()).add(s)
    target = targets_by_hand(dict(sizes))
    got = out.collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, size(t)) for d, t, *_ in docs)
    taken, most = defaultdict(int), defaultdict(int)
    for r in got:
        s = next(s for s in source_of[r.doc_id, r.size] if sizes[s] == r.source_size)
        assert math.isclose(r.target, target[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken <= 3 * r.size and (r.taken % r.size == 0 if r.size else r.taken == 0)
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    assert all(abs(taken[s] - target[s]) <= 0.5 * most[s] + 1e-6 for s in sizes)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix_report(df.repartition(5)).collect()))


def test_mix_of_documents_repeats_rows(source):
    df, docs = source
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    rows = Counter(tuple(r) for r in df.collect())
    mixed = Counter(tuple(r) for r in out.collect())
    assert set(mixed) <= set(rows) and all(n <= 3 * rows[k] for k, n in mixed.items())
    words = lambda k: len(regex.findall(r"[^\x20\x09-\x0D]+", k[1] or ""))
    sizes, taken, most, copies = Counter(), Counter(), Counter(), Counter()
    for k, n in rows.items():
        sizes[k[3]] += n * words(k)
        most[k[3]] = max(most[k[3]], words(k))
    for k, n in mixed.items():
        taken[k[3]] += n * words(k)
        copies[k[0], words(k)] += n * bool(words(k))
    target = targets_by_hand(sizes)
    assert all(abs(taken[s] - target[s]) <= 0.5 * most[s] + 1e-6 for s in sizes)
    # The documents are taken as often as the report says.
    told = Counter()
    for r in mixing.mix_report(df).collect():
        told[r.doc_id, r.size] += r.taken // r.size if r.size else 0
    assert +copies == +told


def test_mix_tells_nulls_apart(spark):
    alike = [(1, "x", None, "s", 1), (1, None, "x", "s", 1), (1, "x", "x", None, None), (1, "x", "x", "s", None), (None, "x", "x", "s", 1)]
    df = spark.createDataFrame(alike, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = Counter(tuple(r) for r in mixing.mix_documents(df).collect())
    assert set(mixed) <= set(alike) and max(mixed.values()) <= 3
    # A row of one word is taken once or not at all where its source's target is its size.
    one = df.filter("source = 's'").limit(2)
    assert Counter(tuple(r) for r in mixing.mix_documents(one).collect()) == Counter(tuple(r) for r in one.collect())


def test_very_many_equal_rows(spark):
    same_row = spark.range(2_000_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    out = sharding.shard_slots(same_row).agg(F.count("*"), F.min("slot"), F.max("slot"), F.countDistinct("slot")).first()
    assert tuple(out) == (2_000_000, 0, 1_999_999, 2_000_000)
    assert mixing.mix_documents(same_row).count() == 2_000_000
    numbers = common.repeated(spark.range(1), F.lit(200_000), "n", F.lit(5).cast("long")).agg(F.count("*"), F.min("n"), F.max("n")).first()
    assert tuple(numbers) == (200_000, 5, 200_004)


def test_pivots_keep_the_mean_and_the_total(spark):
    units = spark.range(3000).select("id", F.lit("s").alias("source"), (F.col("id") % 50 + 1).alias("size"))
    total = sum(i % 50 + 1 for i in range(3000))
    targets = spark.createDataFrame([("s", total, 3000, 0.3 * total)], "source string, source_size long, n long, target double")
    for seed in (1, 2, 3):
        got = mixing.rounded_copies(units, targets, seed).collect()
        assert {r.copies for r in got} == {0, 1}
        assert abs(sum(r.size * r.copies for r in got) - 0.3 * total) <= 25
        # Long and short documents are taken alike.
        for low in range(0, 50, 10):
            some = [r.copies for r in got if low < r.size <= low + 10]
            assert abs(sum(some) / len(some) - 0.3) < 0.08
