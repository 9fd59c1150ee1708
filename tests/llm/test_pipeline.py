"""The pipeline, stage by stage against plain Python."""

from collections import Counter

import corpus_pipeline
from roadstrata.llm import lang_id, mixing
from tests.llm.edges import documents
from tests.llm.test_documents import groups_by_hand, lines_by_hand, print_by_hand, targets_by_hand


def test_stages(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = [tuple(r) for r in docs.collect()]
    told = {r.doc_id for r in lang_id.language_report(docs).filter("lang_pred <> 'und' and score >= 0.4").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        rows = [tuple(r) for r in out.collect()]
        if name == "language_id":
            assert Counter(rows) == Counter(r for r in kept if r[0] in told)
        elif name == "line_dedup":
            assert Counter((r[0], r[1]) for r in rows) == Counter((d, k) for d, _, _, _, k in lines_by_hand(kept))
        elif name == "simhash_dedup":
            groups = groups_by_hand([print_by_hand(r[1]) for r in kept])
            least = {}
            for g, r in zip(groups, kept, strict=True):
                least[g] = min(r, least.get(g, r))
            assert Counter(rows) == Counter(least.values())
        elif name == "source_mix":
            words = lambda t: len(t.split())
            sizes, taken, most = Counter(), Counter(), Counter()
            for r in kept:
                sizes[r[3]] += words(r[1])
                most[r[3]] = max(most[r[3]], words(r[1]))
            for r in rows:
                taken[r[3]] += words(r[1])
            target = targets_by_hand(dict(sizes))
            assert set(rows) <= set(kept)
            assert all(abs(taken[s] - target[s]) <= 0.5 * most[s] + 1e-6 for s in sizes)
            assert max(Counter(rows).values()) <= 3
            told = {r.doc_id: r.taken // r.size for r in mixing.mix_report(docs).filter("taken > 0").collect()}
            assert Counter(r[0] for r in rows if words(r[1])) == Counter(told)
        else:
            assert Counter((r[0], tuple(r[-1])) for r in rows) == Counter((r[0], tuple(library.encode_ordinary(r[1]))) for r in kept)
            continue
        assert out.columns == columns
        # Each stage gets what the one before has written.
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        kept = [tuple(r) for r in docs.collect()]


def test_awkward_rows_pass_all_stages(spark, sf_dir):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() > 0
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
