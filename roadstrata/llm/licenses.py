"""License scans by ordered signature rules. Built-in functions only.

The text becomes lower-case words with one space between them. Two gates keep the regexes off most texts: each family's
keywords, then the rule's anchors. Both hold for all that the regexes can match. Hits are intervals of words; in order of priority, and the longer
first, a hit that lies inside one accepted before is suppressed.

Hits become rows, a document's own by windows: where they stand is a running sum of the words before them, and what lies inside
another is seen from the furthest end so far. So the work grows with the hits and not with their square.
"""

from __future__ import annotations

import string
from itertools import count

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstrata.llm.license_rules import families

#: Phrases that always count, and their labels. Fixed values.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: What lies between words. Fixed value.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Set before and after a hit; no word holds it.
MARK = "\x01"


def word_line(text: Column) -> Column:
    """The text's words, one space before, between and after them."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    spaced = F.trim(F.regexp_replace(lower, BETWEEN, " "))
    return F.concat(F.lit(" "), spaced, F.when(spaced == "", F.lit("")).otherwise(F.lit(" ")))


def spaces(piece: str) -> str:
    return f"(length({piece}) - length(replace({piece}, ' ', '')))"


def _base_places(phrase: str) -> Column:
    """struct(n, first, last) of the places where the phrase's words stand; no phrase overlaps itself."""
    size = len(phrase.split())
    found = f"""
      element_at(transform(array(split(line, '(?<= ){phrase}(?= )', -1)), s -> named_struct(
        'n', cast(size(s) - 1 as bigint),
        'first', cast({spaces("element_at(s, 1)")} - 1 as bigint),
        'last', cast(n_words - ({spaces("element_at(s, -1)")} - 1) - {size} as bigint))), 1)
    """
    nothing = "named_struct('n', 0L, 'first', cast(null as bigint), 'last', cast(null as bigint))"
    return F.expr(f"if(contains(line, ' {phrase} '), {found}, {nothing})")


def _sql(value: str | int | float) -> str:
    """A literal."""
    if not isinstance(value, str):
        return repr(value) if isinstance(value, int) else f"{value!r}D"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _contains_any(texts) -> str:
    return "(" + " or ".join(f"contains(line, {_sql(t)})" for t in texts) + ")"


def numbered_rules() -> list[dict]:
    """The rules of all families in order, each with its family's label."""
    return [{"label": f["label"], **r} for f in families() for r in f["rules"]]


def _hits() -> Column:
    """Per rule that hits: its number and the spaces in each piece of the line, pieces between hits and hits in turn.

    Each rule is an expression of its own, so a task compiles its regex once; it is met only if its family's keywords are there.
    """
    mark, each, number = _sql(MARK), [], count()
    for f in families():
        rules = []
        for r in f["rules"]:
            marked = f"regexp_replace(line, {_sql(r['pattern'])}, {_sql(MARK + '$0' + MARK)})"
            hit = (
                f"named_struct('rule', {next(number)}, 'spaces', "
                f"transform(split({marked}, {mark}, -1), p -> length(p) - length(replace(p, ' '))))"
            )
            rules.append(f"if({_contains_any(r['anchors'])}, {hit}, null)" if r["anchors"] else hit)
        each.append(f"if({_contains_any(f['keywords'])}, array({', '.join(rules)}), null)")
    return F.expr(f"filter(flatten(filter(array({', '.join(each)}), f -> f is not null)), h -> size(h.spaces) > 1)")


def _of_rule(rules: list[dict], name: str) -> Column:
    return F.expr(f"element_at(array({', '.join(_sql(r[name]) for r in rules)}), rule + 1)")


def _accepted(found: DataFrame, keys: list[str], rules: list[dict]) -> DataFrame:
    """`found`, with a row per hit of each document (`row`), or one without a label: label and confidence of accepted hits, else null."""
    pieces = found.select("*", F.posexplode_outer("hit.spaces").alias("nth", "n"), F.col("hit.rule").alias("rule"))
    # All that follows needs a document's rows together, and nothing else.
    pieces = pieces.select(*keys, "rule", "nth", "n").repartition("row")
    before = Window.partitionBy("row", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("n").over(before) - 1
    hits = pieces.withColumn("start", start).filter("nth is null or nth % 2 = 1").withColumns(
        {"end": F.col("start") + F.col("n") + 1, **{name: _of_rule(rules, name) for name in ("label", "priority", "confidence")}}
    )
    # What begins before a hit, or with it and is longer or comes first, covers it if it ends no earlier.
    earlier = (
        Window.partitionBy("row").orderBy("start", F.desc("end"), "priority", "label", "confidence", "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    levels = sorted({r["priority"] for r in rules})
    furthest = {f"end_{p}": F.max(F.when(F.col("priority") <= p, F.col("end"))).over(earlier) for p in levels}
    covered = F.lit(False)
    for p in levels:
        covered |= (F.col("priority") == p) & F.coalesce(F.col(f"end_{p}") >= F.col("end"), F.lit(False))
    seen = hits.withColumns(furthest).withColumn("kept", F.col("start").isNotNull() & ~covered)
    return seen.select(*keys, *[F.when(F.col("kept"), F.col(c)).alias(c) for c in ("label", "confidence")])


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Whole texts (null: empty), A-Z in lower case; words are runs of digits, letters and what is not ASCII. n_base counts all
    places of the BASE phrases, first_word and last_word are the smallest and largest start of one, null if there is none.
    labels adds those of the accepted rule hits; both lists are distinct, sorted and comma-joined, empty if there are none. score is
    the confidence of the surest detection, 1 for a BASE phrase, 0 without any.

    Texts are scanned where they are read; what is shuffled, by document, is a number per piece between hits. A document with very many hits
    is one sorted group of such numbers. Extra columns are not used, equal rows each give their row.
    """
    lines = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), word_line(F.col("text")).alias("line")
    )
    counted = lines.withColumn("n_words", F.expr(f"cast({spaces('line')} - 1 as bigint)"))
    based = counted.withColumns({f"base_{i}": _base_places(phrase) for i, (phrase, _) in enumerate(BASE)})
    each = [F.col(f"base_{i}") for i in range(len(BASE))]
    own = F.array_compact(F.array(*[F.when(c["n"] > 0, F.lit(label)) for c, (_, label) in zip(each, BASE, strict=True)]))
    rules = numbered_rules()
    found = based.select(
        "row",
        "doc_id",
        "n_words",
        sum((c["n"] for c in each[1:]), each[0]["n"]).alias("n_base"),
        F.least(*[c["first"] for c in each]).alias("first_word"),
        F.greatest(*[F.when(c["n"] > 0, c["last"]) for c in each]).alias("last_word"),
        own.alias("own"),
        F.explode_outer(_hits()).alias("hit"),
    )
    keys = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "own"]
    each_document = _accepted(found, keys, rules).groupBy("row").agg(
        *[F.first(c).alias(c) for c in keys[1:]], F.collect_set("label").alias("more"), F.max("confidence").alias("surest")
    )
    return each_document.select(
        *keys[1:-1],
        F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", "more")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("surest", F.lit(0.0))).alias("score"),
    )
