"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

OP9_LINE_RUNS = r"""
with lines as (
  select doc_id, pos, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (
    select doc_id, unnest(parts) as line, unnest(range(len(parts))) as pos
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
  )
), losing as (
  select key, max(doc_id) as top from lines where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
), marked as (
  select l.doc_id, l.pos, l.line, g.key is not null and l.doc_id <> g.top as gone
  from lines l left join losing g on l.key = g.key
)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where gone))::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

OP1_GRAPH_NEAR_VECTORS = """
with recursive good as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from good a join good b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.93
), reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
), least as (
  select a, min(b) as b from reach group by a
), counts as (
  select a, count(*) as n from links group by a
)
select e.vec_id, coalesce(c.n, 0)::bigint as n_links,
  coalesce(least(e.vec_id, l.b), e.vec_id) as component_id,
  e.vec_id = coalesce(least(e.vec_id, l.b), e.vec_id) as kept
from embeddings e left join counts c on c.a = e.vec_id left join least l on l.a = e.vec_id
"""

OP3_GRAPH_SEARCH = """
with good as (
  select vec_id, embedding::double[] as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score
  from good q join good c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 20 = 0
), ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
  from scored
)
select * from ranked where rank <= 20
"""

OP12_SKYBAND_DIVERGENCE = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text
  from documents
), words as (
  select row, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from docs
), kept as (
  select lang, term from words group by lang, term having count(distinct row) >= 30
), counts as (
  select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all
), terms as (
  select lang, count(*) as v from kept group by lang
), totals as (
  select g.lang, g.source, coalesce(t.v, 0) as v, coalesce(sum(c.n), 0) as total
  from (select distinct lang, source from docs) g
  left join terms t using (lang) left join counts c on c.lang = g.lang and c.source = g.source
  group by all
), shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) as p
  from totals g join kept k on k.lang = g.lang
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), of_langs as (
  select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (total + 5 * v) as q
  from (select lang, term, sum(n) as n from counts group by all)
  join (select lang, v, sum(total) as total from totals group by all) using (lang)
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from totals a join totals b on a.lang = b.lang and a.source <> b.source
  left join (
    select x.lang, x.source, y.source as other, sum(abs(x.p - y.p)) as value
    from shares x join shares y on x.lang = y.lang and x.term = y.term group by all
  ) s on s.lang = a.lang and s.source = a.source and s.other = b.source
), far as (
  select lang, source, 'term' as part, term as item, (p - q)::bigint as value
  from shares join of_langs using (lang, term) where n > 0 and p > q
)
select lang, source, part, item, value, rank from (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank
  from (from pairs union all from far)
) where part = 'pair' or rank <= 50
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || ({value}), '-')"


def _levels(name: str, levels: int, tree: str) -> str:
    """CTEs of the nodes and runs of 8 on each level of every tree; a tree of one node on a level stays as it is above."""
    steps = []
    for k in range(levels):
        steps.append(f"""{name}_runs{k} as (
  select {tree}, i // 8 as run, list(node order by i) as nodes, max(n) as n from {name}{k} group by {tree}, i // 8
), {name}{k + 1} as (
  select {tree}, run as i, case when n > 1 then sha256(array_to_string(nodes, '')) else nodes[1] end as node, (n + 7) // 8 as n
  from {name}_runs{k}
)""")
    return ", ".join(steps)


def _climb(start: str, name: str, levels: int, tree: str) -> str:
    """CTEs that lead rows of (tree, i, siblings, folded) up a tree: siblings collected, folded digests recomputed."""
    steps = []
    for k in range(levels):
        steps.append(f"""{name}_up{k + 1} as (
  select u.* exclude (i, siblings, folded), u.i // 8 as i,
    case when r.n > 1 then siblings || array_to_string(list_concat(nodes[1:u.i % 8], nodes[u.i % 8 + 2:]), '') else siblings end as siblings,
    case when r.n > 1 then sha256(array_to_string(list_concat(nodes[1:u.i % 8], [folded], nodes[u.i % 8 + 2:]), '')) else folded end as folded
  from {start if k == 0 else f"{name}_up{k}"} u join {name}_runs{k} r on u.{tree} = r.{tree} and u.i // 8 = r.run
)""")
    return ", ".join(steps)


#: Enough for 8 ** 7 documents of a language and 8 ** 3 languages.
OP13_POSTORDER_MANIFEST = f"""
with rows as (
  select doc_id, lang, coalesce('L' || lang, '') as tree,
    sha256({_field("doc_id::varchar")} || {_field("source")} || {_field("lang")} || {_field("n_chars::varchar")} || {_field("text")}) as leaf,
    sha256({_field("doc_id::varchar")} || {_field("source")} || {_field("lang")} || {_field("n_chars::varchar")} ||
      {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) as lowered
  from documents
), leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as n from rows
), lang0 as (
  select tree, i, leaf as node, n from leaves
), {_levels("lang", 7, "tree")},
all0 as (
  select 1 as everything, tree, row_number() over (order by encode(tree)) - 1 as i, node, count(*) over () as n from lang7
), {_levels("all", 3, "everything")},
crcs as (
  select distinct doc_id, xor(4294967295, list_reduce(
    list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
    lambda crc, byte: list_reduce(range(8), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)), 4294967295::bigint)) as crc
  from documents where doc_id is not null
), start as (
  select l.doc_id, l.leaf, l.tree, l.i, '' as siblings, case when c.crc % 3 = 0 then lowered else leaf end as folded
  from leaves l left join crcs c on c.doc_id = l.doc_id
), {_climb("start", "lang", 7, "tree")},
between_trees as (
  select u.doc_id, u.leaf, a.node as subroot, 1 as everything, a.i, u.siblings, u.folded from lang_up7 u join all0 a on a.tree = u.tree
), {_climb("between_trees", "all", 3, "everything")}
select u.doc_id, u.leaf, u.subroot, r.node as root, sha256(u.siblings) as proof_sha256, u.folded as folded_root, u.folded = r.node as verified
from all_up3 u cross join all3 r
"""

ORACLES: dict[str, str] = {
    "op1_graph_near_vectors": OP1_GRAPH_NEAR_VECTORS,
    "op3_graph_search": OP3_GRAPH_SEARCH,
    "op9_line_runs": OP9_LINE_RUNS,
    "op12_skyband_divergence": OP12_SKYBAND_DIVERGENCE,
    "op13_postorder_manifest": OP13_POSTORDER_MANIFEST,
}
