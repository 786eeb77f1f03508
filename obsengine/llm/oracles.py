"""DuckDB SQL for the queries of this package that SQL can express."""

OP2 = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select a.vec_id as a, b.vec_id as b
  from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_dot_product(a.e, b.e)
    / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach as (
  select vec_id as a, vec_id as b from embeddings
  union
  select r.a, p.b from reach r join pairs p on r.b = p.a)
select c.vec_id, coalesce(n.n_links, 0) as n_links, c.component_id,
  c.vec_id = c.component_id as kept
from (select a as vec_id, min(b) as component_id from reach group by a) c
left join (select a, count(*) as n_links from pairs group by a) n on n.a = c.vec_id
"""

OP9 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w
  from documents),
grams as (
  select doc_id, unnest(case
    when len(w) >= 5 then list_distinct(
      list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as gram
  from words),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from grams a join grams b on a.gram = b.gram and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id),
pairs as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 9 * common.n >= 4 * (x.n + y.n)),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, p.b from reach r join pairs p on r.b = p.a)
select c.doc_id, c.class_id, coalesce(n.n_links, 0) as n_links, c.doc_id = c.class_id as kept
from (select a as doc_id, min(b) as class_id from reach group by a) c
left join (select a, count(*) as n_links from pairs group by a) n on n.a = c.doc_id
"""

OP4 = r"""
with docs as (
  select doc_id, lang, source,
    case try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4
      when 0 then 'web' when 1 then 'books' when 2 then 'code' when 3 then 'news' end as domain,
    len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]+')) as n_tokens
  from documents),
leaves as (
  select domain, lang, source, sum(n_tokens) as available, 3 * sum(n_tokens) as capacity,
    case domain when 'web' then 4 when 'books' then 3 when 'code' then 2 else 1 end as dw,
    case lang when 'en' then 5 when 'de' then 2 when 'fr' then 2 else 1 end as lw
  from docs where n_tokens > 0 group by domain, lang, source),
{domains},
{langs},
{sources},
chosen as (
  select d.*, l.available, s.got // l.available as epochs, s.got % l.available as rest
  from docs d join leaves l using (domain, lang, source) join sources s using (domain, lang, source)
  where d.n_tokens > 0),
whole as (
  select doc_id, domain, lang, source, n_tokens, unnest(range(epochs::bigint)) as epoch,
    n_tokens as taken
  from chosen),
ordered as (
  select *, sum(n_tokens) over (partition by domain, lang, source
      order by md5('1:' || cast(epochs::bigint as varchar) || ':' || cast(doc_id as varchar)), doc_id)
    - n_tokens as start
  from chosen)
select doc_id, domain, lang, source, cast(n_tokens as bigint) as n_tokens,
  cast(epoch as int) as epoch, cast(taken as bigint) as taken from whole
union all
select doc_id, domain, lang, source, n_tokens, cast(epochs as int), cast(least(n_tokens, rest - start) as bigint)
from ordered where start < rest
"""


def _level(name: str, keys: str, weight: str, budget: str, parent: str) -> str:
    """Shares of one level: ``keys`` name a node, ``parent`` its family."""
    family = f"partition by {parent}" if parent else ""
    return f"""{name}_n as (
  select {keys}, sum(capacity) as capacity, any_value({weight}) as weight, any_value(budget) as budget
  from ({budget}) group by {keys}),
{name}_f as (
  select *, capacity * sum(weight) over (w rows between current row and unbounded following)
    <= (budget - coalesce(sum(capacity) over (w rows between unbounded preceding and 1 preceding), 0))
      * weight as filled
  from {name}_n window w as ({family} order by capacity / weight, {keys})),
{name}_p as (
  select *, budget - sum(if(filled, capacity, 0)) over ({family}) as spare,
    sum(if(filled, 0, weight)) over ({family}) as rivals
  from {name}_f),
{name}_q as (
  select *, if(filled, capacity, spare * weight // rivals) as part,
    if(filled, -1, spare * weight % rivals) as remainder
  from {name}_p),
{name} as (
  select {keys}, part + if(not filled and row_number() over (
      {family} order by remainder desc, {keys}) <= budget - sum(part) over ({family}), 1, 0) as got
  from {name}_q)"""


OP4 = (
    OP4.replace(
        "{domains}",
        _level(
            "domains", "domain", "dw",
            "select *, (select cast(floor(sum(available) * 0.6) as hugeint) from leaves) as budget"
            " from leaves", "",
        ),
    )
    .replace(
        "{langs}",
        _level(
            "langs", "domain, lang", "lw",
            "select l.*, d.got as budget from leaves l join domains d using (domain)", "domain",
        ),
    )
    .replace(
        "{sources}",
        _level(
            "sources", "domain, lang, source", "1",
            "select l.*, g.got as budget from leaves l join langs g using (domain, lang)",
            "domain, lang",
        ),
    )
)

OP6 = r"""
with counts as (
  select doc_id, source, lang, text,
    len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]+')) as spaced,
    len(regexp_extract_all(text, '[^ \t\n\r\f\x0B.,!?]+|[.,!?]')) as marked,
    len(regexp_extract_all(text, '[0-9]')) as digits,
    row_number() over (partition by text order by doc_id) as turn
  from documents)
select source, lang, 'spaced-1' as version, count(*) as n_docs, cast(sum(spaced) as bigint) as n_tokens
from counts where turn = 1 group by source, lang
union all
select source, lang, 'marked-1', count(*), cast(sum(marked + digits) as bigint)
from counts where turn = 1 group by source, lang
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text (polynomial 0xEDB88320, bit by bit)."""
    byte = (
        "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],"
        " lambda s, z: xor(s >> 1, (s & 1) * 3988292384))"
    )
    codes = f"list_transform(string_split({text}, ''), lambda x: cast(ascii(x) as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {byte}), 4294967295)"


#: Levels of the trees below; enough for 8^8 leaves a tree.
_MERKLE_LEVELS = 8


def _merkle_level(tree: str, k: int) -> str:
    """Nodes of level k + 1 from those of level k, while a tree has several."""
    return f"""
{tree}{k + 1} as (
  select g, p // 8 as p, case when n > 1 then sha256(string_agg(h, '' order by p)) else any_value(h) end as h,
    (n + 7) // 8 as n
  from {tree}{k} group by g, p // 8, n)"""


def _merkle_beside(tree: str, k: int) -> str:
    """Siblings at level k of every node there, and what the altered node of a leaf would be."""
    return f"""
{tree}s{k} as (
  select a.g, a.p, coalesce(string_agg(b.h, '' order by b.p) filter (where b.p < a.p), '') as l,
    coalesce(string_agg(b.h, '' order by b.p) filter (where b.p > a.p), '') as r, a.n
  from {tree}{k} a join {tree}{k} b on a.g = b.g and a.p // 8 = b.p // 8 group by a.g, a.p, a.n)"""


def _merkle_up(k: int) -> str:
    """Ways of leaves one level up their tree, then up the top tree."""
    tree, at = ("t", k) if k < _MERKLE_LEVELS else ("u", k - _MERKLE_LEVELS)
    g, p = ("w.g", "w.p") if tree == "t" else ("''", "w.p")
    after = k + 1 == _MERKLE_LEVELS
    return f"""
w{k + 1} as (
  select w.doc_id, w.leaf, w.g, {"x.p" if after else "w.p // 8"} as p, proof || s.l || s.r as proof,
    case when s.n > 1 then sha256(s.l || f || s.r) else f end as f
  from w{k} w join {tree}s{at} s on s.g = {g} and s.p = {p}{" join tops x on x.g = w.g" if after else ""})"""


OP11 = f"""
with d as (
  select *, case when lang is null then '' else '=' || lang end as g,
    case when {_crc32("coalesce(cast(doc_id as varchar), '')")} % 3 = 0 then translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as later
  from documents),
fields as (
  select doc_id, g, later, text,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as start
  from d),
leaves as (
  select doc_id, g, sha256(start || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(start || coalesce(strlen(later) || ':' || later, '-')) as f
  from fields),
placed as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as p,
    count(*) over (partition by g) as n
  from leaves),
t0 as (select g, p, leaf as h, n from placed),
{",".join(_merkle_level("t", k) for k in range(_MERKLE_LEVELS))},
tops as (
  select g, h, row_number() over (order by g) - 1 as p, count(*) over () as n
  from t{_MERKLE_LEVELS}),
u0 as (select '' as g, p, h, n from tops),
{",".join(_merkle_level("u", k) for k in range(3))},
{",".join(_merkle_beside("t", k) for k in range(_MERKLE_LEVELS))},
{",".join(_merkle_beside("u", k) for k in range(3))},
w0 as (select doc_id, leaf, g, p, '' as proof, f from placed),
{",".join(_merkle_up(k) for k in range(_MERKLE_LEVELS + 3))}
select w.doc_id, w.leaf, x.h as subroot, r.h as root, sha256(w.proof) as proof_sha256,
  w.f as folded_root, w.f = r.h as verified
from w{_MERKLE_LEVELS + 3} w join tops x on x.g = w.g cross join u3 r
"""

OP12 = f"""
with turns as (
  select conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as key,
    length(coalesce(text, '')) as n, turn
  from conversations where conv_id is not null),
own as (
  select *, row_number() over (partition by conv_id order by turn nulls first, key) as pos from turns),
convs as (
  select conv_id, conv_id - conv_id % 100 as base, {_crc32("cast(conv_id as varchar)")} % 6 as h
  from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, 0 as part, o.pos, o.key, o.n
  from convs c join own o on o.conv_id = c.base and o.pos <= c.h
  union all
  select c.conv_id, 1, o.pos, o.key, o.n
  from convs c join own o on o.conv_id = c.conv_id and o.pos > c.h),
ways as (
  select conv_id, row_number() over (partition by conv_id order by part, pos) as depth,
    string_agg(key, '') over (partition by conv_id order by part, pos) as way, n
  from rebuilt
  union all
  select conv_id, 0, '', 0 from convs),
ends as (select conv_id, arg_max(way, depth) as way from ways group by conv_id),
hashed as (
  select way, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends_sha256
  from ends group by way),
nodes as (
  select way, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(n) as n,
    case when depth > 0 then left(way, 32 * (depth - 1)) end as up
  from ways group by way, depth),
children as (select up, count(*) as n_children from nodes where up is not null group by up),
full_nodes as (
  select x.*, coalesce(c.n_children, 0) as n_children
  from nodes x left join children c on c.up = x.way),
spread as (
  select unnest(list_transform(range(0, depth + 1), lambda d: left(way, 32 * d))) as way,
    case when n_children = 0 then 1 else 0 end as leaf, (n_convs - 1) * n as saved
  from full_nodes),
sums as (select way, sum(leaf) as n_leaves, sum(saved) as saved_tokens from spread group by way)
select x.conv_id, cast(x.depth as bigint) as depth, p.conv_id as parent_conv_id, x.n_convs,
  x.n_children, cast(s.n_leaves as bigint) as n_leaves,
  cast(s.saved_tokens as bigint) as saved_tokens, coalesce(e.ends_sha256, sha256('')) as ends_sha256
from full_nodes x join sums s on s.way = x.way
left join nodes p on p.way = x.up left join hashed e on e.way = x.way
"""

ORACLES: dict[str, str] = {
    "op2_embeddings": OP2,
    "op4_mixing": OP4,
    "op6_rollup": OP6,
    "op9_jaccard": OP9,
    "op11_merkle": OP11,
    "op12_trie": OP12,
}
