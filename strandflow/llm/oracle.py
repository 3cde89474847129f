"""DuckDB SQL that states anew those queries of this subpackage that SQL can express."""

from __future__ import annotations

#: Words of a text; the class is the contract's white space.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

SUBSTRING = f"""with w as materialized (select doc_id, {_WORDS} as words from documents),
s as (select doc_id, unnest(range(len(words) - 19)) as start, words from w where len(words) >= 20),
p as materialized (select doc_id, start, md5(array_to_string(words[start + 1 : start + 20], ' ')) as print from s),
late as materialized (select doc_id, start from p qualify row_number() over (partition by print order by doc_id, start) > 1),
gone as (select distinct doc_id, start + j as at from late, range(20) t(j)),
word as (select doc_id, unnest(range(len(words))) as at, unnest(words) as word from w),
kept as (select word.doc_id, string_agg(word, ' ' order by word.at) as text from word left join gone on gone.doc_id = word.doc_id and gone.at = word.at where gone.at is null group by 1),
n as (select doc_id, count(*) as n_removed from gone group by 1)
select w.doc_id, len(words) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id) left join n using (doc_id)"""

MINHASH = f"""with recursive w as materialized (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words from documents),
s as materialized (select distinct doc_id, array_to_string(words[i + 1 : i + 4], ' ') as shingle from (select doc_id, words, unnest(range(greatest(len(words) - 3, 1))) as i from w where len(words) > 0)),
n as materialized (select doc_id, count(*) as n from s group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
link as materialized (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
edge as materialized (select a as u, b as v from link union all select b, a from link),
reach(u, v) as (select u, u from edge union select reach.u, edge.v from reach join edge on edge.u = reach.v),
root as (select u as doc_id, min(v) as component_id from reach group by 1)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id, coalesce(component_id, doc_id) = doc_id as kept from w left join n using (doc_id) left join root using (doc_id)"""

#: Bytes are pairs of hexadecimal digits here, so that a window may cut a character.
SUFFIX = """with h as materialized (select doc_id, hex(encode(coalesce(text, ''))) as hex, octet_length(encode(coalesce(text, ''))) as n_bytes from documents),
p as materialized (select doc_id, start, md5(substr(hex, 2 * start + 1, 800)) as print from (select doc_id, hex, unnest(range(n_bytes - 399)) as start from h where n_bytes >= 400)),
again as materialized (select doc_id, start from p qualify count(*) over (partition by print) > 1),
runs as (select doc_id, min(start) as a, max(start) + 400 as b from (select doc_id, start, sum(fresh) over (partition by doc_id order by start) as g from
  (select doc_id, start, case when start - lag(start) over (partition by doc_id order by start) <= 400 then 0 else 1 end as fresh from again)) group by doc_id, g),
left_over as (select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as before from runs),
parts as (select h.doc_id, string_agg(substr(hex, 2 * before + 1, 2 * (a - before)), '' order by a) as front, max(b) as last, count(*) as n_spans, sum(b - a) as n_removed from left_over join h using (doc_id) group by 1)
select h.doc_id, n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(front, '') || substr(hex, 2 * coalesce(last, 0) + 1))) as kept_sha256
from h left join parts using (doc_id)"""

HARD_NEGATIVES = """with v as materialized (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as w from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.w, b.w) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, s.vec_id) as rank,
  s.vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10"""

_PART = "case when {0} is null then '-' else cast(octet_length(encode(cast({0} as varchar))) as varchar) || ':' || cast({0} as varchar) end"
_LEAF = lambda n_chars: f"sha256({' || '.join(_PART.format(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"
#: CRC-32 bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
  lambda crc, c: list_reduce(range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(crc, c)), 4294967295), 4294967295)"""

MERKLE = f"""with recursive doc as materialized (select doc_id, coalesce(lang, '') as tree, lang is not null as named, {_LEAF("n_chars")} as leaf,
  case when {_CRC} % 7 = 0 then {_LEAF("(n_chars + 1)")} end as altered from documents),
node(tree, named, level, place, hash, n) as (
  select tree, named, 0, row_number() over (partition by tree, named order by doc_id) - 1, leaf, count(*) over (partition by tree, named) from doc
  union all
  select tree, named, level + 1, place // 2, sha256(hash || coalesce(next, '')), (n + 1) // 2 from
    (select *, lead(hash) over (partition by tree, named order by place) as next from node where n > 1) where place % 2 = 0),
nodes as materialized (select * from node),
crown(level, place, hash, n) as (
  select 0, row_number() over (order by named, tree) - 1, hash, count(*) over () from nodes where n = 1
  union all
  select level + 1, place // 2, sha256(hash || coalesce(next, '')), (n + 1) // 2 from
    (select *, lead(hash) over (order by place) as next from crown where n > 1) where place % 2 = 0),
crowns as materialized (select * from crown),
tops as materialized (select tree, named, hash as subroot, level as height, row_number() over (order by named, tree) - 1 as number from nodes where n = 1),
walk(doc_id, tree, named, level, place, folded, proof) as (
  select doc_id, tree, named, 0, row_number() over (partition by tree, named order by doc_id) - 1, coalesce(altered, leaf), '' from doc
  union all
  select w.doc_id, w.tree, w.named, w.level + 1, case when w.level + 1 = t.height then t.number else w.place // 2 end,
    case when w.place % 2 = 0 then sha256(w.folded || coalesce(s.hash, '')) else sha256(s.hash || w.folded) end, w.proof || coalesce(s.hash, '')
  from walk w join tops t using (tree, named) left join nodes s on s.tree = w.tree and s.named = w.named and s.level = w.level and s.place = xor(w.place, 1) where w.level < t.height),
reached as materialized (select w.doc_id, case when t.height = 0 then t.number else w.place end as place, folded, proof from walk w join tops t using (tree, named) where w.level = t.height),
climb(doc_id, level, place, folded, proof) as (
  select doc_id, 0, place, folded, proof from reached
  union all
  select w.doc_id, w.level + 1, w.place // 2,
    case when w.place % 2 = 0 then sha256(w.folded || coalesce(s.hash, '')) else sha256(s.hash || w.folded) end, w.proof || coalesce(s.hash, '')
  from climb w left join crowns s on s.level = w.level and s.place = xor(w.place, 1) where w.level < (select max(level) from crowns))
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded as folded_root, folded = root as verified
from climb join doc using (doc_id) join tops using (tree, named), (select hash as root, level as peak from crowns where n = 1) where level = peak"""


def oracle_sql() -> dict[str, str]:
    """By query name. The result of op2 is not exact, so SQL cannot state it; the other operators use models or vocabularies."""
    return {"op4_minhash": MINHASH, "op5_substring": SUBSTRING, "op10_suffix": SUFFIX, "op11_hard_negatives": HARD_NEGATIVES, "op13_merkle": MERKLE}
