"""DuckDB twins of the corpus queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP5 = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size from documents
), per as (
  select source, sum(size)::bigint as source_size from sized group by source
), ranked as (
  select *, (row_number() over (order by source is null, source) - 1)::int as place,
    (sum(source_size) over ())::double * 1.5::double as total
  from per
), weighed as (
  select *, case place % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as weight,
    source_size::double * 2.0::double as cap
  from ranked
), levels as (
  select a.place,
    (a.total - coalesce((select sum(b.cap) from weighed b where (b.cap / b.weight, b.place) < (a.cap / a.weight, a.place)), 0.0))
      / (select sum(b.weight) from weighed b where (b.cap / b.weight, b.place) >= (a.cap / a.weight, a.place)) as level,
    a.weight, a.cap
  from weighed a
), water as (
  select level from levels where level * weight < cap order by cap / weight, place limit 1
), targets as (
  select source, source_size, place,
    case when (select level from water) is null or cap <= weight * (select level from water) then cap
         else weight * (select level from water) end as target
  from weighed
), rates as (
  select *, case when source_size > 0 then target / source_size else 0.0 end as rate,
    ('0x' || substr(md5('mix-1:' || place), 1, 8))::ubigint::double / 4294967296.0::double as shift
  from targets
), placed as (
  select s.*, r.source_size, r.target, r.rate, r.shift,
    (row_number() over (partition by s.source order by s.size, s.doc_id))::double as k
  from sized s join rates r on s.source is not distinct from r.source
)
select doc_id, size, source_size, target,
  (floor(rate * k + shift) - floor(rate * (k - 1) + shift))::bigint * size as taken
from placed
"""

def _op11(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Plain k-means: every round compares every part with every entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near_{r} as materialized (
  select vec_id, label, row, p, v, min(struct_pack(
    d := list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint, e := e)) as best
  from cut join book_{r} using (p) group by all
)""")
        if r < rounds:
            steps.append(f"""sums_{r} as (
  select p, best.e as e, pos, sum(v[pos])::hugeint as s, count(*)::hugeint as n
  from near_{r}, range(1, (select max(len(v)) from cut) + 1) t(pos) group by all
), book_{r + 1} as materialized (
  select p, e, coalesce(m.c, b.c) as c from book_{r} b left join (
    select p, e, list(((s - ((s % n) + n) % n) // n)::bigint order by pos) as c from sums_{r} group by p, e
  ) m using (p, e)
)""")
    return f"""
with good as (
  select vec_id, label, row_number() over (order by vec_id nulls last, embedding) - 1 as row,
    list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cut as materialized (
  select vec_id, label, row, p::int as p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as v
  from good, range({parts}) t(p)
), book_0 as materialized (
  select p, row::int as e, v as c from cut where row < {entries}
), {", ".join(steps)}, coded as (
  select vec_id, label, string_agg(printf('%02x', best.e), '' order by p) as code, sum(best.d)::bigint as error
  from near_{rounds} group by row, vec_id, label
), digest as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from book_{rounds}
)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from coded, digest
"""


#: crc32 of a decimal id, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(id) + 1), lambda i: ascii(id[i])::bigint)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
      lambda x, bit: xor(x >> 1, case when x & 1 = 1 then 3988292384::bigint else 0::bigint end))), 4294967295::bigint)"""


def _field(x: str) -> str:
    return f"coalesce(strlen({x}) || ':' || {x}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)) + ")"


OP12 = f"""
with recursive docs as materialized (
  select *, doc_id::varchar as id, coalesce('=' || source, '-') as grp, {_leaf("text")} as leaf, {_leaf("replace(text, chr(10), '')")} as other
  from documents
), leaves as materialized (
  select doc_id, grp, leaf, case when coalesce({_CRC} % 2 = 0, false) then other else leaf end as shown,
    row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by grp) as n
  from docs
), tree as (
  select grp, 0 as lvl, idx, n, leaf as h from leaves
  union all
  select grp, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' order by idx)) from tree where n > 1 group by grp, lvl, idx // 3, n
), tops as materialized (
  select grp, h as subroot, row_number() over (order by grp) - 1 as idx, count(*) over () as n from tree where n = 1
), top_tree as (
  select 0 as lvl, idx, n, subroot as h from tops
  union all
  select lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' order by idx)) from top_tree where n > 1 group by lvl, idx // 3, n
), nodes as materialized (
  select grp, lvl, idx, h from tree where n > 1
  union all
  select '', lvl, idx, h from top_tree where n > 1
), walk as (
  select l.doc_id, l.grp as own, l.leaf, l.idx as row, 0 as step, case when l.n > 1 then l.grp else '' end as grp, 0 as lvl,
    case when l.n > 1 then l.idx else t.idx end as idx, case when l.n > 1 then l.n else t.n end as n, t.idx as top, t.n as tops,
    l.shown as folded, '' as proof
  from leaves l join tops t using (grp)
  union all
  select doc_id, own, leaf, row, step + 1, case when n > 3 then w.grp else '' end, case when n <= 3 and w.grp <> '' then 0 else lvl + 1 end,
    case when n <= 3 and w.grp <> '' then top else w.idx // 3 end, case when n <= 3 and w.grp <> '' then tops when w.grp = '' and n <= 3 then 1 else (n + 2) // 3 end,
    top, tops,
    sha256(coalesce((select string_agg(h, '' order by s.idx) from nodes s where s.grp = w.grp and s.lvl = w.lvl and s.idx // 3 = w.idx // 3 and s.idx < w.idx), '')
      || folded || coalesce((select string_agg(h, '' order by s.idx) from nodes s where s.grp = w.grp and s.lvl = w.lvl and s.idx // 3 = w.idx // 3 and s.idx > w.idx), '')),
    proof || coalesce((select string_agg(h, '' order by s.idx) from nodes s where s.grp = w.grp and s.lvl = w.lvl and s.idx // 3 = w.idx // 3 and s.idx <> w.idx), '')
  from walk w where n > 1
)
select w.doc_id, w.leaf, t.subroot, r.h as root, sha256(w.proof) as proof_sha256, w.folded as folded_root, w.folded = r.h as verified
from walk w join tops t on w.own = t.grp, (select h from top_tree where n = 1) r
where w.n = 1
"""

#: Characters that the op13 template adds to each turn: <s>[INST][/INST]</s>.
_MARKS = len("<s>[INST][/INST]</s>")


def _escaped(x: str) -> str:
    rest = "|".join(("s>", "/s>", r"\|endoftext\|>"))
    bracket = r"INST\]|/INST\]"
    return rf"regexp_replace(regexp_replace({x}, '(<\\*)({rest})', '\1\\\2', 'g'), '(\[\\*)({bracket})', '\1\\\2', 'g')"


OP13 = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length({_escaped("role")}) + length({_escaped("text")}) + {_MARKS})::bigint as formatted_chars
from turns group by conv_id
"""

ORACLE: dict[str, str] = {"op5_systematic_mix": OP5, "op11_anchor_codes": _op11(), "op12_sibling_merkle": OP12, "op13_offset_masks": OP13}
