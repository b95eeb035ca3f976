"""Pieces of the SQL counterparts that several operators share."""

from __future__ import annotations


def _crc_table() -> list[int]:
    out = []
    for x in range(256):
        for _ in range(8):
            x = (x >> 1) ^ 0xEDB88320 if x & 1 else x >> 1
        out.append(x)
    return out


def crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of an expression, whose hex digits are read two by two."""
    table = "[" + ",".join(map(str, _crc_table())) + "]"
    digit = lambda at: f"(strpos('0123456789ABCDEF', substr(h, {at}, 1)) - 1)"
    octets = f"list_transform(range(length(h) // 2), lambda i: 16 * {digit('2 * i + 1')} + {digit('2 * i + 2')})"
    step = f"xor(list_extract({table}, cast(xor(c, b) & 255 as bigint) + 1), c >> 8)"
    return f"(select xor(list_reduce({octets}, lambda c, b: {step}, 4294967295), 4294967295) from (select hex(encode({text})) as h))"


def merkle(name: str, leaves: str) -> str:
    """CTEs over ``leaves`` (grp, idx, node, cnt, changed): ``name``_lv (level, grp, idx, node), ``name``_proof (grp, idx, siblings, folded)."""
    return f"""{name}_lv(level, grp, idx, node, cnt) as (select cast(0 as bigint), grp, idx, node, cnt from {leaves}
union all select level + 1, grp, idx // 2, sha256(string_agg(node, '' order by idx)), any_value((cnt + 1) // 2)
from {name}_lv where cnt > 1 group by level, grp, idx // 2),
{name}_walk(grp, idx, level, spot, cnt, node, changed, siblings) as (
select grp, idx, cast(0 as bigint), idx, cnt, node, changed, '' from {leaves}
union all select w.grp, w.idx, w.level + 1, w.spot // 2, (w.cnt + 1) // 2, '',
case when s.node is null then sha256(w.changed) when w.spot % 2 = 0 then sha256(w.changed || s.node) else sha256(s.node || w.changed) end,
w.siblings || coalesce(s.node, '')
from {name}_walk w left join {name}_lv s on s.level = w.level and s.grp is not distinct from w.grp and s.idx = xor(w.spot, 1)
where w.cnt > 1),
{name}_proof as (select grp, idx, siblings, changed as folded from {name}_walk where cnt = 1)"""
