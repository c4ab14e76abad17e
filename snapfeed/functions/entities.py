"""HTML entity decoding as a single-pass Catalyst expression (STR-3 / STR-4).

The name tables are generated from Python's standard ``html.entities`` module (HTML 4.01
names for STR-3, HTML5 names with a trailing semicolon for STR-4) and embedded as a
literal map, so the lookup is a constant-folded ``MapType`` literal evaluated in the JVM.
"""

from __future__ import annotations

import html.entities as _ent
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

HTML4 = "html4"
HTML5 = "html5"


@lru_cache(maxsize=None)
def entity_table(table: str) -> tuple[tuple[str, str], ...]:
    if table == HTML4:
        return tuple(sorted((name, chr(cp)) for name, cp in _ent.name2codepoint.items()))
    if table == HTML5:
        return tuple(sorted((name[:-1], val) for name, val in _ent.html5.items() if name.endswith(";")))
    raise ValueError(f"unknown entity table {table!r}")


_PAIR_SEP, _KV_SEP = "\x02", "\x01"


@lru_cache(maxsize=None)
def _map_text(table: str) -> str:
    pairs = entity_table(table)
    for name, value in pairs:
        if _PAIR_SEP in name + value or _KV_SEP in name + value:
            raise ValueError("entity table contains a separator character")
    return _PAIR_SEP.join(f"{name}{_KV_SEP}{value}" for name, value in pairs)


def _map_literal(table: str) -> Column:
    # One string literal split into a map by str_to_map; the optimizer folds it to a map
    # constant, so the table costs one literal, not thousands of expression nodes.
    return F.str_to_map(F.lit(_map_text(table)), F.lit(_PAIR_SEP), F.lit(_KV_SEP))


def _code_point_char(cp: Column) -> Column:
    # UTF-32BE bytes of the code point -> string; char(n) is modulo 256 and unusable here.
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")


def decode_entities(col, table: str = HTML4) -> Column:
    """Decode named and numeric character references in one left-to-right pass.

    Unknown names and invalid code points are left untouched, so ``&amp;copy;`` becomes
    ``&copy;`` (not ``©``), as a single-pass decoder must.
    """
    c = F.col(col) if isinstance(col, str) else col
    names = _map_literal(table)

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, r"^&([A-Za-z][A-Za-z0-9]*);", 1)
        dec = F.regexp_extract(p, r"^&#([0-9]{1,7});", 1)
        hx = F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]{1,6});", 1)
        cp = F.coalesce(
            F.when(dec != "", dec.cast("int")),
            F.when(hx != "", F.conv(hx, 16, 10).cast("int")),
        )
        valid_cp = cp.isNotNull() & (cp > 0) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
        rest = F.substring(p, F.instr(p, ";") + 1, 1 << 30)
        named = names[name]
        return (
            F.when((name != "") & named.isNotNull(), F.concat(named, rest))
            .when(valid_cp, F.concat(_code_point_char(cp), rest))
            .otherwise(p)
        )

    def body(v: Column) -> Column:
        decoded = F.array_join(F.transform(F.split(v, r"(?=&)"), piece), "")
        return F.when(v.contains("&"), decoded).otherwise(v)
    return let(c, body)
