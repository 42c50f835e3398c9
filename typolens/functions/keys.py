"""Key normalisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All Unicode white space, spelled out because engines differ in what they count as such.
WHITE = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x20), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
BOM = "\ufeff"


def strip(c: Column) -> Column:
    """Drop surrounding white space of any kind. Looks at the ends only, unlike a pattern."""
    return F.trim(c, F.lit(WHITE))


def clean_value(c: Column) -> Column:
    """Trimmed and in lower case; null stays null, blank becomes null."""
    v = F.lower(strip(c))
    return F.when(v != "", v)


def reference_key(c: Column) -> Column:
    """Join key of addresses and hashes: no leading byte-order marks, no surrounding white space, lower case.

    ``www.`` is part of the key. Null, empty and ``nan`` are no references and give null.
    """
    v = F.lower(F.rtrim(F.ltrim(c, F.lit(WHITE + BOM)), F.lit(WHITE)))
    return F.when(~v.isin("", "nan"), v)


def dump_key(c: Column) -> Column:
    """The target-dump normalisation: byte-order marks first, then white space, then case; ``""`` is kept."""
    return F.lower(strip(F.ltrim(c, F.lit(BOM))))


def normalize_domain(c: Column) -> Column:
    """Trim, lower, drop all through ``://``, drop from the first ``/``, drop one leading ``www.``.

    The texts ``nan`` and blank give ``""``; null stays null.
    """
    v = F.lower(strip(c))
    v = F.when(v == "nan", F.lit("")).when(F.contains(v, F.lit("://")), F.regexp_replace(v, "^.*?://", "")).otherwise(v)
    v = F.substring_index(v, "/", 1)
    return F.when(F.startswith(v, F.lit("www.")), F.substring(v, 5, 1 << 30)).otherwise(v)
