"""Registrable domains and second-level labels as native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from typolens.functions.keys import normalize_domain, strip

#: Public suffixes that the engine knows (an explicit excerpt; pass another list for more).
SUFFIXES = (
    "com net org io co info biz app shop store online site xyz cm fitness travel club dev ai tv me "
    "de nl fr es pt pl it eu uk co.uk org.uk br com.br ch at be us ca cz se no dk fi ie lt in au com.au jp co.jp mx com.mx ar com.ar"
).split()


def domain_parts(host: Column, suffixes: list[str] | None = None) -> Column:
    """``struct(sub, label, suffix)``; all empty if there is no known suffix or nothing before it.

    The longest known suffix with a label before it counts. Suffixes are looked up by their number of labels, so a long
    list costs no more than a short one.
    """
    known: dict[int, list[str]] = {}
    for s in sorted(set(suffixes or SUFFIXES)):
        known.setdefault(s.count(".") + 1, []).append(s)
    parts = lambda sub, label, suffix: F.struct(sub.alias("sub"), label.alias("label"), suffix.alias("suffix"))
    nothing = parts(F.lit(""), F.lit(""), F.lit(""))

    def split(h: Column, suffix: Column) -> Column:
        def at_label(rest: Column, label: Column) -> Column:
            sub = lambda x: F.when(rest == label, parts(x, label, suffix)).when(x != "", parts(x, label, suffix))
            return F.when(label != "", let(F.left(rest, F.length(rest) - F.length(label) - 1), sub))

        return let(F.left(h, F.length(h) - F.length(suffix) - 1), lambda rest: let(F.substring_index(rest, ".", -1), lambda label: at_label(rest, label)))

    def longest(h: Column) -> Column:
        ends = lambda n: let(F.substring_index(h, ".", -n), lambda s: F.when(_among(s, known[n]) & (s != h), split(h, s)))
        tried = [ends(n) for n in sorted(known, reverse=True)]
        return F.when(_among(h, sorted(set(suffixes or SUFFIXES))), nothing).otherwise(F.coalesce(*tried, nothing))

    return let(host, lambda h: F.when(h.isNotNull(), longest(h)))


def _among(value: Column, names: list[str]) -> Column:
    """Whether a value is one of the names: a short list as one constant, a long one as a set of literals."""
    return F.array_contains(F.split(F.lit(" ".join(names)), " "), value) if len(names) <= 500 else value.isin(names)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once. A nested expression would repeat it in each place, as trees of
    expressions share nothing, and soon be too large to compile."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _host(c: Column) -> Column:
    v = F.lower(strip(c))
    return F.when(v == "nan", F.lit("")).otherwise(v)


def registrable_sld(c: Column, suffixes: list[str] | None = None) -> Column:
    """Second-level label of a domain: without a dot as it is, without a known suffix the first label."""
    def body(host: Column) -> Column:
        label = let(domain_parts(host, suffixes), lambda p: F.when(p["label"] != "", p["label"]).otherwise(F.substring_index(host, ".", 1)))
        return F.when(~F.contains(host, F.lit(".")), host).otherwise(label)

    return let(normalize_domain(c), body)


def address_matching_sld(c: Column, suffixes: list[str] | None = None) -> Column:
    """Second-level label of an address that has a known suffix and no subdomain (``www`` is one), else ``""``."""
    def body(host: Column) -> Column:
        label = let(domain_parts(host, suffixes), lambda p: F.when(p["sub"] == "", p["label"]).otherwise(""))
        return F.when(~F.contains(host, F.lit(".")), host).otherwise(label)

    return let(_host(c), body)


def registrable_domain(c: Column, suffixes: list[str] | None = None) -> Column:
    """Label and suffix of a normalised domain, or the text itself if no suffix is known."""
    whole = lambda host: let(domain_parts(host, suffixes), lambda p: F.when(p["label"] != "", F.concat(p["label"], F.lit("."), p["suffix"])).otherwise(host))
    return let(normalize_domain(c), whole)


def last_label(c: Column) -> Column:
    """The last label, ``""`` without a dot."""
    low = F.lower(c)
    return F.when(F.contains(low, F.lit(".")), F.substring_index(low, ".", -1)).otherwise("")
