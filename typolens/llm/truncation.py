"""Texts that were cut off by a field limit or during transfer.

Two kinds of evidence. The sorted self-join by prefix finds texts that are strict prefixes of longer copies elsewhere:
values are sorted over all partitions, and a value is a strict prefix of some other one exactly if it is one of its
immediate successor. As most cut texts have no longer copy, the end of every text is judged as well: open mark-up,
half characters and entities, omission marks after an unfinished sentence, and last lines that stop inside one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typolens.functions.domains import let
from typolens.session import cut, spread

#: Marks of omission that systems append to a cut text.
OMISSION = r"(?i)[\s ]*(?:…|\.{3,}|\[(?:…|\.{3}|more|mehr|continued)\]|\((?:…|\.{3}|more|mehr|continued|read more)\)|»{1,2}\s*more)\s*$"
#: The end of a sentence with its closing quotes and brackets.
SENTENCE_END = r"[.!?…。！？]['\"’”»›)\]}*_`]*$"
#: Open mark-up at the very end: tags, comments, entities, links, half characters.
OPEN_MARKUP = r"<[A-Za-z/!?][^<>]*$|<$|&#?[A-Za-z0-9]{0,8}$|\[[^\]\n]*\]\([^)\s]*$|!?\[[^\]\n]{0,200}$|�$|\{\{[^}]*$"
#: An open link target, which like tags and templates may be longer than ``TAIL``.
OPEN_LINK = r"\[[^\]\n]*\]\([^)\s]*$"
#: Last lines that are complete without a full stop.
COMPLETE_LINE = (
    r"^#{1,6}\s+\S"  # heading
    r"|^>\s"  # quotation
    r"|^\|.*\|$"  # table row
    r"|\t"  # row of values
    r"|^`{3,}$|`$"  # code
    r"|^(?:[-*•+]|\d{1,3}[.)])\s+\S+(?:\s+\([^()]*\))?$"  # list of names
    r"|^(?:[-*•+]|\d{1,3}[.)])\s.*(?:[)\]\d%]|\b[A-Z0-9]\S*)$"  # list item that ends in a name or figure
    r"|^[\p{Lu}][\p{L} ]{1,24}:\s+\S.{0,120}$"  # label and value
    r"|[)\]}\"”»]$"  # closed bracket or quotation
    r"|(?:%|€|\$|°)$"
    r"|https?://\S+/$"
    r"|^(?:\S+\s+){0,7}\d+$"  # short line that ends in a figure
    r"|^\S+\s+[\p{Lu}\d][\p{Lu}\d./-]*$|^(?:\S+\s+){2,6}[\p{Lu}\d][\p{Lu}\d./-]+$"  # short line that ends in a sign such as "Appendix B"
)
#: Closing lines of letters.
CLOSING = r"(?i)^(?:(?:kind|best|warm)\s+)?(?:regards|wishes|greetings)\b.{0,60}$|^(?:mit freundlichen grüßen|met vriendelijke groet|cordialement|saludos|cumprimentos|z poważaniem)\b.{0,60}$"
GREETING = r"(?i)(?:regards|wishes|greetings|grüßen|groet|cordialement|saludos|cumprimentos|poważaniem),?\s*$"
#: A text of so few words on one line is a title, not a broken sentence.
TITLE_WORDS = 4


#: Rules that are anchored at the end look at so many last characters. What reaches further is :func:`_open_far`'s.
TAIL = 300
#: Characters of each of the pieces whose order decides a value's partition, and their number. Even texts that share a
#: beginning of several hundred characters are spread; the sample that sets the bounds holds these pieces, not the texts.
RANGE_CHARS = 128
RANGE_PIECES = 6
#: Seams that one task compares at most (a text each); more are ranged and merged again.
SEAM_TASK = 256


def _rtrim(text: Column) -> Column:
    return F.rtrim(text, F.lit(" \t\n\r\f\u000b\u00a0"))


def _open_far(line: Column) -> Column:
    """Whether a tag, link target or template is open at the end of a line, however long it is. Looks for the last
    opening and closing marks; a pattern reads only lines with an open ``](``."""
    tag = F.substring_index(line, "<", -1)
    return (
        (line.contains("<") & ~tag.contains(">") & tag.rlike(r"^[A-Za-z/!?]"))
        | F.substring_index(line, "}", -1).contains("{{")
        | (F.substring_index(line, ")", -1).contains("](") & line.rlike(OPEN_LINK))
    )


def ending(text: Column) -> Column:
    """``markup``, ``omission`` or ``sentence`` if the end of the text shows that it was cut, else null."""
    t = _rtrim(text)
    line = F.trim(F.substring_index(t, "\n", -1))
    tail = F.right(line, F.lit(TAIL))
    bare = F.regexp_replace(tail, OMISSION, "")
    before = F.trim(F.substring_index(F.substring_index(t, "\n", -2), "\n", 1))
    short_title = ~t.contains("\n") & (F.size(F.split(t, r"\s+")) <= TITLE_WORDS)
    signed = t.contains("\n") & before.rlike(GREETING) & (F.size(F.split(line, r"\s+")) <= 5)
    return (
        F.when(t == "", None)
        .when(tail.rlike(OPEN_MARKUP) | ((F.length(line) > TAIL) & _open_far(line)), "markup")
        .when(tail.rlike(OMISSION), F.when(~bare.rlike(SENTENCE_END) & bare.rlike(r"[\p{L}\p{N},;]$"), "omission"))
        .when(tail.rlike(SENTENCE_END), None)
        .when(line.rlike(COMPLETE_LINE) | line.rlike(CLOSING) | signed | short_title, None)
        .when(tail.rlike(r"[\p{L}\p{N},;:&/’'\-–(]$"), "sentence")
    )


#: Characters that hold any mark of omission once white space is collapsed, but for dots, of which any number may stand.
MARK_CHARS = 32


def _bare(text: Column) -> Column:
    """White space collapsed, marks of omission and half characters at the end dropped: what a longer copy starts with.

    Half mark-up stays, as the longer copy has the same half.
    """
    # The pattern finds only what differs from one blank, so clean text is read but not copied.
    t = F.trim(F.regexp_replace(text, r"[\s\u00a0]{2,}|[\t\n\r\f\u000b\u00a0]", " "))
    t = F.when(F.endswith(t, F.lit("...")), F.rtrim(t, F.lit(" ."))).otherwise(t)
    return let(t, lambda v: F.rtrim(F.concat(F.left(v, F.length(v) - MARK_CHARS), F.regexp_replace(F.right(v, F.lit(MARK_CHARS)), OMISSION, "")), F.lit("\ufffd")))


def _adjacent(edges: bool):
    """Over sorted values: each value whose successor continues it, and (if ``edges``) the first and last value."""
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: str | None = None
        for pdf in batches:
            v = pdf["value"].tolist()
            if not v:
                continue
            out = [(v[0], None, "edge")] if edges and last is None else []
            previous = last
            for x in v:
                if previous is not None and len(x) > len(previous) and x.startswith(previous):
                    out.append((previous, x[len(previous) : len(previous) + 40], "hit"))
                previous = x
            last = previous
            yield pd.DataFrame(out, columns=["value", "goes_on", "kind"])
        if edges and last is not None:
            yield pd.DataFrame([(last, None, "edge")], columns=["value", "goes_on", "kind"])

    return run


def strict_prefixes(values: DataFrame) -> DataFrame:
    """``value, goes_on``: each distinct value, other than the empty one, that a longer value continues, and how.

    ``values`` has a column ``value``. Copies collapse before the shuffle, so a text that many rows share costs one
    row; values are range-partitioned by their first ``RANGE_PIECES`` pieces, which splits even a usual instruction at
    the beginning of a third of all texts, and stream through the merge, so that none of them is held.
    The first and last value of each partition meet in further passes, each over a fraction of the seams.
    """
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("goes_on", T.StringType()), T.StructField("kind", T.StringType())])
    pieces = [F.substring("value", 1 + RANGE_CHARS * k, RANGE_CHARS) for k in range(RANGE_PIECES)]
    distinct = values.filter(F.length("value") > 0).select("value").distinct()
    found = cut(distinct.repartitionByRange(*pieces).sortWithinPartitions("value").mapInPandas(_adjacent(True), schema))
    hits = found.filter("kind = 'hit'")
    # Two values a partition, distinct ones: their number falls by a factor of SEAM_TASK / 2 with each pass.
    edges = found.filter("kind = 'edge'").select("value")
    n = 2 * found.rdd.getNumPartitions()
    while n > SEAM_TASK:
        parts = -(-n // SEAM_TASK)
        found = cut(edges.distinct().repartitionByRange(parts, *pieces).sortWithinPartitions("value").mapInPandas(_adjacent(True), schema))
        hits = hits.unionByName(found.filter("kind = 'hit'"))
        edges = found.filter("kind = 'edge'").select("value")
        n = 2 * parts
    seams = edges.repartition(1).sortWithinPartitions("value").mapInPandas(_adjacent(False), schema)
    return hits.unionByName(seams).groupBy("value").agg(F.min("goes_on").alias("goes_on"))


def truncated_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, evidence`` (``prefix``, ``markup``, ``omission`` or ``sentence``) of every cut text, and ``keep``.

    ``prefix``: a longer copy goes on at this point inside a word or sentence. Null and empty texts are never cut;
    copies under several ids are judged alike; a text that stops at the end of a sentence is not a case even if a
    longer copy exists; other columns are ignored.
    """
    rows = spread(docs.filter(F.length(text_col) > 0)).select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("__t"))
    rows = rows.withColumn("__end", ending(F.col("__t"))).withColumn("__b", _bare(F.col("__t")))
    hits = strict_prefixes(rows.select(F.col("__b").alias("value")))
    inside = hits.filter(F.col("goes_on").rlike(r"^[\p{Ll}\p{N}]|^[ ,;][\p{Ll}\p{N}]") & ~F.col("value").rlike(SENTENCE_END)).select(F.md5("value").alias("__h"), F.lit(True).alias("__p"))
    slim = rows.select("doc_id", *keep, "__end", F.md5("__b").alias("__h"))
    judged = slim.join(inside, "__h", "left")
    evidence = F.when(F.col("__p"), "prefix").otherwise(F.col("__end"))
    return judged.select("doc_id", *keep, evidence.alias("evidence")).filter("evidence IS NOT NULL")


def clean_source(c: Column) -> Column:
    """Source names in one spelling: trimmed, lower case, hyphens and blanks as underscores; blank is null."""
    v = F.regexp_replace(F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")), r"[-\s]+", "_")
    return F.when(v != "", v)


def truncation_by_source(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``source, n_texts, n_cut, share`` of non-empty texts per source (spellings merged; null source is a row)."""
    d = docs.withColumn("source", clean_source(F.col(source_col)))
    n_cut = truncated_texts(d, id_col, text_col, keep=("source",)).groupBy("source").agg(F.count(F.lit(1)).alias("n_cut"))
    total = d.filter(F.length(text_col) > 0).groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"))
    both = total.join(n_cut, total["source"].eqNullSafe(n_cut["source"]), "left").select(total["source"], "n_texts", F.coalesce("n_cut", F.lit(0)).alias("n_cut"))
    return both.withColumn("share", F.round(F.col("n_cut") / F.col("n_texts"), 4))
