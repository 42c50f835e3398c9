"""Mixing sources to target shares of the total size.

Efraimidis-Spirakis sampling: each document draws an exponential key scaled by its quality weight; within a source the
documents are taken in order of the key until their tokens fill the budget. Whole epochs come first: a source whose
budget exceeds its size is used completely as often as it fits, and only the rest is selected.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typolens.llm.truncation import clean_source
from typolens.session import cut, spread

#: Rank file of a public byte-level BPE; ``TYPOLENS_TOKENIZER`` or the parameter names another.
DEFAULT_TOKENIZER = os.environ.get("TYPOLENS_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Word split of the byte-level BPE (public).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BIN_BITS = 12
BINS = 1 << BIN_BITS
#: Powers of two that the bins span, four fifths of them below 1; keys beyond them count as the first or last.
OCTAVES = 64
_ENCODINGS: dict[int, object] = {}


def count_tokens(rows: DataFrame, text_col: str, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """``rows`` without ``text_col`` and with ``n_tokens`` (0 for null). The rank file is read once, by the driver."""
    with open(tokenizer, "rb") as f:
        ranks = rows.sparkSession.sparkContext.broadcast(f.read())
    keep = [f for f in rows.schema.fields if f.name != text_col]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        key = hash(ranks.value)
        enc = _ENCODINGS.get(key)
        if enc is None:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.value.splitlines() if line)}
            enc = _ENCODINGS[key] = tiktoken.Encoding("mixture", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        for pdf in batches:
            n = [0 if t is None else len(enc.encode_ordinary(t)) for t in pdf[text_col]]
            yield pdf.drop(columns=[text_col]).assign(n_tokens=pd.Series(n, index=pdf.index, dtype="int64"))

    return spread(rows).mapInPandas(run, T.StructType([*keep, T.StructField("n_tokens", T.LongType())]))


def quality_weight(text: Column) -> Column:
    """A weight in (0, 1]: the share of letters and blanks, less for very short texts."""
    n = F.greatest(F.length(text), F.lit(1))
    letters = F.length(F.regexp_replace(text, r"[^\p{L} ]", ""))
    return F.greatest(F.lit(0.05), letters / n * F.least(F.lit(1.0), 0.5 + n / 400.0))


def sampling_key(id_col: Column, weight: Column, seed: int) -> Column:
    """Exponential key ``-ln(u) / w`` with ``u`` from the id and the seed: the same for every run and layout."""
    u = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11) + 0.5) / float(2**53)
    return -F.log(u) / weight


def plan_budgets(sizes: list[tuple[str, int]], targets: list[tuple[str, float, int]], total_tokens: int | None = None) -> dict[str, tuple[int, int, float]]:
    """Per source the whole epochs, tokens still to select, and the effective share.

    Shares of sources without tokens are spread over the others in proportion. The total is ``total_tokens`` or, if
    that is None or more than the repeats allow, the largest total at which every source still meets its share.
    """
    have = {s: n for s, n in sizes if s is not None and n > 0}
    used = [(s, w, max(0, r)) for s, w, r in targets if w > 0 and have.get(s) and r > 0]
    mass = sum(w for _, w, _ in used)
    if not used:
        return {}
    most = min(have[s] * r / (w / mass) for s, w, r in used)
    total = min(most, total_tokens) if total_tokens is not None else most
    plan = {}
    for s, w, r in used:
        budget = min(total * w / mass, have[s] * r)
        epochs = min(int(budget // have[s]), r)
        plan[s] = (epochs, int(round(budget - epochs * have[s])) if epochs < r else 0, w / mass)
    return plan


def mix_sources(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", total_tokens: int | None = None, seed: int = 1, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """``doc_id, source, n_tokens, n_uses``: the mixture, a row per used document.

    ``targets`` (``source, target_share, max_repeats``) is a table of source names and read by the driver; so are the
    token sums per source and key bin (``BINS`` a source at most), nothing else. Within a source the keys are counted in
    bins of their logarithm, and those of the bin in which the budget ends once more in finer ones. Bins before are taken
    whole, and only the last fine bin (less than a millionth of a large source, whatever the weights) is sorted and
    prefix-summed, so a source with most rows needs no large sort. The
    last document is the one that reaches the budget only if it fits. Sources are compared in their clean spelling;
    null, empty and unknown sources and documents without tokens are left out; equal keys go by id.
    """
    goals = [(r["source"], float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in targets.select(clean_source(F.col("source")).alias("source"), "target_share", "max_repeats").collect()]
    names = [s for s, _, _ in goals if s is not None]
    source = clean_source(F.col(source_col))
    base = docs.select(F.col(id_col).alias("doc_id"), source.alias("source"), F.col(text_col).alias("text")).filter(F.col("source").isin(names) & (F.length("text") > 0))
    keyed = base.select("doc_id", "source", sampling_key(F.col("doc_id"), quality_weight(F.col("text")), seed).alias("key"), "text")
    slim = cut(count_tokens(keyed, "text", tokenizer).filter("n_tokens > 0"))
    # Bins of equal width in the logarithm of the key, so that documents of any weight spread over many of them.
    place = F.least(F.lit(BINS - 1e-6), F.greatest(F.lit(0.0), (F.log2("key") + OCTAVES * 0.8) * (BINS / OCTAVES)))
    slim = slim.withColumn("fine", F.floor(place * BINS).cast("long"))
    bins = _sums(slim, F.shiftright(F.col("fine"), BIN_BITS))
    plan = plan_budgets([(s, sum(n for _, n in b)) for s, b in bins.items()], goals, total_tokens)
    # The bin in which each budget ends, then the one inside it.
    edges = {s: _edge(bins[s], rest) for s, (_, rest, _) in plan.items()}
    inside = slim.filter(F.struct("source", F.shiftright(F.col("fine"), BIN_BITS)).isin([F.struct(F.lit(s), F.lit(e).cast("long")) for s, (e, _) in edges.items()])) if edges else slim.limit(0)
    finer = _sums(inside, F.col("fine"))
    rows = []
    for s, (epochs, _, _) in plan.items():
        edge, room = edges[s]
        fine, room = _edge(finer[s], room) if s in finer else (edge << BIN_BITS, room)
        rows.append((s, epochs, fine, room))
    limits = slim.sparkSession.createDataFrame(rows, "source string, epochs int, edge long, room long")
    joined = slim.join(F.broadcast(limits), "source")
    inner = W.partitionBy("source").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    at_edge = joined.filter("fine = edge").withColumn("once_more", (F.sum("n_tokens").over(inner) <= F.col("room")).cast("int"))
    rest = joined.filter("fine != edge").withColumn("once_more", (F.col("fine") < F.col("edge")).cast("int"))
    return rest.unionByName(at_edge).withColumn("n_uses", F.col("epochs") + F.col("once_more")).filter("n_uses > 0").select("doc_id", "source", "n_tokens", "n_uses")


def _sums(rows: DataFrame, bin_: Column) -> dict[str, list[tuple[int, int]]]:
    """Tokens of each bin by source, in order: at most ``BINS`` rows a source."""
    out: dict[str, list[tuple[int, int]]] = {}
    for r in rows.groupBy("source", bin_.alias("b")).agg(F.sum("n_tokens").alias("n")).collect():
        out.setdefault(r["source"], []).append((r["b"], r["n"]))
    return {s: sorted(b) for s, b in out.items()}


def _edge(bins: list[tuple[int, int]], budget: int) -> tuple[int, int]:
    """The bin in which a budget ends (the one behind the last if it does not), and what is left of the budget there."""
    for b, n in bins:
        if n > budget:
            return b, budget
        budget -= n
    return bins[-1][0] + 1, budget


def mixture_shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, n_docs, n_tokens, share, max_uses`` reached by the mixture; unused sources have zeros."""
    goal = targets.select(clean_source(F.col("source")).alias("source"), "target_share")
    got = mixture.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("n_tokens") * F.col("n_uses")).alias("n_tokens"), F.max("n_uses").alias("max_uses"))
    both = goal.join(got, "source", "left").fillna(0, ["n_docs", "n_tokens", "max_uses"])
    return both.select("source", "target_share", "n_docs", "n_tokens", (F.col("n_tokens") / F.greatest(F.lit(1), F.sum("n_tokens").over(W.partitionBy()))).alias("share"), "max_uses")
