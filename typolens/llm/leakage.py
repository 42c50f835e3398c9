"""Evaluation texts that stand in a corpus.

Windows of documents and items are embedded by CGK random walks: a pointer walks over the words, each step emits the word
it stands on and moves on if a random bit of that word and step says so, so two windows that differ by a few replaced,
inserted or dropped words emit sequences that agree in many places. Bit sampling takes a few places of a walk as a key;
many walks and samples together reach the target recall. Candidates are verified exactly, word by word.

What counts is a stretch of an item, of eight words or more; an item of a hundred words of which twenty stand in a
document is far from it as a whole. So windows have the size of the shortest stretch, and start at every word.
"""

from __future__ import annotations

import html
import itertools
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typolens.session import spread

MIN_STRETCH = 8
MIN_WORDS = 20
#: Walks, steps of a walk, and sampled keys of each walk. With these a stretch in which every second word is replaced is
#: found in more than 0.99 of the cases (``tests/llm/test_leakage.py`` measures it); sparser changes are easier.
WALKS = 8
STEPS = 10
SAMPLES = 6
#: Places of a walk that make a key; the first step is always one of them.
KEY_STEPS = 4
#: Chance that a step moves on. Higher than one half, as replaced words are more frequent than inserted ones.
ADVANCE = 0.85
#: Words of items that one index holds (some 600 bytes each); more items are searched in blocks.
BLOCK_WORDS = 250_000
#: Wording at the ends of an item that at least so many different items share is not its own.
SHARED_BY = 3
_PAD, _OTHER = 0, 1

_WORD = re.compile(r"\w+")
_JOINED = re.compile(r"(?<=\w)[-­‐]\s*\n\s*(?=\w)")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_PARTS = re.compile(r"(?<=[.:?!])\s+")


def words_of(text: str) -> list[str]:
    """Words without regard to case, punctuation, layout, entities and presentation forms."""
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if "\n" in text:
        text = _JOINED.sub("", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    return _WORD.findall(text.lower())


_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c == 95 else 32 for c in range(128)) + bytes([32]) * 128


def word_ids(text: str, ids: dict[str | bytes, int]) -> np.ndarray:
    """Numbers of the words of a text, 1 for unknown ones. Plain texts take a byte-wise way to the same words."""
    if text.isascii() and "&" not in text:
        if "-" in text:
            text = _JOINED.sub("", text)
        words = text.encode().translate(_FOLD).split()
    else:
        words = words_of(text)
    get = ids.get
    return np.array([get(w, _OTHER) for w in words], dtype=np.int32)


def own_words(parts: list[str], shared: list[bool], least: int = MIN_WORDS) -> list[str]:
    """Words of an item's parts without the shared ones at either end, as long as ``least`` words remain."""
    sizes = [len(p.split()) for p in parts]
    a, b = 0, len(parts)
    while a < b and shared[a] and sum(sizes[a + 1 : b]) >= least:
        a += 1
    while a < b and shared[b - 1] and sum(sizes[a : b - 1]) >= least:
        b -= 1
    return [w for p in parts[a:b] for w in p.split()]


def item_parts(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item_id, parts``: each item's parts (up to a stop or colon) with whether several items share them.

    A part is shared if at least ``SHARED_BY`` different item texts have it, so neither repeated items nor two questions
    on one passage lose their wording. Grouped counts; nothing is collected.
    """
    @F.pandas_udf("array<string>")
    def cut_up(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [x for x in (" ".join(words_of(p)) for p in _PARTS.split(t)) if x])

    base = items.filter(F.length(text_col) > 0).select(F.col(item_col).alias("item_id"), cut_up(F.col(text_col)).alias("parts")).distinct()
    uses = base.select("parts").distinct().select(F.explode(F.array_distinct("parts")).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    common = uses.filter(F.col("n") >= SHARED_BY).select("part", F.lit(True).alias("shared"))
    rows = base.select("item_id", F.xxhash64("parts").alias("h"), F.posexplode("parts").alias("pos", "part")).join(common, "part", "left")
    kept = F.struct("pos", "part", F.coalesce("shared", F.lit(False)).alias("shared"))
    return rows.groupBy("item_id", "h").agg(F.array_sort(F.collect_list(kept)).alias("parts")).select("item_id", "parts")


class CgkIndex:
    """Sampled walks from every word of a block of items, and what is needed to look documents up."""

    def __init__(self, items: list[tuple[object, list[str]]], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.items = [(i, w) for i, w in items if len(w) >= MIN_STRETCH]
        vocab = sorted({x for _, w in self.items for x in w})
        #: 0 is padding, 1 any word that no item has.
        self.ids: dict[str | bytes, int] = {x: k + 2 for k, x in enumerate(vocab)}
        self.ids |= {x.encode(): k for x, k in self.ids.items()}
        size = len(vocab) + 2
        self.code = rng.integers(1, 2**62, size=(KEY_STEPS, size), dtype=np.int64) | 1
        #: Bit j of a walk's entry for a word: whether step j moves on from it. From padding every step does.
        moves = rng.random(size=(WALKS, STEPS, size)) < ADVANCE
        moves[:, :, _PAD] = True
        self.moves = (moves << np.arange(STEPS)[None, :, None]).sum(axis=1).astype(np.uint16)
        # Sampled steps lie at least two apart, so that they seldom stand on the same word.
        sets = [s for s in itertools.combinations(range(2, STEPS), KEY_STEPS - 1) if all(b - a > 1 for a, b in zip(s, s[1:]))]
        self.samples = [[sets[k] for k in rng.permutation(len(sets))[:SAMPLES]] for _ in range(WALKS)]
        self.passages = [np.array([self.ids[x] for x in w], dtype=np.int32) for _, w in self.items]
        self.flat, self.owner = self._lay(self.passages)
        self.lookup: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        start = np.flatnonzero(self.owner >= 0)
        # A table of 64 bits or more for each place tells most keys that no item has.
        self.slots = (1 << max(14, (64 * len(start)).bit_length())) - 1
        for v in self.keys(self.flat, start):
            order = np.argsort(v, kind="stable")
            table = np.zeros(self.slots + 1, dtype=bool)
            table[v & self.slots] = True
            self.lookup.append((v[order], start[order].astype(np.int32), np.packbits(table)))

    @staticmethod
    def _lay(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All texts in a row with padding between, and for each word the number of its text."""
        gap = max(STEPS, MIN_STRETCH + 1)
        n = gap + sum(len(t) + gap for t in texts)
        flat, owner = np.full(n, _PAD, dtype=np.int32), np.full(n, -1, dtype=np.int32)
        at = gap
        for k, t in enumerate(texts):
            flat[at : at + len(t)] = t
            owner[at : at + len(t)] = k
            at += len(t) + gap
        return flat, owner

    def keys(self, flat: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
        """For each walk and sample the keys of the windows at ``start``."""
        first = self.code[0][flat[start]]
        for moves, samples in zip(self.moves, self.samples):
            bits = moves[flat]
            at = start.copy()
            seen = [flat[at]]
            for j in range(STEPS - 1):
                at += (bits[at] >> j) & 1
                seen.append(flat[at])
            for sample in samples:
                acc = first.copy()
                for code, step in zip(self.code[1:], sample):
                    acc += code[seen[step]]
                yield (acc ^ (acc >> 29)) & 0x7FFFFFFFFFFFFFFF

    def candidates(self, docs: list[np.ndarray], indels: bool = False) -> set[tuple[int, int]]:
        """Pairs (document, item) with windows that share a key and lie in a stretch.

        Unless ``indels``, a shared key counts only if the words around it make a stretch of ``MIN_STRETCH`` on their
        alignment: the same rule as in :func:`held_words`, so no pair that this accepts is lost here.
        """
        flat, owner = self._lay(docs)
        start = np.flatnonzero(flat > _OTHER)
        if not len(start) or not self.items:
            return set()
        hits: list[np.ndarray] = []
        for v, (values, place, table) in zip(self.keys(flat, start), self.lookup):
            slot = v & self.slots
            hit = np.flatnonzero((table[slot >> 3] >> (7 - (slot & 7))) & 1)
            v = v[hit]
            lo = np.searchsorted(values, v)
            n = np.searchsorted(values, v, side="right") - lo
            at = np.repeat(start[hit], n)
            if len(at):
                there = place[np.repeat(lo, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
                hits.append(at << 32 | there)
        both = np.unique(np.concatenate(hits)) if hits else np.zeros(0, dtype=np.int64)
        pairs: list[np.ndarray] = []
        for k in range(0, len(both), 200_000):
            at, there = both[k : k + 200_000] >> 32, both[k : k + 200_000] & 0xFFFFFFFF
            if not indels:
                near = self._in_stretch(flat, at, there)
                at, there = at[near], there[near]
            pairs.append(owner[at].astype(np.int64) << 32 | self.owner[there])
        return {(int(p >> 32), int(p & 0xFFFFFFFF)) for p in np.unique(np.concatenate(pairs))} if pairs else set()

    def _in_stretch(self, flat: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Whether the word at ``at`` is part of a stretch on the alignment with ``there``."""
        size = np.ones(len(at), dtype=np.int64)
        for way in (1, -1):
            missed = np.zeros(len(at), dtype=bool)
            going = np.ones(len(at), dtype=bool)
            last = np.zeros(len(at), dtype=np.int64)
            for step in range(1, MIN_STRETCH):
                here = flat[at + way * step]
                same = (here == self.flat[there + way * step]) & (here > _OTHER)
                going &= same | ~missed
                last = np.where(going & same, step, last)
                missed = ~same
            size += last
        return size >= MIN_STRETCH


def _matches(doc: np.ndarray, passage: np.ndarray, block: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(passage, doc)`` of equal words that have another pair within two words of both, block by block."""
    order = np.argsort(passage, kind="stable")
    sorted_words = passage[order]
    out = []
    for a in range(0, len(doc), block):
        lo, hi = max(0, a - 2), min(len(doc), a + block + 2)
        words = doc[lo:hi]
        first = np.searchsorted(sorted_words, words)
        n = np.searchsorted(sorted_words, words, side="right") - first
        n[words <= _OTHER] = 0
        d = np.repeat(np.arange(lo, hi), n)
        p = order[np.repeat(first, n) + np.arange(len(d)) - np.repeat(np.cumsum(n) - n, n)]
        # One number for each place; neighbours differ by what a step adds.
        wide = len(passage) + 8
        spot = np.sort((d + 4) * wide + p + 4)
        lonely = np.ones(len(spot), dtype=bool)
        for i, j in ((1, 1), (2, 2), (1, 2), (2, 1)):
            for s in (i * wide + j, -(i * wide + j)):
                k = np.searchsorted(spot, spot + s)
                lonely &= ~((k < len(spot)) & (spot[np.minimum(k, len(spot) - 1)] == spot + s)) if len(spot) else lonely
        spot = spot[~lonely]
        d, p = spot // wide - 4, spot % wide - 4
        keep = (d >= a) & (d < a + block)
        out.append((p[keep], d[keep]))
    return (np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])) if out else (np.zeros(0, int), np.zeros(0, int))


def _straight(p: np.ndarray, d: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Stretches ``(passage place, words, document place, words)`` along one alignment, with single replaced words."""
    order = np.lexsort((p, d - p))
    p, shift = p[order], (d - p)[order]
    if not len(p):
        return []
    first = np.flatnonzero(np.r_[True, (np.diff(shift) != 0) | (np.diff(p) > 2)])
    last = np.r_[first[1:], len(p)] - 1
    size = p[last] - p[first] + 1
    keep = size >= MIN_STRETCH
    return [(int(p[a]), int(n), int(p[a] + shift[a]), int(n)) for a, n in zip(first[keep], size[keep])]


def _edited(p: np.ndarray, d: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The same with single inserted and dropped words as well: for each end the longest way back, by equal words."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    tails: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for y, x in sorted(zip(d.tolist(), p.tolist())):
        way = max((best[k] for k in ((x - 1, y - 1), (x - 2, y - 2), (x - 1, y - 2), (x - 2, y - 1)) if k in best), default=None)
        best[x, y] = (way[0] + 1, way[1], way[2]) if way else (1, x, y)
        n, x0, y0 = best[x, y]
        if x - x0 + 1 >= MIN_STRETCH and x - x0 >= tails.get((x0, y0), (0, 0, 0, 0))[1]:
            tails[x0, y0] = (x0, x - x0 + 1, y0, y - y0 + 1)
    return list(tails.values())


def held_words(doc: np.ndarray, passage: np.ndarray, indels: bool = False) -> int:
    """Most words of ``passage`` that ``doc`` holds in order, in stretches of at least ``MIN_STRETCH`` words.

    A stretch begins and ends with an equal word, and no two of its words in a row are replaced; replaced words count as
    part of it. With ``indels`` a word may also be inserted or dropped in place of a replaced one.
    """
    stretches = sorted((_edited if indels else _straight)(*_matches(doc, passage)))
    if not stretches:
        return 0
    s = np.array(stretches)
    best = np.zeros(len(s), dtype=np.int64)
    for k, (p, n, d, m) in enumerate(stretches):
        # Stretches that overlap a little are cut at the seam.
        over = np.maximum(0, np.maximum(s[:k, 0] + s[:k, 1] - p, s[:k, 2] + s[:k, 3] - d))
        fits = (s[:k, 0] < p) & (s[:k, 2] < d) & (n - over >= MIN_STRETCH)
        best[k] = n + max(0, int((best[:k] - over)[fits].max(initial=0)))
    return int(best.max())


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, list[str]]]]:
    """Items with their own words, some ``BLOCK_WORDS`` words at a time."""
    block: list[tuple[object, list[str]]] = []
    size = 0
    for r in item_parts(items, item_col, text_col).toLocalIterator():
        words = own_words([x["part"] for x in r["parts"]], [x["shared"] for x in r["parts"]])
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((r["item_id"], words))
        size += len(words)
    yield block


def leaked_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "item_text", min_words: int = MIN_WORDS, indels: bool = False) -> DataFrame:
    """``doc_id, item_id, words`` of every document that holds at least ``min_words`` words of an item's own passage.

    Items are a stated query set: the driver builds one index for each block of ``BLOCK_WORDS`` words and broadcasts it
    once; documents are read whole, once a block, and never shuffled, so neither frequent documents nor frequent phrases
    can pile up anywhere. Null and short texts hold nothing; an item that occurs twice is reported under both ids, a
    repeated item row once; a document that holds several items has a row for each; empty tables give no rows. Stretches
    are unbroken but for single replaced words; ``indels`` admits single inserted and dropped words too.
    """
    kinds = [docs.schema[id_col].dataType, items.schema[item_col].dataType]
    schema = T.StructType([T.StructField("doc_id", kinds[0]), T.StructField("item_id", kinds[1]), T.StructField("words", T.IntegerType())])
    slim = spread(docs.filter(F.length(text_col) > 0).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    result = None
    for block in _blocks(items, item_col, item_text_col):
        sent = docs.sparkSession.sparkContext.broadcast(CgkIndex(block))

        def run(batches: Iterable[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            index = sent.value
            for pdf in batches:
                for part in range(0, len(pdf), 200):
                    ids = pdf["doc_id"].iloc[part : part + 200].tolist()
                    texts = [word_ids(t, index.ids) for t in pdf["text"].iloc[part : part + 200]]
                    rows = []
                    for d, i in sorted(index.candidates(texts, indels)):
                        held = held_words(texts[d], index.passages[i], indels)
                        if held >= min_words:
                            rows.append((ids[d], index.items[i][0], held))
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "words"])

        got = slim.mapInPandas(run, schema)
        result = got if result is None else result.unionByName(got)
    return result
