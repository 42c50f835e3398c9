"""Main content of web pages.

A page is a sequence of flat text blocks (lines). Each block gets its word count, link density, the same of its
neighbours and how much of it furniture phrases cover; a decision tree trained on a small labelled table decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from typolens.llm.lexicon import COMMON, FURNITURE, MENU_LABELS
from typolens.llm.tree import Tree, fit_tree
from typolens.session import spread

FEATURES = ["words", "link", "phrase", "separators", "sentence", "prev_words", "next_words", "prev_link", "next_link", "prev_phrase", "next_phrase"]
_SEPARATOR = re.compile(r"\s*[|•·›»>/]\s*|\s{2,}")
_WORD_CHAR = re.compile(r"\w")
#: Features of a block alone are kept per distinct block, up to this many.
CACHE = 50_000


@cache
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    words: dict[str, tuple[int, int]] = {}
    for text in MENU_LABELS.values():
        for label in text.split("|"):
            words[label] = (0, len(label))
    for text in [*FURNITURE.values(), *COMMON.values()]:
        for line in text.split("\n"):
            for phrase in line.split("|"):
                if len(phrase.strip()) > 2:
                    words.setdefault(phrase.strip(), (1, len(phrase.strip())))
    for w, v in words.items():
        a.add_word(w, v)
    a.make_automaton()
    return a


def _alone(line: str) -> tuple[int, float, float, float, float]:
    """Words, link density, phrase coverage, separators per word, ends like a sentence."""
    text = line.strip()
    if not text:
        return 0, 0.0, 0.0, 0.0, 0.0
    low = text.lower()
    n = len(low)
    spans: tuple[list[tuple[int, int]], list[tuple[int, int]]] = ([], [])
    for end, (kind, size) in _automaton().iter(low):
        start = end - size + 1
        if (start and low[start - 1].isalnum() and low[start].isalnum()) or (end + 1 < n and low[end + 1].isalnum() and low[end].isalnum()):
            continue
        spans[kind].append((start, end + 1))
    cover = []
    for s in spans:
        at = got = 0
        for a, b in sorted(s):
            if b > at:
                got += b - max(a, at)
                at = b
        cover.append(got)
    words = len(text.split())
    seps = len(_SEPARATOR.findall(text))
    letters = max(1, n - 2 * seps if seps else n)
    if text[0] in "©":
        cover[1] += n // 4
    return words, min(1.0, cover[0] / letters), min(1.0, cover[1] / n), seps / words, float(text[-1] in ".!?…")


def block_features(lines: list[str], nav: frozenset[str], seen: dict[str, tuple]) -> np.ndarray:
    """One row of ``FEATURES`` per line. ``nav`` has the page's menu labels in lower case; it may be incomplete."""
    own = np.empty((len(lines), 5))
    for i, line in enumerate(lines):
        f = seen.get(line)
        if f is None:
            f = _alone(line)
            if len(seen) < CACHE:
                seen[line] = f
        if f[1] < 1 and nav and f[0] <= 30 and not f[4]:
            parts = [p for p in _SEPARATOR.split(line.strip().lower()) if p]
            hit = sum(len(p) for p in parts if p in nav)
            if hit:
                # A single entry may as well be a heading that the menu repeats: a weak hint only.
                f = (f[0], max(f[1], (0.6 if len(parts) > 1 else 0.1) * hit / sum(map(len, parts))), *f[2:])
        own[i] = f
    full = own[:, 0] > 0
    out = np.zeros((len(lines), len(FEATURES)))
    out[:, :5] = own
    at = np.flatnonzero(full)
    if len(at):
        block = own[at]
        before = np.vstack([np.zeros((1, 5)), block[:-1]])
        after = np.vstack([block[1:], np.zeros((1, 5))])
        for j, c in ((5, 0), (7, 1), (9, 2)):
            out[at, j] = before[:, c]
            out[at, j + 1] = after[:, c]
    return out


def _labelled() -> tuple[np.ndarray, np.ndarray]:
    from typolens.llm.block_labels import PAGES

    xs, ys = [], []
    for page in PAGES:
        rows = [r for r in page.strip().split("\n") if r.strip()]
        nav = frozenset(x.strip().lower() for x in rows[0].split(";") if x.strip()) if rows[0].startswith(";") else frozenset()
        rows = rows[1:] if rows[0].startswith(";") else rows
        xs.append(block_features([r[2:] for r in rows], nav, {}))
        ys.append(np.array([r[0] == "F" for r in rows], dtype=int))
    return np.vstack(xs), np.concatenate(ys)


@cache
def block_tree() -> Tree:
    """The tree of the labelled table in ``block_labels`` (fitted once per process; a few hundred rows)."""
    return fit_tree(*_labelled(), max_depth=8, min_leaf=2)


def furniture_mask(pages: Iterable[tuple[list[str], frozenset[str]]], seen: dict[str, tuple]) -> list[np.ndarray]:
    """For each page, which of its lines are not main body. Blank lines are never furniture."""
    pages = list(pages)
    feats = [block_features(lines, nav, seen) for lines, nav in pages]
    if not feats:
        return []
    is_f = block_tree().predict(np.vstack(feats)).astype(bool)
    cuts = np.cumsum([len(f) for f in feats])[:-1]
    return [m & (f[:, 0] > 0) for m, f in zip(np.split(is_f, cuts), feats)]


def nav_set(labels: Iterable[str] | None) -> frozenset[str]:
    if labels is None:
        return frozenset()
    return frozenset(x.strip().lower() for x in labels if x and x.strip())


def boilerplate_lines(pages: DataFrame, id_col: str = "page_id", text_col: str = "main_content", nav_col: str = "nav_links") -> DataFrame:
    """``page_id, line_no`` of every line that is not main body; lines are split at line feeds and counted from 0.

    A narrow map over Arrow batches: no shuffle, nothing broadcast but the small tree, whole texts. Null or empty
    texts give no rows, null or empty menus are allowed (also null entries), repeated pages are judged alike, other
    columns are ignored.
    """
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, tuple] = {}
        for pdf in batches:
            ids = pdf["id"].to_numpy()
            masks = furniture_mask(((t.split("\n"), nav_set(n)) for t, n in zip(pdf["text"], pdf["nav"])), seen)
            at = [np.flatnonzero(m) for m in masks]
            yield pd.DataFrame({"page_id": np.repeat(ids, [len(a) for a in at]), "line_no": np.concatenate(at).astype(np.int32) if at else []})

    kind = pages.schema[id_col].dataType
    schema = T.StructType([T.StructField("page_id", kind), T.StructField("line_no", T.IntegerType())])
    slim = pages.filter(f"length({text_col}) > 0").selectExpr(f"{id_col} AS id", f"{text_col} AS text", f"{nav_col} AS nav")
    return spread(slim).mapInPandas(run, schema)


def main_bodies(pages: DataFrame, id_col: str = "page_id", text_col: str = "main_content", nav_col: str = "nav_links") -> DataFrame:
    """``page_id, main_body``: each page's text without the lines of ``boilerplate_lines``; null stays null."""
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, tuple] = {}
        for pdf in batches:
            texts = [None if t is None else t.split("\n") for t in pdf["text"]]
            masks = furniture_mask(((t or [""], nav_set(n)) for t, n in zip(texts, pdf["nav"])), seen)
            yield pd.DataFrame({"page_id": pdf["id"], "main_body": [None if t is None else "\n".join(x for x, f in zip(t, m) if not f) for t, m in zip(texts, masks)]})

    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("main_body", T.StringType())])
    return pages.selectExpr(f"{id_col} AS id", f"{text_col} AS text", f"{nav_col} AS nav").transform(spread).mapInPandas(run, schema)
