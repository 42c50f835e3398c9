"""Language of documents and of their segments by Bayesian evidence fusion.

Text likelihoods (words, and letter trigrams for unknown words) are combined with the declared markup language, by how
often its labels were found right, the address suffix and host priors. A class for all other languages takes texts of
which too few words are known. The priors come from grouped aggregation and are smoothed hierarchically: a host is
shrunk towards its suffix, a suffix towards the whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typolens.llm.blocks import furniture_mask, nav_set
from typolens.session import spread

LANGUAGES = ["en", "de", "nl", "fr", "es", "pt", "pl"]
#: Three-letter codes (terminological and bibliographic) and their two-letter form.
THREE = {"eng": "en", "deu": "de", "ger": "de", "nld": "nl", "dut": "nl", "fra": "fr", "fre": "fr", "spa": "es", "por": "pt", "pol": "pl"}
#: Codes by which a label names no language.
NO_LANGUAGE = ["und", "mul", "zxx", "mis", "x", "xx", "qaa", "none", "null", "nan"]
#: Letters-only words of the usual dummy text.
DUMMY = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco "
    "laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident "
    "sunt culpa qui officia deserunt mollit anim id est laborum"
).split()
#: Labelled pages whose text the likelihoods are fitted on.
SAMPLE_PAGES = 1500
MIN_SEGMENT_WORDS = 8
_LETTERS = re.compile(r"[^\W\d_]+")
#: Classes: the languages, dummy text, and any other language or none.
_L = len(LANGUAGES)
_DUMMY, _OTHER, _K = _L, _L + 1, _L + 2
#: Prior of the last two classes, and the share of words of another language that happen to be known.
RARE_PRIOR, OTHER_PRIOR, KNOWN_ELSEWHERE = 1e-3, 1e-2, 0.25
#: No language is reported below this confidence.
MIN_CONFIDENCE = 0.5
_CACHE = 200_000


def label_language(c: Column) -> Column:
    """Two-letter language that a label names, ``?`` if it is null, blank or names none; the region is ignored."""
    head = F.lower(F.regexp_extract(F.trim(c), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    three = F.create_map(*[x for k, v in THREE.items() for x in (F.lit(k), F.lit(v))])
    code = F.coalesce(three[head], head)
    return F.when(c.isNull() | (code == "") | code.isin(NO_LANGUAGE), "?").otherwise(code)


@dataclass
class TextModel:
    """Relative log likelihoods of words and trigrams for the languages and dummy text.

    ``known`` is the share of a text's words that the vocabulary has, if its language is one of these; ``label`` has the
    log probability of each declared language (column) where the text is in a language (row).
    """

    words: dict[str, int]
    matrix: np.ndarray
    trigrams: dict[str, np.ndarray]
    known: float = KNOWN_ELSEWHERE
    label: np.ndarray = field(default_factory=lambda: np.zeros((_L, _L)))
    extra: dict[str, np.ndarray] = field(default_factory=dict)

    def unknown(self, word: str) -> np.ndarray:
        v = self.extra.get(word)
        if v is None:
            w = f" {word} "
            parts = [self.trigrams[t] for t in (w[i : i + 3] for i in range(len(w) - 2)) if t in self.trigrams]
            v = np.clip(0.5 * np.sum(parts, axis=0), -2, 2) if parts else np.zeros(_L + 1)
            if len(self.extra) < _CACHE:
                self.extra[word] = v
        return v

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood per text and class, and the number of words."""
        get = self.words.get
        ids: list[int] = []
        rest: list[tuple[int, str]] = []
        n = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            found = _LETTERS.findall(text.lower())
            n[i] = len(found)
            for w in found:
                k = get(w, -1)
                ids.append(k)
                if k < 0:
                    rest.append((i, w))
        out = np.zeros((len(texts), _K))
        if ids:
            at = np.repeat(np.arange(len(texts)), n)
            k = np.array(ids)
            known = k >= 0
            for c in range(_L + 1):
                out[:, c] = np.bincount(at[known], weights=self.matrix[k[known], c], minlength=len(texts))
            found_n = np.bincount(at[known], minlength=len(texts))
            out[:, _OTHER] = found_n * np.log(KNOWN_ELSEWHERE / self.known) + (n - found_n) * np.log((1 - KNOWN_ELSEWHERE) / (1 - self.known))
        for i, w in rest:
            out[i, : _L + 1] += self.unknown(w)
        return out, n


def _relative(counts: np.ndarray, alpha: float) -> np.ndarray:
    p = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * len(counts))
    return p - p.mean(axis=1, keepdims=True)


def fit_text_model(rows: list[tuple[str, str]], rounds: int = 3) -> TextModel:
    """Fit on ``(language, line)`` rows whose labels may be wrong: lines are relabelled by the fitted model each round."""
    known = {k: i for i, k in enumerate(LANGUAGES)}
    votes: dict[tuple[str, ...], np.ndarray] = {}
    for k, t in rows:
        w = tuple(_LETTERS.findall(t.lower()))
        if w and k in known:
            votes.setdefault(w, np.zeros(_L))[known[k]] += 1
    lines = list(votes)
    given = np.array([votes[w] for w in lines]).reshape(-1, _L)
    total = given.sum(axis=1, keepdims=True)
    # A line that stands on many pages votes by the shares of their labels, and at most fifty times.
    weight = given / np.maximum(total, 1) * np.minimum(total, 50)
    model = None
    for r in range(max(1, rounds)):
        words: dict[str, np.ndarray] = {}
        for w, c in zip(lines, weight):
            for x in w:
                words.setdefault(x, np.zeros(_L + 1))[:_L] += c
        for x in DUMMY:
            words.setdefault(x, np.zeros(_L + 1))[_DUMMY] += max(20.0, words[x].sum() * 2 if x in words else 20.0)
        vocab = sorted(w for w, c in words.items() if c.sum() >= 3)
        counts = np.array([words[w] for w in vocab]) if vocab else np.zeros((0, _L + 1))
        matrix = np.clip(_relative(counts, 0.3), -4, 4) if vocab else counts
        tri: dict[str, np.ndarray] = {}
        for w, c in zip(vocab, counts):
            s = f" {w} "
            seen = np.minimum(c, 1 + np.log1p(c))
            for i in range(len(s) - 2):
                tri.setdefault(s[i : i + 3], np.zeros(_L + 1)).__iadd__(seen)
        keys = sorted(tri)
        rel = np.clip(_relative(np.array([tri[t] for t in keys]), 1.0), -2, 2) if keys else []
        model = TextModel({w: i for i, w in enumerate(vocab)}, matrix.astype(np.float32), dict(zip(keys, rel)))
        if lines:
            # A word counts as known if the vocabulary would have it without this line.
            sizes = {w: c.sum() for w, c in words.items()}
            tokens = [sizes[x] >= 4 for w in lines for x in w]
            model.known = float(np.clip(np.mean(tokens), 0.6, 0.95)) if vocab else KNOWN_ELSEWHERE
            ll, _ = model.score([" ".join(w) for w in lines])
            best = (ll[:, :_L] + np.log((given + 1) / (total + _L))).argmax(axis=1)
            # How labels and texts go together, by lines; each label is wrong now and then.
            seen_as = np.zeros((_L, _L))
            np.add.at(seen_as, best, np.minimum(given, 50))
            model.label = np.log((seen_as + 1) / (seen_as.sum(axis=1, keepdims=True) + _L))
            weight = np.zeros_like(given)
            weight[np.arange(len(lines)), best] = np.minimum(total[:, 0], 50)
    return model


def language_priors(pages: DataFrame, host_col: str, lang_col: str, strength: float = 5.0) -> DataFrame:
    """``host, prior`` (log probabilities of ``LANGUAGES``), hosts shrunk to their suffix, suffixes to the whole.

    Grouped counts of declared languages; only the tables of suffixes and of the whole are broadcast (the public
    address suffixes are a bounded set of short strings; a longer tail is joined by shuffle if it outgrows the limit).
    """
    d = label_language(F.col(lang_col))
    one = [F.sum(F.when(d == k, 1.0).otherwise(0.0)).alias(k) for k in LANGUAGES]
    host = F.coalesce(F.lower(F.col(host_col)), F.lit(""))
    hosts = pages.groupBy(host.alias("host")).agg(*one).withColumn("suffix", F.element_at(F.split("host", "\\."), -1))
    total = hosts.agg(*[F.sum(k).alias(k) for k in LANGUAGES]).first()
    mass = sum((total[k] or 0.0) + 1.0 for k in LANGUAGES)
    whole = {k: ((total[k] or 0.0) + 1.0) / mass for k in LANGUAGES}
    n = lambda prefix="": sum((F.col(prefix + k) for k in LANGUAGES), F.lit(0.0))
    suffixes = hosts.groupBy("suffix").agg(*[F.sum(k).alias("s_" + k) for k in LANGUAGES])
    suffixes = suffixes.select("suffix", *[((F.col("s_" + k) + strength * whole[k]) / (n("s_") + strength)).alias("q_" + k) for k in LANGUAGES])
    joined = hosts.join(suffixes, "suffix")
    return joined.select("host", F.array(*[F.log((F.col(k) + strength * F.col("q_" + k)) / (n() + strength)).cast("float") for k in LANGUAGES]).alias("prior"))


def fuse(ev: np.ndarray, declared: str, prior: np.ndarray, label: np.ndarray | None = None) -> tuple[int, float, np.ndarray, np.ndarray]:
    """Main language (-1: none) and confidence of a page, and class and confidence of each segment.

    ``ev`` has a row per line: line number, words, is body, log likelihoods of the classes. ``label`` has the log
    probabilities of declared languages (columns) given the true one (rows). Words of a line are not independent, and
    lines of a page less so: their log likelihoods are tempered.
    """
    page = np.concatenate([prior.astype(float), [np.log(RARE_PRIOR), np.log(OTHER_PRIOR)]])
    if declared in LANGUAGES and label is not None:
        page[:_L] += label[:, LANGUAGES.index(declared)]
        page[_L:] += np.log(1 / _L)
    ll = 0.7 * ev[:, 3:]
    words, body = ev[:, 1], ev[:, 2] > 0
    if not (body & (words > 0)).any():
        body = words > 0
    start = page + 0.3 * np.clip(ll[body].sum(axis=0), -200, 200) if body.any() else page
    start = start - start.max()
    soft = np.maximum(start - np.log(np.exp(start).sum()), -4.0)
    post = ll + soft
    best = post.argmax(axis=1)
    e = np.exp(post - post.max(axis=1, keepdims=True))
    conf = e[np.arange(len(e)), best] / e.sum(axis=1)
    votes = np.bincount(best[body], weights=words[body], minlength=_K)
    votes[_DUMMY] = 0
    main = int(votes.argmax())
    if not votes.any() or main == _OTHER:
        return -1, 0.0, best, conf
    mine = body & (best == main)
    return main, float((votes[main] + 1e-9) / (votes.sum() + 1e-9) * np.average(conf[mine], weights=words[mine])), best, conf


def _evidence(model: TextModel):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, tuple] = {}
        for pdf in batches:
            texts = [t.split("\n") for t in pdf["text"]]
            masks = furniture_mask(((t, nav_set(n)) for t, n in zip(texts, pdf["nav"])), seen)
            flat = [x for t in texts for x in t]
            ll, _ = model.score(flat)
            # Words as runs between white space that hold a letter.
            words = np.array([sum(1 for w in x.split() if w.lower() != w.upper()) for x in flat], dtype=np.float32)
            cuts = np.cumsum([len(t) for t in texts])
            packed = []
            for a, b, m in zip(np.r_[0, cuts[:-1]], cuts, masks):
                ev = np.column_stack([np.arange(b - a), words[a:b], ~m, ll[a:b]]).astype(np.float32)
                packed.append(ev[ev[:, 1] > 0].tobytes())
            yield pd.DataFrame({"page_id": pdf["id"], "host": pdf["host"], "declared": pdf["declared"], "ev": packed})

    return run


def _decide(label: np.ndarray):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for pid, declared, ev, prior in zip(pdf["page_id"], pdf["declared"], pdf["ev"], pdf["prior"]):
                rows = np.frombuffer(ev, dtype=np.float32).reshape(-1, 3 + _K)
                if not len(rows):
                    continue
                main, conf, best, c = fuse(rows, declared, np.full(_L, -np.log(_L)) if prior is None else np.asarray(prior), label)
                if main < 0:
                    continue
                out.append((pid, -1, LANGUAGES[main], conf, declared != LANGUAGES[main]))
                for r, k, p in zip(rows, best, c):
                    if r[1] >= MIN_SEGMENT_WORDS and k < _L and p >= MIN_CONFIDENCE:
                        out.append((pid, int(r[0]), LANGUAGES[k], float(p), bool(k != main)))
            yield pd.DataFrame(out, columns=["page_id", "line_no", "lang", "confidence", "differs"]).astype({"line_no": np.int32, "confidence": float, "differs": bool})

    return run


def sample_lines(pages: DataFrame, id_col: str, text_col: str, lang_col: str, sample_pages: int = SAMPLE_PAGES) -> list[tuple[str, str]]:
    """Lines of about ``sample_pages`` labelled pages (never over twice as many), always the same ones by hash of the id.

    A count first, then a threshold on the hash: tasks send only rows of the sample, however many tasks there are.
    """
    labelled = pages.filter(F.length(text_col) > 0).select(F.xxhash64(id_col).alias("h"), label_language(F.col(lang_col)).alias("k"), F.col(text_col).alias("t")).filter(F.col("k").isin(LANGUAGES))
    total = labelled.count()
    if total > sample_pages:
        labelled = labelled.filter(F.col("h") < int(-(2**63) + 2**64 * (sample_pages / total)))
    return [(r["k"], line) for r in labelled.limit(2 * sample_pages).collect() for line in r["t"].split("\n")]


def page_languages(pages: DataFrame, id_col: str = "page_id", text_col: str = "main_content", lang_col: str = "lang", host_col: str = "domain", nav_col: str = "nav_links", model: TextModel | None = None) -> DataFrame:
    """``page_id, line_no, lang, confidence, differs`` for each page (``line_no`` -1) and each line of eight words or more.

    ``differs`` says for a page that its label is missing or names another language, for a line that it is in another
    language than the page's main one (that of most words of the main body). Pages without text, without letters or
    with nothing but dummy text have no rows, nor have pages mainly in another language than ``LANGUAGES`` and lines in
    another one or below ``MIN_CONFIDENCE``; a null host gets the prior of the whole. If no page is labelled, the
    text model is empty and the priors decide. Likelihoods are fitted on a bounded sample (``SAMPLE_PAGES`` labelled pages),
    priors on all. Only evidence (48 bytes a line), never text, is shuffled to the host priors; AQE splits a hot host.
    """
    model = model or fit_text_model(sample_lines(pages, id_col, text_col, lang_col))
    kind = pages.schema[id_col].dataType
    slim = pages.filter(f"length({text_col}) > 0").select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(nav_col).alias("nav"), F.coalesce(F.lower(F.col(host_col)), F.lit("")).alias("host"), label_language(F.col(lang_col)).alias("declared"))
    string = T.StringType()
    ev = spread(slim).mapInPandas(_evidence(model), T.StructType([T.StructField("page_id", kind), T.StructField("host", string), T.StructField("declared", string), T.StructField("ev", T.BinaryType())]))
    fused = ev.join(language_priors(pages, host_col, lang_col), "host", "left").select("page_id", "declared", "ev", "prior")
    schema = T.StructType([T.StructField("page_id", kind), T.StructField("line_no", T.IntegerType()), T.StructField("lang", string), T.StructField("confidence", T.DoubleType()), T.StructField("differs", T.BooleanType())])
    return fused.mapInPandas(_decide(model.label), schema)
