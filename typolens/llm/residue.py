"""Template residue, filler and error-page text.

Numbers, addresses and dates are masked, so that copies of one message agree; exact hashes of the masked text are
grouped across sources, and each distinct message is classified once by phrase and placeholder rules. Some phrases stand
in error messages and in ordinary sentences alike: they count only for a line that recurs on several sources, as messages
of servers and shop systems do.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache
from re import _constants as C
from re import _parser

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typolens.session import cut, spread

PLACEHOLDER, FILLER, MESSAGE = "placeholder", "filler", "message"

#: Digits are masked before the rules apply, hence the hash sign.
_NAME = r"[A-Za-z_][\w.:#-]*"
#: Unfilled placeholders and leaked program values, by syntax.
PLACEHOLDERS = [
    r"\{\{\{?\s*[^{}]+\}\}\}?", r"\{%[^%{}]+%\}", r"<%[=#-]?[^%<>]+%>", r"<\?(?:php|=)[^<>]*\?>", r"[$#]\{\s*[^{}]+\}",
    rf"%%{_NAME}%%", rf"@@{_NAME}@@", rf"\b__{_NAME}__\b", rf"\[\[\s*{_NAME}\s*\]\]", r"\*\|[A-Z_:#]+\|\*", r"\[(?:INSERT|ENTER|ADD|YOUR|TODO)\b[^\[\]]*\]",
    r"\[(?i:your|first|last|full|company|product|customer|user|brand|shop)[ _-](?i:name|title|e-?mail|company|address|text|city|website)\]", r"\[(?i:insert|enter|add) [^\[\]]+\]",
    r"<(?:your|insert|enter)\s[^<>]+>", rf"(?<![\w%])%{_NAME}%(?![\w%])", r"\{(?:\d{1,2}|#)\}", r"\[object \w+\]", r"\{[a-z_]+(?:\.[a-z_]+)*\}",
    r"(?i:(?:warning|notice|fatal error|parse error|uncaught \w+): .*(?:undefined|uncaught|unexpected)\b.*\bline \S+)",
]
#: A whole field that is nothing but a leaked value, alone or as one part of a composed title.
LEAKED_PARTS = r"(?i)^(?:undefined|null|nan|none|n/?a|\(null\)|untitled(?: document| page)?|new page|document)$"
#: Wording that says that a placeholder is spoken of. It counts only where it touches that placeholder, as pages that
#: mention templates hold unfilled ones as well.
SPOKEN_BEFORE = r"(?i)\b(?:(?:we|you|they) (?:write|type)|type in|placeholders?(?: is| are| like| such as| called| named)?|syntax(?: is| of| for| like)?|(?:brackets|braces)(?: like| such as| as in)?)[:,]?\s*[\"'`“„‘«(]*$"
SPOKEN_AFTER = r"(?i)^[\"'`”“’»)]*\s*(?:(?:(?:is|are|was|were|gets?|will be|must be)\s+)?replaced (?:by|with)|(?:is|are|as) (?:a |an |the )?(?:placeholders?|syntax)|(?:placeholders?|syntax)|(?:in|into|to) (?:the|your|a) (?:\w+ ){0,3}(?:field|box|form))\b"
#: What may stand between placeholders that are listed.
SPOKEN_LIST = r"(?i)^[\"'`”’»)]*\s*(?:,|/|,?\s*\b(?:and|or)\b)\s*[\"'`“„‘«(]*$"

LOREM = "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident culpa officia deserunt mollit laborum ut et do ad in ex ea id est non eu"
_LOREM_WORDS = frozenset(LOREM.split())
_LOREM_SHORT = frozenset("ut et do ad in ex ea id est non eu sed".split())

#: Filler and sample texts.
FILLERS = [
    r"\b(?:your |add |insert |enter )?(?:content|text|headline|title|description) (?:goes|comes) here\b", r"\b(?:your|add|insert|enter)(?: (?:a|your|some|short))* (?:content|text|headline|title|description) here\b", r"\b(?:asdf\s*){2,}", r"\bqwertz?\b.*\btest\b", r"\btest test\b", r"\bignore this test\b", r"\bthis (?:entry|post|page|text) is (?:a|only a|just a) (?:sample|placeholder|test)\b",
    r"\bclick\b.*\bto edit\b", r"\b(?:edit|change|replace)(?: it| this)? or delete (?:it|this)\b", r"\badd (?:a|an|your|some)\b.*\b(?:description|text|title|sentence|paragraph|content)\b.*\bhere\b", r"\breplace this (?:text|page|paragraph|sentence|content)\b", r"\bhier (?:steht|kommt) (?:ihr|ein) text\b", r"\bsample (?:text|page)\s*[.:!]?$", r"\bthis is (?:a sample|your first|an example) (?:page|post|text|product)\b",
    r"\bthe quick brown fox\b", r"\bxxx+\b", r"\btbd\b|\bto be (?:added|announced|written) soon\b", r"\btodo:", r"\bblindtext\b", r"\btexto de (?:ejemplo|exemplo|prueba)\b", r"\btexte d'exemple\b", r"\bvoorbeeldtekst\b", r"\bprzykładowy tekst\b",
]

#: Messages of errors, denials, checks, maintenance and scripts; each must open the line.
MESSAGES = [
    # errors and missing pages
    r"^(?:error|fehler|fout|erreur|erro|błąd)?\s*#?\s*[:!.-]?\s*.{0,40}\b(?:page|seite|pagina|página|strona|link|resource|file|url)\b.*\b(?:could not be found|cannot be found|was not found|not found|nicht gefunden|existiert nicht|niet gevonden|bestaat niet|introuvable|n'existe pas|no se encuentra|no existe|não foi encontrada|não existe|nie istnieje|does not exist|doesn't exist|never existed|has expired|została usunięta|has been removed)\b",
    r"^(?:error|fehler|fout|erreur|erro|błąd) #?\s?:", r"^# (?:not found|forbidden|service (?:temporarily )?unavailable|bad gateway|gateway time-?out|internal server error|unauthorized|gone|too many requests|backend fetch failed)\b",
    r"^(?:page not found|not found|error|an error occurred|server error|seite nicht gefunden|pagina niet gevonden|page introuvable|página no encontrada|página não encontrada|nie znaleziono strony)\W*(?:#)?$",
    r"^(?:sorry|oops|entschuldigung|désolé|lo sentimos|przepraszamy)\b.*\b(?:wrong|error|fehler|erreur|problem)\b", r"\bsomething went wrong\b", r"\bse ha producido un (?:error|fallo)\b", r"\bes ist ein fehler aufgetreten\b", r"\bune erreur (?:s'est produite|est survenue)\b", r"\bocorreu um erro\b", r"\bwystąpił błąd\b", r"\ber is (?:een fout|iets mis) ?(?:opgetreden|gegaan)\b",
    r"^error (?:establishing|connecting|loading|opening|reading|processing|fetching|saving)\b", r"\b(?:database|connection)\b.*\b(?:could not|cannot|can't|failed to) be (?:established|opened|made)\b", r"\bstack trace:", r"\buncaught exception\b", r"^(?:the )?(?:request|connection|server|gateway)(?: has)? (?:timed out|refused|reset)\b", r"\bservice (?:temporarily )?unavailable\b",
    # denial and checks
    r"^access denied\W*$", r"\baccess to (?:this|the) (?:resource|page|site) (?:was|is|has been) (?:denied|forbidden|blocked)\b", r"\b(?:unusual|suspicious|automated) (?:traffic|activity|requests?)\b.*\b(?:your|detected)\b", r"^too many requests\b", r"\b(?:verify|verifying|check|checking)\b.*\b(?:you are|connection|comes from)\b.*\b(?:human|person|robot|browser)\b", r"\bchecking your browser\b", r"\byou have been blocked\b", r"\b(?:complete|solve|enter) (?:the|this) captcha\b", r"\b(?:zugriff|acceso|accès|acesso|toegang|dostęp).{0,30}(?:verweigert|denegado|refusé|negado|geweigerd|zabroniony)\b",
    # maintenance
    r"^maintenance mode\W*$", r"^(?:# )?(?:bad gateway|gateway time-?out|service unavailable|internal server error|forbidden|unauthorized)\W*$", r"^(?:one|just a) moment\b.{0,20}$", r"\b(?:site|shop|store|service|page) is (?:currently |temporarily )?(?:down for|under|in) maintenance\b", r"\bunder maintenance\b", r"\bscheduled maintenance\b",
    r"\b(?:dienst|seite|service|servicio|serviço|usługa|strona|dienst)\b.{0,40}\b(?:zurzeit nicht erreichbar|momentanément indisponible|no está disponible|não está disponível|jest niedostępna|niet beschikbaar|nicht verfügbar)\b", r"\b(?:wartungsarbeiten|en maintenance|en mantenimiento|em manutenção|onderhoudswerkzaamheden|przerwa techniczna)\b",
    # scripts
    r"\b(?:turn on|enable|allow|activate|aktivieren sie|activer|active|ative|włącz|zet|schakel).{0,30}\b(?:javascript|scripts?)\b.*\b(?:browser|navegador|navigateur|przeglądarce|browser|continue|view|page)\b", r"\b(?:javascript|scripts?|scripting)\b.*\b(?:switched off|is off|disabled|is required|are required|must be enabled|are allowed)\b", r"\bbrowser does not (?:run|support) (?:java)?scripts?\b",
    # default names of empty pages
    r"^(?:untitled(?: document| page)?|default (?:page|web ?site)|new page|index of /.*|welcome to nginx.*|it works!?|coming soon\W*|just a moment\W*|null|undefined|home \| undefined|maintenance)$",
]
#: Phrases that messages share with ordinary sentences.
COMMON = [
    r"\b(?:try again|come back later|reload|(?:re)?load (?:the|this) page|wait (?:a|some|#))\b", r"\b(?:was|is|been|got) (?:denied|forbidden|blocked|refused|interrupted)\b", r"\b(?:cannot|could not|can't|unable to) (?:load|display|show|connect|process|handle|complete)\b", r"\btimed out\b", r"\bcaptcha\b", r"\bback (?:soon|shortly|online)\b", r"\bnot available (?:in your|at this|right now|at the moment)\b",
]
#: Sources on which a line of a common phrase must stand.
RECURS = 3

_PLACEHOLDER = re.compile("|".join(f"(?:{p})" for p in PLACEHOLDERS))
_BEFORE, _AFTER, _LIST = re.compile(SPOKEN_BEFORE), re.compile(SPOKEN_AFTER), re.compile(SPOKEN_LIST)
#: Characters before a placeholder that hold the wording that touches it.
_NEAR = 60
_FILLER = re.compile("(?i)" + "|".join(f"(?:{p})" for p in FILLERS))
_MESSAGE = [re.compile("(?i)" + p) for p in MESSAGES]
_COMMON = re.compile("(?i)" + "|".join(f"(?:{p})" for p in COMMON))
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_LEAKED = re.compile(LEAKED_PARTS)
_PARTS = re.compile(r"\s+[|–:-]+\s+|\s+::\s+")
_WORDS = re.compile(r"[^\W\d_]+")
_CACHE = 50_000

#: Most literals that one place of a rule is multiplied out to.
_MOST_LITERALS = 64


def _exact(op, arg) -> set[str] | None:
    """All texts that this part of a pattern matches, if they are few and plain."""
    if op is C.LITERAL:
        return {chr(arg)}
    if op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
        return {""}
    if op is C.IN and all(o is C.LITERAL for o, _ in arg):
        return {chr(x) for _, x in arg}
    if op is C.SUBPATTERN:
        return _product(arg[-1])
    if op is C.BRANCH:
        parts = [_product(p) for p in arg[1]]
        return None if None in parts else _few(set().union(*parts))
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[:2] == (0, 1):
        one = _product(arg[2])
        return None if one is None else one | {""}
    return None


def _few(texts: set[str]) -> set[str] | None:
    return texts if len(texts) <= _MOST_LITERALS else None


def _product(parts) -> set[str] | None:
    out: set[str] | None = {""}
    for op, arg in parts:
        one = _exact(op, arg)
        out = None if one is None else _few({x + y for x in out for y in one})
        if out is None:
            return None
    return out


def _needs(parts) -> set[str] | None:
    """Literals of which every match of a pattern holds one; of several such sets the one with the longest literals."""
    found: list[set[str]] = []
    run = {""}
    for op, arg in parts:
        one = _exact(op, arg)
        joined = None if one is None else _few({x + y for x in run for y in one})
        if joined is not None:
            run = joined
            continue
        found.append(run)
        run = one or {""}
        if one is None and op is C.SUBPATTERN:
            found.append(_needs(arg[-1]) or {""})
        elif one is None and op is C.BRANCH:
            branches = [_needs(p) for p in arg[1]]
            found.append({""} if None in branches else set().union(*branches))
        elif one is None and op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] > 0:
            inner = _product(arg[2])
            # What repeats stands there at least so often.
            found.append(_needs(arg[2]) or {""} if inner is None else _few({x * arg[0] for x in inner}) if len(inner) == 1 else inner)
    found.append(run)
    best = max(found, key=lambda s: min(map(len, s)))
    return best if min(map(len, best)) > 0 else None


def literals(pattern: str) -> set[str]:
    """Lower-case literals of which every text that ``pattern`` matches holds one."""
    need = _needs(_parser.parse(pattern))
    if need is None:
        raise ValueError(f"no literal is part of every match of {pattern}")
    return {x.lower() for x in need}


@cache
def _automaton() -> ahocorasick.Automaton:
    """Finds what the rules need in one pass. The literals come from the rules themselves; words of dummy text have the
    value 0, as two of them are needed."""
    need = dict.fromkeys(_LOREM_WORDS - _LOREM_SHORT, 0)
    for rule in PLACEHOLDERS + FILLERS + MESSAGES + COMMON:
        need.update(dict.fromkeys(literals(rule), 1))
    a = ahocorasick.Automaton()
    for w, n in need.items():
        a.add_word(w, n)
    a.make_automaton()
    return a


_ADDRESS = re.compile(r"(?i)\b(?:https?://|www\.)[^\s<>\"]+|\b[\w.+-]+@[\w-]+\.[\w.]+\b")
_HEX = re.compile(r"(?i)\b(?=[0-9a-f]*\d)[0-9a-f]{6,}\b")
_DIGIT = re.compile(r"\d")
_NUMBER = re.compile(r"\d+(?:[.,:/-]\d+)*")


def mask(line: str) -> str:
    """Numbers, hexadecimal references, addresses and dates replaced by ``#``, white space collapsed, trimmed."""
    v = _ADDRESS.sub("#", line) if "@" in line or "://" in line or "www." in line.lower() else line
    if _DIGIT.search(v):
        v = _NUMBER.sub("#", _HEX.sub("#", v))
    return " ".join(v.split())


def _lower(text: str) -> str:
    """Lower case, with the letters that patterns without regard to case take for ``i`` and ``s`` as such."""
    low = text.lower()
    return low if low.isascii() else low.replace("i\u0307", "i").replace("\u0131", "i").replace("\u017f", "s")


def triggered(text: str) -> bool:
    """Whether a rule may apply to a masked line: false only if :func:`classify` gives None."""
    dummy = 0
    for _, kind in _automaton().iter(_lower(text)):
        if kind:
            return True
        dummy += 1
    return (dummy > 1 and _lorem(_WORDS.findall(text.lower()))) or _leaked(text)


def _leaked(text: str) -> bool:
    return any(_LEAKED.match(p) for p in _PARTS.split(text))


def _lorem(words: list[str]) -> bool:
    """A run of dummy-text words: six in a row, or ``lorem ipsum`` leading another one or standing alone."""
    run = strong = 0
    for i, w in enumerate(words):
        if w in _LOREM_WORDS:
            run += 1
            strong += w not in _LOREM_SHORT
            if run >= 6 and strong >= 4:
                return True
            if run >= 3 and words[i - run + 1 : i - run + 3] == ["lorem", "ipsum"]:
                return True
        else:
            run = strong = 0
    return words == ["lorem", "ipsum"] or (len(words) <= 5 and run >= 3 and strong >= 2)


def _unfilled(text: str) -> bool:
    """Whether a placeholder stands here that is not spoken of; one that is excuses only those listed with it."""
    at = [m.span() for m in _PLACEHOLDER.finditer(text)]
    spoken = [bool(_BEFORE.search(text[max(0, a - _NEAR) : a]) or _AFTER.match(text[b : b + _NEAR])) for a, b in at]
    listed = [bool(_LIST.match(text[x[1] : y[0]])) for x, y in zip(at, at[1:])]
    for k, also in enumerate(listed):
        spoken[k + 1] |= also and spoken[k]
    for k in reversed(range(len(listed))):
        spoken[k] |= listed[k] and spoken[k + 1]
    return not all(spoken)


def opening(text: str) -> str:
    """The first two sentences of a line."""
    return " ".join(_SENTENCE.split(text)[:2])


def classify(text: str, n_sources: int = 1) -> str | None:
    """Kind of a masked line (``placeholder``, ``filler``, ``message``) that stands on so many sources, or None.

    Placeholders and filler count anywhere in the line. A message is what the line opens with; a line that consists of
    nothing but one or two sentences of a common phrase counts if it recurs.
    """
    if not text:
        return None
    if _unfilled(text):
        return PLACEHOLDER
    if _leaked(text):
        return MESSAGE if text.lower().startswith("untitled") else PLACEHOLDER
    if _lorem(_WORDS.findall(text.lower())) or _FILLER.search(text):
        return FILLER
    first = opening(text)
    if any(m.search(first) for m in _MESSAGE):
        return MESSAGE
    if n_sources >= RECURS and len(_COMMON.findall(text)) > 1:
        return MESSAGE
    return None


def residue_messages(pages: DataFrame, id_col: str, fields: list[str], source_col: str) -> tuple[DataFrame, DataFrame]:
    """``(hits, messages)``: triggered lines with their hash, and each distinct masked line with ``kind`` and counts."""
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, str | None] = {}
        for pdf in batches:
            out = []
            for field in fields:
                for pid, source, text in zip(pdf["page_id"], pdf["source"], pdf[field]):
                    if not text:
                        continue
                    for line in text.split("\n"):
                        if line in seen:
                            m = seen[line]
                        else:
                            # The rules read masked lines, and so do their triggers.
                            m = mask(line)
                            m = m if triggered(m) else None
                            if len(seen) < _CACHE:
                                seen[line] = m
                        if m:
                            out.append((pid, source, field, m))
            yield pd.DataFrame(out, columns=["page_id", "source", "field_name", "masked"])

    string = T.StringType()
    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType), *(T.StructField(c, string) for c in ("source", "field_name", "masked"))])
    slim = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.lower(F.col(source_col)), F.lit("")).alias("source"), *[F.col(f).alias(f) for f in fields])
    # Both the messages and their way back to the fields need the hits; they are few, so they are kept once.
    hits = cut(spread(slim).mapInPandas(run, schema).withColumn("h", F.md5("masked")))
    messages = hits.groupBy("h").agg(F.first("masked").alias("masked"), F.count(F.lit(1)).alias("n_lines"), F.count_distinct("source").alias("n_sources"))

    @F.pandas_udf("string")
    def kind(texts: pd.Series, sources: pd.Series) -> pd.Series:
        return pd.Series([classify(t, n) for t, n in zip(texts, sources)], dtype=object)

    return hits.drop("masked"), messages.withColumn("kind", kind("masked", "n_sources")).filter("kind IS NOT NULL")


def residue_fields(pages: DataFrame, id_col: str = "page_id", fields: tuple[str, ...] = ("main_content", "title", "meta_description"), source_col: str = "domain") -> DataFrame:
    """``page_id, field_name, kinds`` of every field that holds residue, filler or an error or script message.

    Lines are masked and grouped by the exact hash of the masked text over all pages; each distinct line is judged
    once, by its rules and the number of hosts on which it recurs, and the verdict returns to its fields by an equi-join on the hash. Only lines that contain a trigger of some
    rule take part, so clean text is not shuffled. Null and empty fields and empty tables give no rows; a field with
    several findings has one row; repeated pages are judged alike; other columns are ignored.
    """
    hits, messages = residue_messages(pages, id_col, list(fields), source_col)
    found = hits.join(messages.select("h", "kind"), "h")
    return found.groupBy("page_id", "field_name").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))


def residue_report(pages: DataFrame, id_col: str = "page_id", fields: tuple[str, ...] = ("main_content", "title", "meta_description"), source_col: str = "domain", min_sources: int = 2) -> DataFrame:
    """The recurring messages: masked text, kind, lines and number of sources, at least ``min_sources``."""
    _, messages = residue_messages(pages, id_col, list(fields), source_col)
    return messages.filter(F.col("n_sources") >= min_sources).select("masked", "kind", "n_lines", "n_sources")
