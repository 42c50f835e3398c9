import numpy as np
from pyspark.sql import functions as F

from typolens.llm.language import LANGUAGES, fit_text_model, fuse, label_language, language_priors, page_languages, sample_lines

TEXT = {
    "en": "The house on the hill was built by a farmer who wanted to see the river from every window of his room",
    "de": "Das Haus auf dem Hügel wurde von einem Bauern gebaut, der den Fluss aus jedem Fenster sehen wollte und sonst nichts",
    "nl": "Het huis op de heuvel werd gebouwd door een boer die de rivier uit elk raam van zijn kamer wilde zien en niets anders",
    "fr": "La maison sur la colline a été construite par un paysan qui voulait voir la rivière de chaque fenêtre de sa chambre",
    "es": "La casa de la colina fue construida por un campesino que quería ver el río desde cada ventana de su habitación",
    "pt": "A casa na colina foi construída por um camponês que queria ver o rio de cada janela do seu quarto e nada mais",
    "pl": "Dom na wzgórzu został zbudowany przez chłopa, który chciał widzieć rzekę z każdego okna swojego pokoju i nic więcej",
}
SCHEMA = "page_id long, domain string, lang string, main_content string, nav_links array<string>, confidence string"


def model():
    return fit_text_model([(k, t) for k, t in TEXT.items()] * 3 + [("en", TEXT["de"])])


def test_labels(spark):
    rows = [(x,) for x in ("en", "EN-us", "deu", "pt_BR", "x-default", "und", "??", "", " ", None, "it", "Ger")]
    got = [r[0] for r in spark.createDataFrame(rows, "c string").select(label_language(F.col("c"))).collect()]
    assert got == ["en", "en", "de", "pt", "?", "?", "?", "?", "?", "?", "it", "de"]


def test_text_model_survives_wrong_labels():
    m = model()
    ll, n = m.score([TEXT[k] for k in LANGUAGES])
    assert ll.argmax(axis=1).tolist() == list(range(7)) and (n > 10).all()
    assert m.score(["lorem ipsum dolor sit amet consectetur"])[0].argmax() == 7


def test_pages(spark):
    mixed = TEXT["en"] + ".\n" + TEXT["en"] + ".\n" + TEXT["pl"] + "."
    rows = [
        (1, "a.com", "en", mixed, None, ""), (2, "a.com", None, TEXT["de"] + ".", ["x"], ""), (3, "b.nl", "fr", TEXT["nl"] + ".", None, ""), (4, None, "pt-BR", TEXT["pt"] + ".", None, ""),
        (5, "b.nl", "en", "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod", None, ""), (6, "b.nl", "en", None, None, ""), (7, "b.nl", "en", "12 34", None, ""), (2, "a.com", None, TEXT["de"] + ".", ["x"], ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = page_languages(df, model=model())
    found = sorted((r["page_id"], r["line_no"], r["lang"]) for r in got.filter("differs").collect())
    assert found == [(1, 2, "pl"), (2, -1, "de"), (2, -1, "de"), (3, -1, "nl")]
    assert all(0 <= r["confidence"] <= 1.0001 for r in got.collect())
    assert page_languages(df.limit(0)).collect() == []


def test_priors_shrink(spark):
    rows = [(1, "a.nl", "nl", "", None, "")] * 20 + [(2, "b.nl", None, "", None, ""), (3, "c.com", "en", "", None, "")]
    p = {r["host"]: np.exp(r["prior"]) for r in language_priors(spark.createDataFrame(rows, SCHEMA), "domain", "lang").collect()}
    nl, en = LANGUAGES.index("nl"), LANGUAGES.index("en")
    assert p["a.nl"][nl] > p["b.nl"][nl] > p["c.com"][nl] and abs(p["b.nl"].sum() - 1) < 1e-5 and p["c.com"][en] > p["a.nl"][en]


def test_prior_decides_short_text():
    ev = np.array([[0, 1, 1] + [0.0] * 9], dtype=np.float32)
    prior = np.log(np.array([0.02] * 6 + [0.88]))
    assert fuse(ev, "?", prior)[0] == 6
    label = np.log(np.where(np.eye(7) > 0, 0.94, 0.01))
    assert fuse(ev, "es", np.full(7, -1.9), label)[0] == LANGUAGES.index("es")
    # A label that is often wrong moves less than one that is right.
    often = np.log(np.where(np.eye(7) > 0, 0.16, 0.14))
    assert fuse(ev, "es", prior, often)[0] == 6


OTHERS = {
    "it": "La casa sulla collina fu costruita da un contadino che voleva vedere il fiume da ogni finestra della sua stanza",
    "sv": "Huset på kullen byggdes av en bonde som ville se floden från varje fönster i sitt rum och ingenting annat",
    "ru": "Дом на холме построил крестьянин, который хотел видеть реку из каждого окна своей комнаты и больше ничего",
    "ja": "丘 の 上 の 家 は 川 を 見たい 農夫 が 建てた もの で ある",
    "cs": "Dům na kopci postavil sedlák, který chtěl vidět řeku z každého okna svého pokoje a nic jiného",
}


def test_other_languages_get_none(spark):
    """Fitted on a table of this project, texts of other languages have no language, those of the seven have theirs."""
    pages = spark.read.parquet("/root/testdata/sf0.01/crawl_pages.parquet")
    m = fit_text_model(sample_lines(pages, "page_id", "main_content", "lang"))
    assert 0.6 <= m.known <= 0.95
    rows = [(100 + k, "x.com", "en", t + ".", None, "") for k, t in enumerate(OTHERS.values())] + [(k, "x.com", None, TEXT[x] + ".", None, "") for k, x in enumerate(LANGUAGES)]
    got = page_languages(spark.createDataFrame(rows, SCHEMA), model=m).filter("line_no = -1").collect()
    assert sorted((r["page_id"], r["lang"]) for r in got) == list(enumerate(LANGUAGES))


def test_sample_is_bounded(spark):
    df = spark.range(4000).selectExpr("id AS page_id", "'en' AS lang", "'a b' AS main_content")
    assert 100 < len(sample_lines(df, "page_id", "main_content", "lang", 300)) <= 600
