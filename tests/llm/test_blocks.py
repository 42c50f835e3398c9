import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from typolens.llm.block_labels import PAGES
from typolens.llm.blocks import block_tree, boilerplate_lines, furniture_mask, main_bodies, nav_set
from typolens.llm.lexicon import MENU_LABELS
from typolens.llm.tree import fit_tree

SCHEMA = "page_id long, main_content string, nav_links array<string>, line_no string"


def judge(text, nav=()):
    return [bool(x) for x in furniture_mask([(text.split("\n"), nav_set(nav))], {})[0]]


def test_tree_learns_and_predicts():
    x = np.array([[0.0, 1], [1, 1], [2, 0], [3, 0]])
    t = fit_tree(x, np.array([0, 0, 1, 1]), 3, 1)
    assert t.predict(x).tolist() == [0, 0, 1, 1]
    assert fit_tree(x, np.zeros(4, dtype=int), 3, 1).predict(x).tolist() == [0] * 4


def test_held_out_pages():
    """Trained without a page, the tree judges most of its lines right."""
    import typolens.llm.blocks as b

    right = total = 0
    for k in range(len(PAGES)):
        x, y = [], []
        for j, page in enumerate(PAGES):
            rows = [r for r in page.strip().split("\n")]
            nav = nav_set(rows[0][1:].split(";")) if rows[0].startswith(";") else frozenset()
            rows = [r for r in rows if not r.startswith(";")]
            f = b.block_features([r[2:] for r in rows], nav, {})
            lab = np.array([r[0] == "F" for r in rows], dtype=int)
            if j == k:
                test = (f, lab)
            else:
                x.append(f)
                y.append(lab)
        p = fit_tree(np.vstack(x), np.concatenate(y), 8, 2).predict(test[0])
        right += (p == test[1]).sum()
        total += len(p)
    assert right / total >= 0.9


#: Pages of sites that neither the labelled table nor a test table has.
INVENTED = [
    """F Our site stores cookies. OK
F Home > Tips > Bikes
B Fixing a flat tyre
B Turn the bike over, take out the wheel and lift one side of the tyre with two spoons until you can reach the tube.
B Pump the tube up and hold it under water, and the bubbles will show you where the hole is.
B You will need
B two tyre levers
B a bowl of water
F Advertisement
F Leave a reply
F People also bought
F Get 15% off when you join our mailing list
F © Acme
F Related posts
F Privacy Policy | Contact | Careers""",
    """F Shop Men Women Kids Sale
F Free shipping on all orders this week
B About the Harbour coat
B Our coat was drawn for sailors who stand in the wind all day, and it has not changed much since the first one left the yard.
B It closes with horn buttons that never freeze.
B Lined with wool
F Add to bag
F You might also like
F Customer care: 0800 123 456
F Returns and exchanges
F Instagram Facebook TikTok
F All rights reserved 2020""",
    """F Diese Seite verwendet Cookies. Einverstanden
F Start > Rat > Fahrrad
B Einen Platten flicken
B Drehen Sie das Rad um, nehmen Sie das Laufrad heraus und heben Sie den Mantel mit zwei Löffeln an, bis der Schlauch frei liegt.
B Pumpen Sie ihn auf und halten Sie ihn unter Wasser, dann zeigen Blasen, wo das Loch ist.
F Anzeige
F Auch interessant
F Kommentare (3)
F Newsletter abonnieren
F Impressum | Datenschutz | Kontakt""",
]


def test_invented_pages():
    """Nine of ten blocks of invented pages are judged right."""
    right = total = 0
    for page in INVENTED:
        rows = page.split("\n")
        got = judge("\n".join(r[2:] for r in rows))
        right += sum(g == (r[0] == "F") for g, r in zip(got, rows))
        total += len(rows)
    assert right / total >= 0.9


@pytest.mark.parametrize("line", ["Advertisement", "Leave a reply", "Get 15% off when you join our mailing list", "People also bought", "Related posts", "Privacy Policy | Contact | Careers"])
def test_furniture_of_no_table(line):
    text = "We tried the new path along the river and met nobody for a whole day, which suited us very well."
    assert judge(f"{text}\n{line}\n{line}") == [False, True, True]


def test_labelled_lines_stand_in_no_test_table():
    """Bare menu words apart."""
    masked = lambda x: re.sub(r"\d+", "#", x.strip())
    menu = {x for v in MENU_LABELS.values() for x in v.split("|")}
    known = {masked(x) for t in pq.read_table("/root/testdata/sf0.01/crawl_pages.parquet", columns=["main_content"])["main_content"].to_pylist() if t for x in t.split("\n")}
    lines = [r[2:] for page in PAGES for r in page.strip().split("\n") if not r.startswith(";")]
    assert not [x for x in lines if masked(x) in known and x.strip().lower() not in menu]


def test_new_page():
    text = "Home\nShop\nContact\n\nSizes\nThe new oven is made of clay and keeps warm for a whole day, as people in the village told us.\nHelp\nNobody in the valley remembers a winter as mild as this one, and the bees have noticed it too.\nSubscribe | Your e-mail address | Send\n© 2025 Ovens. All rights reserved."
    assert judge(text, ["Home", "Sizes"]) == [True, True, True, False, False, False, False, False, True, True]


def test_edges(spark):
    rows = [(1, None, None, "x"), (2, "", [], "x"), (3, "\n\n", None, "x"), (4, "Home\nShop\nHelp", [None, "Home"], "x"), (4, "Home\nShop\nHelp", [None, "Home"], "x"), (5, "word " * 50_000, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, boilerplate_lines(df).collect())) == sorted([(4, 0), (4, 1), (4, 2)] * 2)
    assert boilerplate_lines(df.limit(0)).collect() == []
    bodies = {r["page_id"]: r["main_body"] for r in main_bodies(df).collect()}
    assert bodies[1] is None and bodies[2] == "" and bodies[4] == "" and len(bodies[5]) == 250_000
    assert block_tree() is block_tree()
