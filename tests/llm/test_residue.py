import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from typolens.llm import residue
from typolens.llm.residue import classify, mask, residue_fields, residue_report, triggered

CASES = {
    "Buy {{ title }} now": "placeholder", "Price: ${item.price} EUR": "placeholder", "[INSERT NAME HERE]": "placeholder", "Home | undefined": "placeholder", "[object Object]": "placeholder", "Hello %%NAME%%": "placeholder", "Hi <your name>, welcome": "placeholder",
    "Lorem ipsum dolor sit amet": "filler", "Your text goes here": "filler", "asdf asdf": "filler",
    "Error 404: the page you asked for could not be found.": "message", "404 Not Found": "message", "Bitte aktivieren Sie JavaScript in Ihrem Browser.": "message", "Access denied": "message", "Just a moment": "message", "Untitled document": "message",
    "In lesson 3 we write a template in which {{ name }} is replaced by a name.": None, "Printers have used the words lorem ipsum for centuries.": None, "JavaScript courses for beginners": None, "Room 404: an exhibition": None, "Undefined colours": None, "14 % off": None, "": None,
    "The access denied sign from the old factory hangs in our kitchen.": None, "Errors and changes excepted.": None,
}


@pytest.mark.parametrize(("line", "kind"), CASES.items())
def test_lines(line, kind):
    assert classify(mask(line)) == kind
    assert kind is None or triggered(line)


NEW = {
    "Error establishing a database connection": "message", "Request timed out": "message", "503 Backend fetch failed": "message", "Please complete the CAPTCHA to continue": "message", "Connection refused": "message", "Die angeforderte Seite existiert nicht": "message",
    "TODO: write text": "filler", "Your text here": "filler", "Text goes here": "filler", "Lorem ipsum dolor sit amet, our course": "filler", "This post is a test": "filler", "This text is only a test.": "filler", "Dear [First Name],": "placeholder", "Hello *|FNAME|*": "placeholder",
    "The site is currently under maintenance. " + "We work day and night to bring it back to you as it was before. " * 5: "message", "{{ " + "very long name " * 20 + "}}": "placeholder",
    "He had timed out of the race long before the rain, and so we walked home.": None, "Our captcha museum is open on Sundays.": None, "Page after page of the catalogue shows wool.": None, "The [first edition] was printed in 1950.": None,
}


@pytest.mark.parametrize(("line", "kind"), NEW.items())
def test_lines_of_no_table(line, kind):
    assert classify(mask(line)) == kind
    assert kind is None or triggered(mask(line))


def test_recurrence_decides_on_common_phrases(spark):
    line = "The page cannot load right now. Wait a few minutes and load it again."
    assert classify(mask(line), 1) is None and classify(mask(line), 3) == "message"
    rows = [(k, f"shop{k}.com", line) for k in range(3)] + [(9, "one.com", "We could not display the vase, so wait for photos later.")]
    df = spark.createDataFrame(rows, "page_id long, domain string, title string")
    assert {r["page_id"] for r in residue_fields(df, fields=("title",)).collect()} == {0, 1, 2}
    assert residue_fields(df.filter("page_id = 1"), fields=("title",)).collect() == []


SPOKEN = {
    "%%ITEM_PRICE%% This external category label repeats promising internal links, and publishers of the mail template reveal the typical review queue before the weekly export.": "placeholder",
    "Every sparse mail template [[ctaLabel]] often excludes redirected analysts, since the trimmed cost estimate soon distorts reliable doubled vowels.": "placeholder",
    "This thin letter swap attracts the blocked checkout form, and every frequent mail template often reveals the cheaper top-level suffix during that approved [[meta.description]] product line.": "placeholder",
    "Geweyevoro started as a small workshop and now sends hiking boots [INSERT DESCRIPTION SHORT HERE] to 40 towns. A hyphenated session log ignores that frequent mail template.": "placeholder",
    "Brand owners of the service desk support the stale second generation despite that crowded judge verdict (12 rows inside the shared [INSERT USER FIRST NAME HERE] mail template).": "placeholder",
    "In lesson 3 we write a template in which {{ name }} is replaced by the name of the reader, [object Object] then we test it.": "placeholder", "In lesson 3 we write a template in which [[title]] {{ name }} is replaced by the name.": "placeholder", "We print {{ logo }} on every shirt.": "placeholder", "The tutorial by {{ author }} is new.": "placeholder", "You write. {{ name }} reads.": "placeholder",
    "Use [[name]] in the gift note field.": None, "You write {{ name }} and it is filled in.": None, "The placeholder {{ name }} is filled in.": None, "{{ first }} and {{ last }} are replaced with your name.": None, "In curly brackets: {{ name }}.": None,
}


@pytest.mark.parametrize(("line", "kind"), SPOKEN.items())
def test_only_wording_at_the_placeholder_excuses_it(line, kind):
    assert classify(mask(line)) == kind


LINES = {
    "410 Gone": "message", "429  Too  Many\u00a0Requests": "message", "It  works!": "message", "Coming\u00a0 soon": "message", "Your text\u00a0goes  here": "filler", "This page is a test.": "filler", "NA": "placeholder",
    "Sit velit quis nisi elit duis aute": "filler", "A shop for " + "very " * 30 + "large boots | undefined": "placeholder", "A shop for " + "very " * 30 + "large boots | null": "placeholder",
}


@pytest.mark.parametrize(("line", "kind"), LINES.items())
def test_triggers_read_what_the_rules_read(spark, line, kind):
    assert classify(mask(line)) == kind
    df = spark.createDataFrame([(1, "a.com", line), (2, "b.com", "All good here, nationally.")], "page_id long, domain string, title string")
    assert [r["page_id"] for r in residue_fields(df, fields=("title",)).collect()] == [1]


def sample(parts, r):
    """A text that a parsed pattern matches, by chance."""
    out = ""
    for op, arg in parts:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "BRANCH":
            out += sample(r.choice(arg[1]), r)
        elif name == "SUBPATTERN":
            out += sample(arg[-1], r)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            most = min(int(arg[1]), arg[0] + 2)
            out += "".join(sample(arg[2], r) for _ in range(r.randint(arg[0], most)))
        elif name == "IN":
            fits = [c for c in "ax_ .5#:-|$@%é" if re.match(pattern_of(arg), c)] or [chr(x if k == "LITERAL" else x[0]) for k, x in ((str(k), x) for k, x in arg) if k in ("LITERAL", "RANGE")]
            out += r.choice(fits)
        elif name in ("ANY", "NOT_LITERAL", "CATEGORY"):
            out += r.choice("a ")
    return out


def pattern_of(arg):
    names = {"CATEGORY_DIGIT": r"\d", "CATEGORY_SPACE": r"\s", "CATEGORY_WORD": r"\w", "CATEGORY_NOT_SPACE": r"\S", "CATEGORY_NOT_WORD": r"\W", "CATEGORY_NOT_DIGIT": r"\D"}
    parts = {"NEGATE": lambda x: "^", "LITERAL": lambda x: re.escape(chr(x)), "RANGE": lambda x: f"{re.escape(chr(x[0]))}-{re.escape(chr(x[1]))}", "CATEGORY": lambda x: names[str(x)]}
    return "[" + "".join(parts[str(k)](x) for k, x in arg) + "]"


@pytest.mark.parametrize("rule", [*residue.PLACEHOLDERS, *residue.FILLERS, *residue.MESSAGES, *residue.COMMON, residue.LEAKED_PARTS])
def test_every_alternative_is_triggered(rule):
    r = random.Random(3)
    parsed = re._parser.parse(rule)
    hit = 0
    for _ in range(600):
        for text in (sample(parsed, r), f"see {sample(parsed, r)} now"):
            m = mask(text)
            hit += bool(re.search(f"(?i){rule}" if not rule.startswith("(?i)") else rule, m))
            assert classify(m, 9) is None or triggered(m), m
    assert hit


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(sorted(residue._LOREM_WORDS)), min_size=1, max_size=12), st.sampled_from(["", "Text: ", "x | "]))
def test_dummy_text_is_triggered(words, before):
    m = before + " ".join(words)
    assert classify(m) is None or triggered(m)


def test_mask():
    assert mask("Case 12.5 of  https://a.b/c at 2024-01-02, ref 9f3a2b1c, me@x.org") == "Case # of # at #, ref #, #"


def test_fields(spark):
    rows = [
        (1, "a.com", "Error 404: page not found.\nBack", "Fine", None, "x"), (2, "b.com", "All good here.\nHello {{ name }}", "Untitled document", "", "x"), (2, "b.com", "All good here.\nHello {{ name }}", "Untitled document", "", "x"),
        (3, None, None, None, None, "x"), (4, "c.com", "Error 405: page not found.", "", "lorem ipsum", "x"), (5, "d.com", "word " * 100_000, "t", "d", "x"),
    ]
    df = spark.createDataFrame(rows, "page_id long, domain string, main_content string, title string, meta_description string, kind string")
    got = {(r["page_id"], r["field_name"]): r["kinds"] for r in residue_fields(df).collect()}
    assert got == {(1, "main_content"): ["message"], (2, "main_content"): ["placeholder"], (2, "title"): ["message"], (4, "main_content"): ["message"], (4, "meta_description"): ["filler"]}
    assert residue_fields(df.limit(0)).collect() == []
    top = residue_report(df).collect()
    assert [(r["masked"], r["n_lines"]) for r in top] == [("Error #: page not found.", 2)]


def test_sources_are_counted_exactly(spark):
    rows = [(h, f"shop{h}.com", f"Error 7: code {'a' * k}x.") for k in range(40) for h in (2 * k, 2 * k + 1)] + [(h, f"host{h}.com", "Access denied") for h in range(1500)]
    rows += [(9000 + h, "one.com", "Page not found") for h in range(3)] + [(9010, None, "Just a moment"), (9011, "a.com", "Just a moment")]
    df = spark.createDataFrame(rows, "page_id long, domain string, title string").repartition(6)
    got = {r["masked"]: (r["n_lines"], r["n_sources"]) for r in residue_report(df, fields=("title",)).collect()}
    assert got == {f"Error #: code {'a' * k}x.": (2, 2) for k in range(40)} | {"Access denied": (1500, 1500), "Just a moment": (2, 2)}
