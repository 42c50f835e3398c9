import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from typolens.llm.leakage import CgkIndex, held_words, item_parts, leaked_items, own_words, word_ids, words_of

WORDS = [f"w{i}" for i in range(400)]


def passage(r, n):
    return [r.choice(WORDS) for _ in range(n)]


def brute(doc, item):
    """Longest in-order sum of stretches by exhaustive search over alignments."""
    runs = []
    for shift in range(-len(item), len(doc)):
        eq = [p for p in range(len(item)) if 0 <= p + shift < len(doc) and item[p] == doc[p + shift]]
        i = 0
        while i < len(eq):
            j = i
            while j + 1 < len(eq) and eq[j + 1] - eq[j] <= 2:
                j += 1
            if eq[j] - eq[i] + 1 >= 8:
                runs.append((eq[i], eq[i] + shift, eq[j] - eq[i] + 1))
            i = j + 1
    return max((r[2] for r in runs), default=0)


def own(spark, texts):
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "item_id long, item_text string, part string")
    return {r["item_id"]: " ".join(own_words([x["part"] for x in r["parts"]], [x["shared"] for x in r["parts"]])) for r in item_parts(df, "item_id", "item_text").collect()}


def test_shared_wording_is_not_an_items_own(spark):
    body = [" ".join(f"{c}{k}" for k in range(24)) for c in "abc"]
    got = own(spark, [f"Pick a label. Text: {b}. Give the label only." for b in body])
    assert [got[k] for k in range(3)] == body
    assert own(spark, ["Nothing is shared here at all.", "", None]) == {0: "nothing is shared here at all"}


def test_a_passage_of_two_questions_stays(spark):
    body = " ".join(f"a{k}" for k in range(30))
    texts = [f"Read this. {body}. Who ran?", f"Read this. {body}. Where did it hide?", "Read this. " + "b " * 30 + "."]
    got = own(spark, texts)
    assert got[0] == f"{body} who ran" and got[1] == f"{body} where did it hide"
    # Repeated items share everything and stay whole, and so do items of nothing but shared wording.
    assert own(spark, [f"Go. {body}."] * 5)[4] == f"go {body}"
    assert own(spark, ["Go. Stop. One.", "Go. Stop. Two.", "Go. Stop. Three."])[1] == "go stop two"


def test_words_and_plain_way_agree():
    for t in ("A b-C, d_e (1.5)!", "Ünïcode ﬁx", "a&amp;b &#65;", "bro-\nken word", "tab\tx\x7fy"):
        ids = {}
        for k, w in enumerate(dict.fromkeys(words_of(t))):
            ids[w] = k + 2
            ids[w.encode()] = k + 2
        assert word_ids(t, ids).tolist() == [ids[w] for w in words_of(t)]
    assert words_of("bro-\nken &lt;B&gt; Ｆｕｌｌ so­ft") == ["broken", "b", "full", "soft"]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(8, 60), st.integers(0, 6))
def test_single_stretch(seed, n, replaced):
    r = random.Random(seed)
    item = passage(r, 60)
    part = item[60 - n :]
    for k in range(replaced):
        if 3 * k + 1 < n:
            part[3 * k + 1] = "other"
    doc = passage(r, 20) + part + passage(r, 20)
    ids = {w: i + 2 for i, w in enumerate({*doc, *item})}
    a, b = np.array([ids[w] for w in doc]), np.array([ids[w] for w in item])
    assert held_words(a, b) >= brute(doc, item) >= 0


def test_recall_and_precision(spark):
    r = random.Random(8)
    items = [(i, "Read this note: " + " ".join(passage(r, 50))) for i in range(30)]
    mine = {i: t.split()[3:] for i, t in items}
    docs, want = [], set()
    for d in range(300):
        i = r.randrange(30)
        kind = d % 5
        body = passage(r, 40)
        if kind == 0:
            part = mine[i][5:35]
            for k in (9, 19):
                part[k] = "swap"
            want.add((d, i))
        elif kind == 1:
            part = mine[i][0:12] + passage(r, 9) + mine[i][20:32]
            want.add((d, i))
        elif kind == 2:
            part = mine[i][10:17]
        elif kind == 3:
            part = r.sample(mine[i], 40)
        else:
            part = "read this note".split()
        docs.append((d, "> " + " ".join(body[:20]) + " " + ",\n".join(part).upper() + " " + " ".join(body[20:]), "x"))
    docs += [(1000, None, "x"), (1001, "", "x"), (1002, "one", "x"), (1003, "w1 " * 60_000, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    got = {(x["doc_id"], x["item_id"]) for x in leaked_items(df, spark.createDataFrame(items, "item_id long, item_text string")).collect()}
    assert got == want
    none = spark.createDataFrame([], "item_id long, item_text string")
    assert leaked_items(df, none).collect() == []
    assert leaked_items(df.limit(0), spark.createDataFrame(items, "item_id long, item_text string")).collect() == []


def test_walks_of_equal_windows_agree():
    ix = CgkIndex([(1, WORDS[:40])])
    doc = np.array([1] * 5 + [ix.ids[w] for w in WORDS[10:30]] + [1] * 5, dtype=np.int32)
    assert ix.candidates([doc]) == {(0, 0)}
    assert ix.candidates([np.array([1] * 30, dtype=np.int32), np.array([], dtype=np.int32)]) == set()
    assert CgkIndex([]).candidates([doc]) == set()


def leak(r, stretches, every, insert=0):
    """An item of 80 words and a text that holds stretches of it, with a word replaced or inserted every so often."""
    item = passage(r, 80)
    at, text = r.randrange(5), passage(r, 12)
    for n in stretches:
        part = item[at : at + n]
        first = r.randrange(1, every) if every else 0
        part = [r.choice([*WORDS, "new"]) if every and 0 < k < n - 1 and k % every == first else w for k, w in enumerate(part)]
        if insert:
            part = [x for k, w in enumerate(part) for x in ([w, "new"] if k % insert == insert - 1 else [w])]
        text += part + passage(r, 7)
        at += n + 4
    return item, text


#: Stretches, and every how many words one is replaced. The dense ones are the least that counts.
DENSITIES = [
    ([21], 2), ([21], 3), ([21], 4), ([21], 5), ([21], 6), ([10, 10], 3), ([10, 10], 4), ([10, 10], 5), ([10, 10], 9), ([10, 10], 0),
    ([40], 2), ([30], 3), ([27], 4), ([25], 5), ([14, 14], 3), ([13, 13], 4), ([12, 12], 5), ([9, 9, 9], 3), ([8, 8, 8], 4), ([9, 11], 2),
]


@pytest.mark.parametrize(("stretches", "every"), DENSITIES)
def test_recall_by_density(stretches, every):
    """Of 100 pairs that the exact check accepts at least 95 are candidates."""
    r = random.Random(sum(stretches) * 10 + every)
    found = total = 0
    while total < 100:
        item, text = leak(r, stretches, every)
        ix = CgkIndex([(1, item)], seed=r.randrange(1000))
        doc = np.array([ix.ids.get(w, 1) for w in text], dtype=np.int32)
        if held_words(doc, ix.passages[0]) >= sum(stretches) - len(stretches):
            total += 1
            found += ix.candidates([doc]) == {(0, 0)}
    assert found >= 95


@pytest.mark.parametrize("insert", [4, 5, 7])
def test_recall_with_insertions(insert):
    r = random.Random(insert)
    found = 0
    for _ in range(100):
        item, text = leak(r, [30], 0, insert)
        ix = CgkIndex([(1, item)], seed=r.randrange(1000))
        doc = np.array([ix.ids.get(w, 1) for w in text], dtype=np.int32)
        assert held_words(doc, ix.passages[0], indels=True) >= 28
        # By the rule of single replaced words such stretches are too short.
        assert held_words(doc, ix.passages[0]) < 20
        found += (0, 0) in ix.candidates([doc], indels=True)
    assert found >= 95


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 5))
def test_long_texts_are_verified_in_blocks(seed, every):
    from typolens.llm import leakage

    r = random.Random(seed)
    item, text = leak(r, [25, 12], every)
    ids = {w: i + 2 for i, w in enumerate(dict.fromkeys([*item, *text]))}
    a, b = np.array([ids[w] for w in text]), np.array([ids[w] for w in item])
    p, d = leakage._matches(a, b)
    q, e = leakage._matches(a, b, block=7)
    assert sorted(zip(p.tolist(), d.tolist())) == sorted(zip(q.tolist(), e.tolist()))


def test_long_passage_and_text():
    item = [f"x{k % 50}" for k in range(500)]
    ix = CgkIndex([(1, item)])
    doc = np.array([ix.ids[f"x{k * 7 % 50}"] for k in range(200_000)], dtype=np.int32)
    assert held_words(doc, ix.passages[0]) == 0


def test_blocks_of_items(spark, monkeypatch):
    from typolens.llm import leakage

    monkeypatch.setattr(leakage, "BLOCK_WORDS", 100)
    r = random.Random(2)
    items = [(i, " ".join(passage(r, 40))) for i in range(12)]
    docs = [(i, "a b c " + t) for i, t in items]
    got = leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string"))
    assert sorted((x["doc_id"], x["item_id"], x["words"]) for x in got.collect()) == [(i, i, 40) for i in range(12)]
