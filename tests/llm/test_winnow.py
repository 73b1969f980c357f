"""Decontamination against a search for every window in every text."""

import hashlib
import random
import re

import pytest

from quotelift.llm import winnow

DOCS = "doc_id long, text string, item_id long, d1 string, start int, _key int"
ITEMS = "item_id long, text string, words string, len int"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    out = []
    grams = []
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        grams += [("" if item is None else str(item), w[i : i + size]) for i in range(len(w) - size + 1) if size]
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, gram in grams:
            for i in range(len(w) - len(gram) + 1):
                if w[i : i + len(gram)] == gram:
                    hit |= set(range(i, i + len(gram)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(k, t, 1, "x", 2, 3) for k, t in docs], DOCS)
    b = spark.createDataFrame([(k, t, "w", 4) for k, t in items], ITEMS)
    got = winnow.contaminated(d, b)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted([tuple(r) for r in got.collect()], key=repr)


def test_equals_search_for_every_window(spark):
    rng = random.Random(7)
    vocab = ["na", "ÑA", "über", "to7", "Be", "or", "no"]

    def text(n):
        return rng.choice(["", "- "]) + rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))

    items = [(i, text(n)) for i, n in enumerate([0, 1, 2, 3, 5, 7, 8, 9, 10, 11, 14, 30, 31])]
    items += [(11, items[10][1] + " extra"), (10, text(25)), (None, text(12)), (40, None)]
    items = [(i, t) for i, t in items if len(words(t)) != 1] + [(99, "Only-once")]
    docs = []
    for i in range(60):
        part = rng.choice(items)[1] or ""
        cut = part.split()[: rng.randint(0, 40)]
        docs.append((i, text(rng.randint(0, 40)) + " " + " ".join(cut) + " " + text(rng.randint(0, 15))))
    docs += [(None, None), (None, ""), (5, docs[5][1]), (5, "other words"), (77, "...")]
    assert run(spark, docs, items) == brute(docs, items)


def test_every_shared_span_of_ten_words_is_found_wherever_it_lies(spark):
    passage = [f"p{i}" for i in range(25)]
    docs = []
    for i in range(16):
        shared = passage[i : i + 10]
        docs.append((i, " ".join([f"a{i}{j}" for j in range(i)] + shared + [f"z{i}{j}" for j in range(5)])))
        docs.append((100 + i, " ".join([f"a{i}"] + passage[i : i + 9] + [f"z{i}"])))
    items = [(1, " ".join(passage).upper())]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert {r[0] for r in got if r[5]} == set(range(16))


def test_repeated_words_ties_and_long_texts(spark):
    long = " ".join(["same"] * 30_000)
    docs = [(1, long), (2, long), (3, " ".join(["same"] * 9))]
    items = [(1, " ".join(["same"] * 12)), (2, " ".join(["same"] * 10)), (3, "same same")]
    got = run(spark, docs, items)
    both = hashlib.sha256(b"1,2,3").hexdigest()
    assert got[:2] == [(1, 30_000, 30_000, 3, both, True), (2, 30_000, 30_000, 3, both, True)]
    assert got[2] == (3, 9, 9, 1, hashlib.sha256(b"3").hexdigest(), True)


@pytest.mark.parametrize("docs,items", [([], [(1, "a b")]), ([(1, "a b"), (2, None)], []), ([], [])])
def test_empty_tables(spark, docs, items):
    assert run(spark, docs, items) == brute(docs, items)


def test_plan_has_no_python_and_prunes(spark, capsys):
    docs = spark.createDataFrame([(1, "a b", 1, "x", 2, 3)], DOCS)
    items = spark.createDataFrame([(1, "a b", "w", 4)], ITEMS)
    winnow.contaminated(docs, items).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
