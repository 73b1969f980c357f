"""The audit against counts in memory; the transducer against sorted lists."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quotelift.llm import divergence
from quotelift.llm.divergence import Transducer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term int, ordinal string, value int"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, least):
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(text))
        seen[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
        groups.add((lang or "", source or ""))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, n in seen[lang].items() if n >= least), key=str.encode)
        sources = sorted(s for g, s in groups if g == lang)

        def shares(n, kept=kept):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, n in (("pair", pairs, len(pairs)), ("term", terms, 50)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:n])]
    return sorted(out)


def documents(rng):
    vocab = ["una", "Maß", "MASS", "ñu", "zeta", "a", "ab", "abc", "x1y", "été", "\U0001f600", "o'clock"]
    vocab += [f"{a}{b}" for a in "abcdefgh" for b in ("in", "on", "un", "ons", "uns", "ins", "é")]
    docs = []
    for _ in range(300):
        n = rng.choice([0, 3, 20, 60])
        words = [vocab[min(int(rng.expovariate(0.08)), len(vocab) - 1)] for _ in range(n)]
        docs.append((" ".join(words), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "S", None, "é"])))
    docs += [(None, "en", "s9"), ("", "xx", "s1"), ("1 2 3", "xx", "s2"), (docs[3][0], "en", "s1"), (docs[3][0], "en", "s1")]
    docs.append(("una ab\tabc-" * 200_000, "en", "s2"))
    return docs


@pytest.mark.parametrize("options", [{}, {"shard_terms": 7, "block": 5, "tile": 2}, {"shard_terms": 9, "broadcast_bytes": 0}])
def test_equals_counts_in_memory(spark, options, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    docs = documents(random.Random(11))
    frame = spark.createDataFrame([(i, *d, 0, 1, "o", 2) for i, d in enumerate(docs)], SCHEMA)
    got = divergence.audit(frame, min_documents=12, **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, 12)


def test_no_kept_terms_and_empty_table(spark):
    docs = [("a b", "en", "s1"), ("c", "en", "s2")]
    frame = spark.createDataFrame([(i, *d, 0, 1, "o", 2) for i, d in enumerate(docs)], SCHEMA)
    assert sorted(tuple(r) for r in divergence.audit(frame).collect()) == brute(docs, 30)
    assert divergence.audit(frame.limit(0)).count() == 0


def test_transducer_numbers_terms_and_is_minimal():
    rng = random.Random(5)
    terms = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))).encode() for _ in range(900)})
    built = Transducer.unpack(Transducer.build(terms, 101).pack())
    asked = terms + [b"", b"zz", terms[0] + b"q", terms[5][:-1] + b"\xff"]
    want = [101 + terms.index(t) if t in terms else -1 for t in asked]
    assert built.ordinals(asked).tolist() == want
    # as many states as there are different sets of endings
    endings = {}
    for t in terms:
        for i in range(len(t) + 1):
            endings.setdefault(t[:i], set()).add(t[i:])
    assert len(built.final) == len({frozenset(e) for e in endings.values()})


def test_shares_are_exact():
    counts = np.array([0, 1, 7, 10**14], dtype=np.int64)
    for total, terms in ((10**14 + 8, 4), (10**16, 9), (12, 3)):
        if counts.max() <= total:
            want = [1 + 10**9 * (int(c) + 5) // (total + 5 * terms) for c in counts]
            assert divergence._shares(counts, total, terms).tolist() == want


def test_terms_of_long_texts_do_not_depend_on_where_they_are_cut(monkeypatch):
    text = ("Äh no-1x " * 50).encode()
    whole = [t for part in divergence.terms_of(text) for t in part]
    monkeypatch.setattr(divergence, "PART", 7)
    assert [t for part in divergence.terms_of(text) for t in part] == whole
