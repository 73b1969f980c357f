"""Encoding, language model and classifier against libraries, exact counts and held-out labels."""

import collections
import dataclasses
import math
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from quotelift.llm import bloom_lm, quality
from quotelift.llm import sentencepiece_viterbi as sp

VOCAB = sp.Vocabulary.load()
ENCODER = sp.Encoder(VOCAB)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
DOCS = "doc_id long, text string, ids string, n_ids string, score string, row_id string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "i", "n", "s", "r") for r in rows], DOCS)


EDGES = ["", " ", "  a", "a \n\n b\t\tc", "日本語テキスト 🙂🙂", "x" * 9000, "ab" * 4000 + "é" * 50, "a     b" + " " * 33, "=" * 70]


@pytest.mark.parametrize("text", EDGES)
def test_ids_are_the_librarys(text):
    ids = ENCODER.encode(text).tolist()
    assert ids == LIBRARY.encode(text)
    assert sp.decode(ids, VOCAB) == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdehilnorst ABT.,'\n-0123é", max_size=120))
def test_ids_and_round_trip_on_any_text(text):
    ids = ENCODER.encode(text).tolist()
    assert ids == LIBRARY.encode(text) and sp.decode(ids, VOCAB) == text


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=60).filter(lambda t: sp.SPACE not in t and not re.search("[\ud800-\udfff]", t)))
def test_round_trip_on_any_characters(text):
    assert sp.decode(ENCODER.encode(text).tolist(), VOCAB) == text


@pytest.mark.parametrize("merging", [True, False])
def test_stream_gives_ids_before_the_text_ends_and_forgets(merging):
    vocab = dataclasses.replace(VOCAB, merging=merging)
    text = "▁the▁house▁of\u4e00" * 500
    search, ids, most = sp.Search(vocab, ENCODER.stay), [], 0
    for at in range(0, len(text), 7):
        search.feed(text[at : at + 7])
        ids += search.certain()
        most = max(most, len(search.text))
    assert most < 4 * vocab.reach
    whole = sp.Search(vocab, ENCODER.stay)
    whole.feed(text)
    assert ids + search.rest() == whole.rest() == [i for part in sp.viterbi(text, vocab, ENCODER.stay) for i in part]


def test_what_is_remembered_is_bounded_and_frequent_stretches_stay(monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED", 40)
    encoder = sp.Encoder(VOCAB)
    for i in range(300):
        text = f"the house {i} of a{i}"
        assert encoder.encode(text).tolist() == LIBRARY.encode(text)
        assert len(encoder.known) + len(encoder.older) <= 40 + 5 and " the" in encoder.known


def test_unigram_scores_are_the_best():
    described = sentencepiece_model_pb2.ModelProto()
    described.ParseFromString(open(sp.MODEL, "rb").read())
    described.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=described.SerializeToString())
    encoder = sp.Encoder(dataclasses.replace(VOCAB, merging=False))
    score = {i: s for i, s in VOCAB.ids.values()}
    for text in ["the house of the rising sun", "a bleating thing", "internationalization, please"]:
        ids = encoder.encode(text).tolist()
        best = library.nbest_encode_as_pieces(text, 2)[0]
        assert sum(score[i] for i in ids) == pytest.approx(sum(VOCAB.ids[p][1] for p in best))
        assert sp.decode(ids, VOCAB) == text


def test_encode_and_decode_frames(spark):
    rows = docs(spark, [(1, "the house"), (1, "the house"), (2, None), (3, ""), (None, "x y"), (4, sp.SPACE)])
    got = sp.encode(rows, check=True)
    assert got.columns == ["doc_id", "ids", "n_ids", "restored"] and got.count() == 6
    assert {r["doc_id"]: r["restored"] for r in got.collect()} == {1: True, 2: True, 3: True, None: True, 4: False}
    back = {r["doc_id"]: r["text"] for r in sp.decoded(got).collect()}
    assert back == {1: "the house", 2: "", 3: "", None: "x y", 4: " "}
    assert sp.encode(rows.limit(0)).count() == 0


# language model

TEXTS = ["The cat sat.", "the cat ran\x0baway  now", "a dog ran Éa", None, "", "the cat sat. on the mat " * 30, "unseen words here"]


def exact(rows):
    split = lambda t: re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [0]
    token = [split(t) for _, t in rows]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    count = collections.Counter(w for t, x in zip(token, train, strict=True) if x for w in t)
    n, v = sum(count.values()), len(count)
    return n, {
        i: (not x, len(t), sum(w in count for w in t), sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t))
        for (i, _), t, x in zip(rows, token, train, strict=True)
    }


@pytest.mark.parametrize("bounds", [{}, {"max_exact": 4, "max_filter_bytes": 200}])
def test_language_model_counts_exactly(spark, bounds):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)]
    n, want = exact(rows)
    got = bloom_lm.held_out_scores(docs(spark, rows), **bounds).collect()
    assert len(got) == 60
    for r in got:
        held, tokens, known, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, n)
        assert r["base_score"] == pytest.approx(base) and -1e9 < r["score"] <= 0
    seen = sum(r["score"] - r["base_score"] for r in got if not r["held_out"])
    assert seen > 0


def test_language_model_in_passes_is_the_same(spark):
    rows = docs(spark, [(i, f"{TEXTS[i % 3]} word{i % 11}") for i in range(80)])
    one = {r["doc_id"]: r["score"] for r in bloom_lm.held_out_scores(rows).collect()}
    two = {r["doc_id"]: r["score"] for r in bloom_lm.held_out_scores(rows, max_filter_bytes=150).collect()}
    assert one == pytest.approx(two)


def test_language_model_of_nothing(spark):
    assert bloom_lm.held_out_scores(docs(spark, [])).count() == 0
    rows = docs(spark, [(1, "a b"), (None, None), (1, "a b")])
    got = bloom_lm.scores(rows, rows.limit(0)).collect()
    assert len(got) == 3 and all(r["base_score"] == 0 and r["n_known"] == 0 for r in got)


def test_levels_come_back_from_the_filter():
    keys = np.arange(1, 5001, dtype=np.uint64) * np.uint64(7919)
    counts = np.arange(1, 5001) % 97 + 1
    bits = bloom_lm.build(keys, counts)
    held = bloom_lm.Filter(1, 0, np.array([0]), np.array([len(bits) * 8], np.uint64), bits)
    level = held.levels(keys)
    assert (level >= bloom_lm.levels_of(counts)).all() and (level == bloom_lm.levels_of(counts)).mean() > 0.95
    assert (held.levels(keys + np.uint64(1)) > 0).mean() < 0.05


# quality

GOOD = "the river runs along the old road and people walk there in the evening number {}"
BAD = ["buy%%% now### cheap$$$ {}", "A | {} | b | c", "CLICK!! HERE!! {}!!", "spam spam spam spam {} {} {}"]


def labelled(spark, n=600):
    rows = [(i, (GOOD if i % 4 else BAD[i // 4 % 4]).format(*[f"w{i}"] * 3)) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(n)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return docs(spark, rows), labels


def test_classifier_learns_and_keeps_good_documents(spark):
    rows, labels = labelled(spark)
    got = quality.classify(rows, labels).join(labels, "doc_id").filter("quality is not null")
    held = got.filter("held_out").collect()
    assert len(held) > 100
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in held)
    kept = quality.keep_good(rows, labels)
    assert kept.columns == rows.columns and 400 < kept.count() < 500


def test_held_out_labels_do_not_matter(spark):
    rows, labels = labelled(spark, 200)
    from pyspark.sql import functions as F

    from quotelift.llm.common import crc_remainder

    held = crc_remainder(F.col("doc_id"), 3) == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda y: sorted((r["doc_id"], r["score"]) for r in quality.classify(rows, y).collect())
    assert score(labels) == score(turned)


def test_classifier_edges(spark):
    rows, labels = labelled(spark, 60)
    odd = docs(spark, [(1000, None), (1001, ""), (None, "the"), (1002, "x" * 50_000), (1002, "x" * 50_000)])
    got = quality.classify(rows.unionByName(odd), labels).collect()
    assert len(got) == 65 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(odd.limit(0), labels).count() == 0


def test_bias_of_the_classifier_is_that_of_all_labels(spark):
    rows = [(i, f"good words {i}" if i % 6 else f"bad junk {i}") for i in range(600)]
    marks = spark.createDataFrame([(i, int(i % 6 > 0)) for i, _ in rows], "doc_id long, quality int")
    used = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    good = sum(i % 6 > 0 for i in used)
    # an even sample: the bias of its fit is moved to the ratio of all labels
    texts = docs(spark, rows)
    picked = quality.sample(texts, marks, 40).collect()
    assert collections.Counter(r["quality"] for r in picked) == {0: 40, 1: 40}
    plain = quality.train([r["text"] for r in picked], [r["quality"] for r in picked])
    got = quality.fit(texts, marks, 40)
    assert got.bias - plain.bias == pytest.approx(math.log(good / (len(used) - good)), abs=0.05)
    assert quality.fit(texts, marks, 1000).bias == pytest.approx(quality.fit(texts, marks, 2000).bias)


def plain_buckets(word):
    """The hashes of a word and its n-grams one by one, in whole numbers modulo 2**64."""
    top, step, a, b = 1 << 64, 0x100000001B3, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
    marked = [c + 1 for c in b"<" + word + b">"]

    def place(x):
        x = (x ^ (x >> 31)) * a % top
        x = (x ^ (x >> 29)) * b % top
        return (x ^ (x >> 32)) % quality.BUCKETS

    found = [place(sum(c * step ** (i + 1) for i, c in enumerate(marked)) % top)]
    for n in range(quality.GRAMS[0], quality.GRAMS[1] + 1):
        for i in range(len(marked) - n + 1):
            rolled = sum(c * step ** (n - 1 - j) for j, c in enumerate(marked[i : i + n]))
            found.append(place((rolled + n * b) % top))
    return found


def test_score_equals_a_plain_forward_pass():
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["good", "text", "spam", "né", "x", "wörter"]) for _ in range(rng.randint(0, 12))) for _ in range(40)]
    labels = [int("spam" not in t) for t in texts]
    vectors, out, bias = quality.train_layers(texts, labels)
    model = quality.train(texts, labels)
    texts += [None, "", "neverseen " * 50, "a" * 3000]
    want = []
    for text in texts:
        words = [quality.REPEATED if a == b else a for a, b in zip((text or "").encode().split(), [b"", *(text or "").encode().split()])]
        hidden = np.zeros(quality.DIMENSIONS)
        for w in words:
            hidden += np.mean([vectors[i].astype(float) for i in plain_buckets(w)], axis=0) / len(words)
        z = np.exp(hidden @ out.astype(float) + bias)
        want.append(z[1] / z.sum())
    got = quality._Scorer(model).scores(texts)
    assert got == pytest.approx(want, abs=1e-5)
    # one by one, or with little memory, they are the same to the last bit
    small = quality._Scorer(model)
    assert [small.score(t) for t in texts] == got.tolist()
