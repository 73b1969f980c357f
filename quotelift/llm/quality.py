"""Quality classifier: supervised subword embeddings.

A word is described by its own hashed bucket and those of its character n-grams (with marks
for its ends). Every bucket has a learned vector; a word's vector is the mean over its
buckets, a document's the mean over its words, and a softmax over the document vector gives
the two classes. Vectors and output layer are trained with plain numpy gradient descent, one
document at a time, in a single task over a bounded sample of labelled documents.

For scoring, the output layer is folded into the buckets: a word then adds one number to a
document, so the broadcast model is one float per bucket (its size is fixed by ``BUCKETS``)
and any text is scored whole in one pass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quotelift.llm.common import crc_remainder, materialize

BUCKETS = 1 << 18
GRAMS = (3, 5)
DIMENSIONS = 16
EPOCHS = 5
RATE = 0.5
#: The fit takes at most so many labelled documents of either class, those with the smallest
#: hash of their id. This bounds the training sample only; every document is scored.
SAMPLE_PER_CLASS = 2048
#: Stands for the pair of a word and the same word again; holds a space, so no word equals it.
REPEATED = b"= ="
#: Words remembered per task while scoring.
REMEMBERED = 500_000
#: Texts whose words are looked up together.
TOGETHER = 500


#: Multiplier of the rolling hashes and of the scrambling of their sums.
_STEP, _A, _B = np.uint64(0x100000001B3), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _bucket(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return ((x ^ (x >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of its word) of all n-grams of all words, and of each word as a whole.

    All words are hashed at once over one buffer, ``<`` and ``>`` around each; no word is empty.
    """
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64) + np.uint64(1)
    start = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(data)) - start[word]
    powers = np.cumprod(np.full(int(size.max()), _STEP, np.uint64))
    found, owner = [_bucket(np.add.reduceat(data * powers[place], start))], [np.arange(len(words))]
    left = size[word] - place
    rolled = np.zeros(len(data), np.uint64)
    for n in range(1, GRAMS[1] + 1):
        last = len(data) - n + 1
        if last <= 0:
            break
        rolled = rolled[:last] * _STEP + data[n - 1 :]
        if n >= GRAMS[0]:
            whole = left[:last] >= n
            found.append(_bucket(rolled[whole] + np.uint64(n * int(_B) % 2**64)))
            owner.append(word[:last][whole])
    return np.concatenate(found), np.concatenate(owner)


def words_of(text: str | None) -> list[bytes]:
    """Words; one that only repeats the word before it counts as the mark for a repetition."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    return [REPEATED if a == b else a for a, b in zip(words, [b"", *words], strict=False)]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and their weights, which sum to one (none for an empty text)."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    counts = Counter(words)
    ids, owner = buckets(list(counts))
    share = np.fromiter(counts.values(), np.float64, len(counts)) / (np.bincount(owner) * len(words))
    weights = share[owner]
    unique, place = np.unique(ids, return_inverse=True)
    return unique, np.bincount(place, weights=weights).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``add[b]``: what bucket b adds to the log odds of label 1; ``bias``: where they start."""

    add: np.ndarray
    bias: float

    def scorer(self) -> _Scorer:
        return _Scorer(self)


class _Scorer:
    """Words to their numbers; new words of a batch are worked out together, up to a bound kept."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def _learn(self, wanted: set[bytes]) -> None:
        fresh = wanted.difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, wanted
        words = list(fresh)
        ids, owner = buckets(words)
        total = np.bincount(owner, weights=self.model.add[ids], minlength=len(words))
        self.known.update(zip(words, (total / np.maximum(np.bincount(owner, minlength=len(words)), 1)).tolist(), strict=True))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text: the bias, and the mean of what its words add."""
        words = [words_of(t) for t in texts]
        self._learn(set().union(*words))
        get = self.known.__getitem__
        odds = [self.model.bias + (float(np.fromiter(map(get, w), np.float64, len(w)).mean()) if w else 0.0) for w in words]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


def train_layers(
    texts: list[str | None], labels: list[int], seed: int = 7
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, output layer, bias) by gradient descent on the cross-entropy of the softmax output."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    out = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    examples = [features(t) for t in texts]
    steps, total = 0, max(1, EPOCHS * len(examples))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            ids, weights = examples[i]
            rate = RATE * (1 - steps / total)
            steps += 1
            hidden = weights @ vectors[ids] if len(ids) else np.zeros(DIMENSIONS, np.float32)
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= rate * np.outer(hidden, p)
            bias -= rate * p
            vectors[ids] -= rate * np.outer(weights, back)
    return vectors, out, bias


def train(texts: list[str | None], labels: list[int], seed: int = 7) -> Model:
    """The trained layers folded into one number for each bucket."""
    vectors, out, bias = train_layers(texts, labels, seed)
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _present(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality), distinct: the labels that may be learned from.

    Held-out rows (crc32 of the id as text, modulo 3, is 1) are never taken.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & (crc_remainder(F.col("doc_id"), 3) != 1))
    known = known.select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    return docs.select("doc_id").join(known, "doc_id").distinct()


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(text, quality): at most ``per_class`` labelled rows of either class."""
    present = _present(docs, labels)
    order = [F.xxhash64("doc_id"), "doc_id", "quality"]
    chosen = [present.filter(F.col("quality") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    # 2 x per_class ids at most, so this side is small whatever the size of the tables
    ids = F.broadcast(materialize(chosen[0].unionByName(chosen[1]), "quality-sample"))
    rows = docs.select("doc_id", "text").join(ids, "doc_id")
    # ids can repeat in docs; the bound holds for rows too
    return rows.orderBy(*order, F.xxhash64("text")).limit(2 * per_class).select("text", "quality")


def prior_shift(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> float:
    """Log odds of all labels that may be learned from, minus those of the sample."""
    n = {r["quality"]: r["n"] for r in _present(docs, labels).groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return 0.0
    return float(np.log(n[1] / n[0]) - np.log(min(n[1], per_class) / min(n[0], per_class)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Train on the bounded sample, in one task. Without labels the model says 0.5 to all.

    The bias is that of the ratio of all labels, so decisions do not depend on the table's size.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches) or [pd.DataFrame({"text": [], "quality": []})])
        texts, marks = pdf["text"].tolist(), [int(x) for x in pdf["quality"]]
        if texts:
            model = train([t if isinstance(t, str) else None for t in texts], marks)
            yield pd.DataFrame({"add": [model.add.tobytes()], "bias": [model.bias]})

    rows = sample(docs, labels, per_class).coalesce(1).mapInPandas(run, "add binary, bias double").collect()
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    return Model(np.frombuffer(rows[0]["add"], np.float32), rows[0]["bias"] + prior_shift(docs, labels, per_class))


def score_udf(spark: SparkSession, model: Model):
    """A column function from text to score."""
    shared: Broadcast = spark.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = shared.value.scorer()
        for texts in batches:
            parts = [scorer.scores(texts.iloc[i : i + TOGETHER].tolist()) for i in range(0, len(texts), TOGETHER)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return score


def classify(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Only doc_id and text are read of ``docs``. NULL and empty texts get the model's prior;
    repeated rows get the same score; labels with NULL or other values are left out of the
    fit; an empty table gives an empty result.
    """
    score = score_udf(docs.sparkSession, fit(docs, labels, per_class))
    rows = docs.select("doc_id", score(F.col("text")).alias("score"))
    return rows.select(
        "doc_id",
        (crc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows that the classifier accepts, with all their columns."""
    score = score_udf(docs.sparkSession, fit(docs, labels, per_class))
    return docs.filter(score(docs["text"]) >= 0.5)
