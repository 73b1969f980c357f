"""Language-model scoring with a log-frequency Bloom filter.

The counts of words and word pairs in the training texts are quantised to levels (level q for
counts from ``BASE**(q-1)``), and a Bloom filter gets one entry (n-gram, j) for every j up to
the n-gram's level. A reader probes (n-gram, 1), (n-gram, 2), ... until one is missing, so a
count comes out of repeated membership tests; it can only be too large, and the chance falls
with every further level.

The model is a word-pair model, interpolated with single words:

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | v) = PAIRS * c(v, w) / c(v) + (1 - PAIRS) * p(w)       (p(w) if v was never seen)

with the quantised counts; the end of a text stands before its first word.

Counting packs the n-grams of a few million tokens into one row per part (a part is a range of
hash values), so the shuffle moves arrays, not rows. Each part sums its counts, and builds its
own piece of the filter, sized for what it holds. The filter is broadcast if its measured size
is within ``MAX_FILTER_BYTES``; a larger one is broadcast in several passes of that size, each
of which fills in the levels of the n-grams it holds before the scores are worked out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelift.llm.common import crc_remainder, materialize
from quotelift.llm.dart_minhash import WordHashes, mix

BASE, PAIRS = 1.5, 0.4
PROBES = 6
BITS_PER_ENTRY = PROBES / np.log(2)
MAX_LEVEL = 60
MAX_FILTER_BYTES = 128 << 20
#: Words whose exact counts are broadcast; rarer ones are joined.
MAX_EXACT = 2_000_000
#: Tokens counted together, and texts per part.
BATCH, TEXTS_PER_PART = 3_000_000, 2000
PROBE_BATCH = 400_000

_C = np.uint64(0x9E3779B97F4A7C15)
_WORD, _PAIR = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
#: No word holds a line break, so this is the end of a text.
END = b"\n"


def tokens(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of the words, A-Z in lower case, and of the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    words.append(END)
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def pair_keys(h: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """Keys of (word before, word); ``starts`` are the first tokens of the texts."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[starts] = end
    return mix(mix(before + _PAIR) * _C + h)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9), MAX_LEVEL).astype(np.int64)


def _level_values() -> np.ndarray:
    """The count that stands for each level: the middle of the whole numbers in it."""
    values = [0.0]
    for q in range(1, MAX_LEVEL + 1):
        low, high = np.ceil(BASE ** (q - 1) - 1e-9), np.ceil(BASE**q - 1e-9) - 1
        values.append(float(np.sqrt(low * high)) if high >= low else float(BASE ** (q - 0.5)))
    return np.array(values)


VALUES = _level_values()


def _places(keys: np.ndarray, level: np.ndarray | int, size: np.ndarray, probe: int) -> np.ndarray:
    x = mix(keys + np.asarray(level, np.uint64) * _C)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return ((x & np.uint64(0xFFFFFFFF)) + np.uint64(probe) * step) % size


def build(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits of the filter for these n-grams, as bytes."""
    level = levels_of(counts)
    entries = np.repeat(keys, level)
    number = np.arange(len(entries)) - np.repeat(np.cumsum(level) - level, level) + 1
    size = np.uint64(max(64, 8 * int(np.ceil(len(entries) * BITS_PER_ENTRY / 8))))
    bits = np.zeros(int(size), bool)
    for probe in range(PROBES):
        bits[_places(entries, number, size, probe).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


@dataclass(frozen=True)
class Filter:
    """Pieces ``first`` to ``first + len(sizes) - 1`` of ``parts``, one behind another."""

    parts: int
    first: int
    offsets: np.ndarray
    sizes: np.ndarray
    bits: np.ndarray

    def held(self, keys: np.ndarray) -> np.ndarray:
        part = (keys % np.uint64(self.parts)).astype(np.int64) - self.first
        return (part >= 0) & (part < len(self.sizes))

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each n-gram, 0 for those that are not there."""
        part = (keys % np.uint64(self.parts)).astype(np.int64) - self.first
        offset, size = self.offsets[part], self.sizes[part]
        level = np.zeros(len(keys), np.uint8)
        active = np.arange(len(keys))
        for j in range(1, MAX_LEVEL + 1):
            for probe in range(PROBES):
                place = _places(keys[active], j, size[active], probe)
                byte = self.bits[offset[active] + (place >> np.uint64(3)).astype(np.int64)]
                active = active[(byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            if not len(active):
                break
            level[active] = j
        return level


@dataclass(frozen=True)
class Totals:
    tokens: int
    types: int
    end: int

    @property
    def base(self) -> float:
        return np.log10(self.tokens + self.types + 1)


_COUNTED = "part int, pairs boolean, keys binary, counts binary"
_BUILT = "part int, pairs boolean, keys binary, counts binary, bits binary, n_bytes long, types long, tokens long"


def counted(texts: DataFrame, parts: int) -> DataFrame:
    """Packed counts of words and word pairs, one row per batch, part and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        end = hashes[END]

        def out(h, starts):
            rows = []
            for pairs, keys in ((False, h), (True, pair_keys(h, starts, end))):
                keys, n = np.unique(keys, return_counts=True)
                part = ((keys if pairs else mix(keys + _WORD)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                keys, n, part = keys[order], n[order].astype(np.int64), part[order]
                cut = np.searchsorted(part, np.arange(parts + 1))
                rows += [
                    (p, pairs, keys[a:b].tobytes(), n[a:b].tobytes())
                    for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))
                    if b > a
                ]
            for i in range(0, len(rows), 256):
                cols = zip(*rows[i : i + 256], strict=True)
                types = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["part", "pairs", "keys", "counts"]
                )

        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(tokens(text.as_py(), hashes))
                size += len(held[-1])
                if size >= BATCH:
                    yield from out(np.concatenate(held), np.cumsum([0, *map(len, held[:-1])]))
                    held, size = [], 0
        if held:
            yield from out(np.concatenate(held), np.cumsum([0, *map(len, held[:-1])]))

    return texts.select("text").mapInArrow(run, _COUNTED)


def built(packed: DataFrame) -> DataFrame:
    """One row per part and kind: its piece of the filter, and the exact counts of its words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple, list] = {}
        for pdf in batches:
            for part, pairs, keys, counts in pdf.itertuples(index=False):
                found.setdefault((part, pairs), []).append(
                    (np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64))
                )
        while found:
            (part, pairs), rows = found.popitem()
            keys, place = np.unique(np.concatenate([k for k, _ in rows]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([c for _, c in rows])).astype(np.int64)
            bits = build(mix(keys + _WORD) if not pairs else keys, n)
            yield pd.DataFrame(
                {
                    "part": [part],
                    "pairs": [bool(pairs)],
                    "keys": [b"" if pairs else keys.tobytes()],
                    "counts": [b"" if pairs else n.tobytes()],
                    "bits": [bits.tobytes()],
                    "n_bytes": [len(bits)],
                    "types": [len(keys)],
                    "tokens": [int(n.sum())],
                }
            )

    return packed.repartition("part").mapInPandas(run, _BUILT)


def _ranges(model: DataFrame, parts: int, limit: int) -> list[tuple[int, int]]:
    """Ranges of parts whose pieces of both filters take ``limit`` bytes at most."""
    sizes = model.groupBy("part").agg(F.sum("n_bytes").alias("n")).toLocalIterator()
    size = {r["part"]: r["n"] for r in sizes}
    ranges, first, total = [], 0, 0
    for part in range(parts):
        more = size.get(part, 16)
        if part > first and total + more > limit:
            ranges.append((first, part))
            first, total = part, 0
        total += more
    return [*ranges, (first, parts)]


def _pieces(model: DataFrame, parts: int, first: int, last: int) -> tuple[Filter, Filter]:
    """The filters of words and of pairs over the parts from ``first`` to before ``last``."""
    both = []
    for pairs in (False, True):
        rows = model.filter(F.col("part").between(first, last - 1) & (F.col("pairs") == pairs))
        found = {r["part"]: np.frombuffer(r["bits"], np.uint8) for r in rows.select("part", "bits").collect()}
        bits = [found.get(p, np.zeros(8, np.uint8)) for p in range(first, last)]
        length = np.array([len(b) for b in bits], np.int64)
        both.append(
            Filter(parts, first, np.cumsum(length) - length, (length * 8).astype(np.uint64), np.concatenate(bits))
        )
    return both[0], both[1]


def _exact(model: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, counts) of the commonest words, at most ``most``, and the level they start from.

    Taken by whole levels, so that rarer words are exactly those of lower levels.
    """

    def histogram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for counts in pdf["counts"]:
                level, n = np.unique(levels_of(np.frombuffer(counts, np.int64)), return_counts=True)
                yield pd.DataFrame({"level": level, "n": n})

    words = model.filter("not pairs").select("keys", "counts")
    rows = words.select("counts").mapInPandas(histogram, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    lowest, total = MAX_LEVEL + 1, 0
    for level, n in sorted(rows.collect(), reverse=True):
        if total + n > most:
            break
        lowest, total = level, total + n

    def common(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for keys, counts in pdf.itertuples(index=False):
                k, c = np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64)
                use = levels_of(c) >= lowest
                yield pd.DataFrame({"keys": [k[use].tobytes()], "counts": [c[use].tobytes()]})

    found = words.mapInPandas(common, "keys binary, counts binary").collect()
    keys = np.frombuffer(b"".join(r["keys"] for r in found), np.uint64)
    counts = np.frombuffer(b"".join(r["counts"] for r in found), np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order], lowest


def _rare(model: DataFrame, lowest: int) -> DataFrame:
    """(h, c) of the words that are not broadcast."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for keys, counts in pdf.itertuples(index=False):
                k, c = np.frombuffer(keys, np.int64), np.frombuffer(counts, np.int64)
                use = levels_of(c) < lowest
                yield pd.DataFrame({"h": k[use], "c": c[use]})

    return model.filter("not pairs").select("keys", "counts").mapInPandas(run, "h long, c long")


_STATE = "row_id long, doc_id {id}, text string, levels binary"
_SCORED = "row_id long, doc_id {id}, n_tokens long, n_known long, known_sum double, score double, rare array<long>"


def scores(
    docs: DataFrame, train: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES, max_exact: int = MAX_EXACT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Learns from all whole texts of ``train`` (NULL: empty, so one end). ``n_known`` and
    ``base_score`` use exact counts: the commonest words' are broadcast, the others' joined.
    Only doc_id and text are read; repeated rows get the same scores. With no training texts
    every token has probability 1 under both formulas' empty vocabulary. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    parts = max(16, train.count() // TEXTS_PER_PART)
    model = materialize(built(counted(train, parts)), "language-model")
    row = model.filter("not pairs").agg(F.sum("tokens"), F.sum("types")).first()
    total = Totals(row[0] or 0, row[1] or 0, WordHashes()[END])
    keys, counts, lowest = _exact(model, max_exact)
    exact = spark.sparkContext.broadcast((keys, counts))
    complete = len(keys) == total.types
    state = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text").withColumn(
        "levels", F.lit(None).cast("binary")
    )
    for first, last in _ranges(model, parts, max_filter_bytes):
        pieces = spark.sparkContext.broadcast(_pieces(model, parts, first, last))
        step = _pass(pieces, exact, total, last == parts, complete)
        schema = (_SCORED if last == parts else _STATE).format(id=kind)
        state = materialize(state.mapInArrow(step, schema), "scores")
        pieces.destroy()
    found = state
    if not complete:
        rare = state.select("row_id", F.explode("rare").alias("h")).groupBy("row_id", "h").agg(F.count("*").alias("n"))
        known = materialize(_rare(model, lowest), "rare-words")
        per_row = (
            materialize(rare, "rare-tokens")
            .join(known, "h")
            .groupBy("row_id")
            .agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("sum"))
        )
        found = state.join(per_row, "row_id", "left")
        found = found.withColumn("n_known", F.col("n_known") + F.coalesce("more", F.lit(0)))
        found = found.withColumn("known_sum", F.col("known_sum") + F.coalesce("sum", F.lit(0.0)))
    return found.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(total.tokens).cast("long").alias("train_tokens"),
        (F.col("known_sum") - F.col("n_tokens") * F.lit(float(total.base))).alias("base_score"),
        "score",
    )


def _pass(shared, exact, total: Totals, last: bool, complete: bool):
    """Fills in the levels that the broadcast pieces hold; the last pass works out the scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = shared.value
        hashes = WordHashes()

        def out(rows, texts, olds):
            h = [tokens(t, hashes) for t in texts]
            length = np.array([len(x) for x in h], np.int64)
            starts = np.cumsum(length) - length
            flat = np.concatenate(h)
            level = np.zeros((2, len(flat)), np.uint8)
            for i, old in enumerate(olds):
                if old is not None:
                    level[:, starts[i] : starts[i] + length[i]] = np.frombuffer(old, np.uint8).reshape(2, -1)
            unique, place = np.unique(flat, return_inverse=True)
            key = mix(unique + _WORD)
            held = words.held(key)
            own = np.zeros(len(unique), np.uint8)
            own[held] = words.levels(key[held])
            level[0] |= own[place]
            key = pair_keys(flat, starts, total.end)
            held = pairs.held(key)
            level[1, held] = pairs.levels(key[held])
            ids = [rows.column(0), rows.column(1)]
            if not last:
                both = [level[:, a : a + n].tobytes() for a, n in zip(starts, length, strict=True)]
                return pa.RecordBatch.from_arrays(
                    [*ids, pa.array(texts, pa.string()), pa.array(both, pa.binary())],
                    ["row_id", "doc_id", "text", "levels"],
                )
            n_word = VALUES[level[0]]
            before = np.empty_like(n_word)
            before[1:] = n_word[:-1]
            before[starts] = n_word[starts + length - 1]  # the end, which every text has
            single = (n_word + 1) / (total.tokens + total.types + 1)
            together = np.minimum(VALUES[level[1]], np.minimum(n_word, before))
            share = np.where(before > 0, PAIRS, 0.0)
            p = share * together / np.maximum(before, 1) + (1 - share) * single
            score = np.add.reduceat(np.log10(p), starts)
            keys, counts = exact.value
            spot = np.minimum(np.searchsorted(keys, unique), max(0, len(keys) - 1))
            c = np.where(keys[spot] == unique, counts[spot], 0) if len(keys) else np.zeros(len(unique), np.int64)
            c = c[place]
            known = np.add.reduceat((c > 0).astype(np.int64), starts)
            sums = np.add.reduceat(np.log10(c + 1.0), starts)
            if complete:
                ends, rare = np.zeros(len(h) + 1, np.int32), np.empty(0, np.int64)
            else:
                missing = c == 0
                ends = np.concatenate([[0], np.cumsum(np.add.reduceat(missing.astype(np.int64), starts))]).astype(np.int32)
                rare = flat[missing].view(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    *ids,
                    pa.array(length),
                    pa.array(known),
                    pa.array(sums),
                    pa.array(score),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(rare)),
                ],
                ["row_id", "doc_id", "n_tokens", "n_known", "known_sum", "score", "rare"],
            )

        for batch in batches:
            texts, start, size = batch.column(2).to_pylist(), 0, 0
            olds = batch.column(3).to_pylist()
            for i, t in enumerate(texts):
                size += len(t or "") // 4 + 1
                if size >= PROBE_BATCH or i + 1 == len(texts):
                    yield out(batch.slice(start, i + 1 - start), texts[start : i + 1], olds[start : i + 1])
                    start, size = i + 1, 0

    return run


def held_out_scores(docs: DataFrame, modulus: int = 7, remainder: int = 2, **bounds: int) -> DataFrame:
    """Scores of all texts by a model of those whose crc32(id) mod 7 is not 2; adds held_out."""
    train = docs.filter(crc_remainder(F.col("doc_id"), modulus) != remainder)
    found = scores(docs, train, **bounds)
    held = crc_remainder(F.col("doc_id"), modulus) == remainder
    return found.select("doc_id", held.alias("held_out"), *found.columns[1:])
