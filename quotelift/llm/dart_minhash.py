"""MinHash near-dedup with thrown darts (DartMinHash) and banded joining.

A text is the multiset of its five-word shingles; similarity is the weighted Jaccard of these
multisets (sum of the smaller counts over sum of the larger). Shingle, occurrence number and a
range of ranks make a region into which a hashed number of darts is thrown. Every dart has a
rank and a coordinate; the earliest dart of each coordinate is the signature, and two texts
agree in a coordinate with the probability of their similarity. The ranks looked at shrink with
the length of the text, so a signature costs about ``k ln k`` darts whatever the length.

Candidates share a whole band of the signature. They are not paired off within a bucket:

1. Every member meets one leader of its bucket, the one with most bucket mates. Pairs that
   exact counting confirms are links; links give first components. While that finds links, for a few
   rounds, a bucket with several components gets a new leader from outside its main one, which
   meets the members of the other components.
2. Members of a bucket that are still in different components meet as well (except two members
   of the bucket's main component), if their whole signatures agree well enough. In buckets
   with many members, a bound that is exact removes further pairs: shingles that no other
   member of such buckets has cannot be shared, and what remains must reach the threshold.

So no link between texts of different components that share a band is lost, and a large group
of copies costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelift.llm.common import materialize
from quotelift.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
COORDINATES, BANDS, ROWS = 256, 25, 5
#: Expected darts of a text; a coordinate stays empty in about one text of 50, which then
#: looks at further ranks.
DARTS = COORDINATES * (np.log(COORDINATES) + 4)
#: Ranges of ranks below one, then ranges of length one.
EDGES = [0.0, 0.0625, 0.25, 0.5, 1.0]
#: Coordinates (of which a sketch has one byte each) that a pair at the threshold agrees in, but
#: for a chance of 3 in 100,000 (four standard deviations), which is that of missing all bands.
SKETCH_LEAST = int(COORDINATES * THRESHOLD - 4 * (COORDINATES * THRESHOLD * (1 - THRESHOLD)) ** 0.5)
#: Rounds in which buckets with several components get a new leader. What is left after them, or
#: when a round finds no link, is paired off exactly.
ROUNDS = 4
#: Buckets up to this size pair their members off at once in the second round.
SMALL_BUCKET = 16
#: Darts that are thrown together; a text throws ``DARTS`` or, if longer, looks at each shingle once.
BATCH = 400_000
REMEMBERED = 500_000
#: Shingles of texts that are kept while pairs are counted.
KEPT_SHINGLES = 3_000_000

_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the shingles, repeats included; a shorter text is one shingle."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(h))
    if not size:
        return h
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * _C + h[i : len(h) - size + 1 + i])
    out.sort()
    return out


def _occurrences(ordered: np.ndarray) -> np.ndarray:
    """Keys of (shingle, occurrence number) for sorted shingles."""
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    start = np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
    return mix(ordered + (np.arange(len(ordered)) - start).astype(np.uint64) * _C)


def _poisson_steps(mean: float) -> np.ndarray:
    steps, p, total, n = [], np.exp(-mean), 0.0, 0
    while total < 1 - 1e-12 and n < 64:
        total += p
        steps.append(total)
        n += 1
        p *= mean / n
    return np.array(steps)


def _throw(best, keys, owner, cell, low, width) -> None:
    """Throw the darts of regions (key, cell) and keep the earliest per owner and coordinate.

    The earliest of parts is the earliest of all, so long inputs are taken in parts.
    """
    if len(keys) > BATCH:
        for at in range(0, len(keys), BATCH):
            part = slice(at, at + BATCH)
            own = [x[part] if np.ndim(x) else x for x in (cell, low)]
            _throw(best, keys[part], owner[part], *own, width)
        return
    region = mix(keys + np.atleast_1d(cell) * _A)
    chance = (region >> np.uint64(11)).astype(np.float64) / 2**53
    count = np.searchsorted(_STEPS[width], chance, side="right")
    hit = count > 0
    if not hit.any():
        return
    times = count[hit]
    region, owner, low = region[hit].repeat(times), owner[hit].repeat(times), np.broadcast_to(low, keys.shape)[hit].repeat(times)
    number = np.arange(len(region)) - (np.cumsum(times) - times).repeat(times)
    dart = mix(region + (number.astype(np.uint64) + np.uint64(1)) * _C)
    coordinate = (dart & np.uint64(COORDINATES - 1)).astype(np.int64)
    rank = low + width * (((dart >> np.uint64(7)) & np.uint64(0xFFFFFF)).astype(np.float64) / 2**24)
    packed = ((rank * 2**20).astype(np.uint64) << np.uint64(32)) | (mix(dart) >> np.uint64(32))
    np.minimum.at(best, owner * COORDINATES + coordinate, packed)


_WIDTHS = [b - a for a, b in zip(EDGES, EDGES[1:], strict=False)] + [1.0]
_STEPS = {w: _poisson_steps(w) for w in _WIDTHS}


def signatures(texts: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` dart numbers per text, given as its sorted shingles."""
    n = len(texts)
    result = np.zeros((n, COORDINATES), np.uint32)
    weight = np.array([len(t) for t in texts], np.int64)
    todo, reach = np.flatnonzero(weight > 0), DARTS / np.maximum(weight, 1)
    keys_of = [_occurrences(t) for t in texts]
    while len(todo):
        keys = np.concatenate([keys_of[i] for i in todo])
        owner = np.repeat(np.arange(len(todo)), weight[todo])
        best = np.full(len(todo) * COORDINATES, np.iinfo(np.uint64).max, np.uint64)
        far = reach[todo]
        for cell, (low, width) in enumerate(zip(EDGES[:-1], _WIDTHS, strict=False)):
            use = (far > low)[owner]
            _throw(best, keys[use], owner[use], np.uint64(cell), low, width)
        more = np.maximum(0, np.ceil(far).astype(np.int64) - 1)[owner]
        if more.any():
            unit = np.arange(more.sum()) - (np.cumsum(more) - more).repeat(more) + 1
            cells = unit.astype(np.uint64) + np.uint64(len(EDGES))
            _throw(best, keys.repeat(more), owner.repeat(more), cells, unit.astype(np.float64), 1.0)
        best = best.reshape(-1, COORDINATES)
        full = (best != np.iinfo(np.uint64).max).all(axis=1)
        result[todo[full]] = (best[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        todo = todo[~full]
        reach[todo] *= 2
    return result


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        k = np.full(len(signature), b + 1, np.uint64)
        for c in range(b * ROWS, (b + 1) * ROWS):
            k = mix(k * _C + signature[:, c].astype(np.uint64))
        keys[:, b] = k
    return keys.view(np.int64)


_SIGNED = "doc_id long, digest binary, weight long, bands array<long>, sketch array<long>"


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, digest of the words, weight, band keys, one byte per coordinate) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def out(ids, digests, sets):
            signature = signatures(sets)
            sketch = (signature & 0xFF).astype(np.uint8).view(np.int64)
            width = sketch.shape[1]
            words = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1, dtype=np.int32) * width), pa.array(sketch.ravel())
            )
            bands = band_keys(signature)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel())
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    lists,
                    words,
                ],
                ["doc_id", "digest", "weight", "bands", "sketch"],
            )

        ids, digests, sets, size = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                found = shingles(text, hashes)
                if not len(found):
                    continue
                ids.append(doc_id)
                digests.append(xxhash.xxh128_digest(b" ".join(text.encode("utf-8", "surrogatepass").split())))
                sets.append(found)
                size += max(len(found), DARTS)
                if size >= BATCH:
                    yield out(ids, digests, sets)
                    ids, digests, sets, size = [], [], [], 0
        if sets:
            yield out(ids, digests, sets)

    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SIGNED)


def _fold(shift: int, mask: int):
    return lambda d: d.bitwiseOR(F.shiftrightunsigned(d, shift)).bitwiseAND(F.lit(mask))


def _agree(x: Column, y: Column) -> Column:
    """Coordinates whose bytes are equal in two sketches."""
    differ = F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b))
    # gather every byte into its lowest bit, half by half
    for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
        differ = F.transform(differ, _fold(shift, mask))
    return F.lit(COORDINATES) - F.aggregate(differ, F.lit(0), lambda n, d: n + F.bit_count(d))


def _alike(weight_a: str, weight_b: str, sketch_a: str, sketch_b: str) -> Column:
    """Not ruled out by the weights or the sketches."""
    sizes = F.least(weight_a, weight_b) >= THRESHOLD * F.greatest(weight_a, weight_b)
    return sizes & (_agree(F.col(sketch_a), F.col(sketch_b)) >= SKETCH_LEAST)


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that weights and sketches do not rule out."""
    side = nodes.select("node", "weight", "sketch")
    near = pairs.join(side.toDF("a", "weight_a", "sketch_a"), "a").join(side.toDF("b", "weight_b", "sketch_b"), "b")
    near = near.filter(_alike("weight_a", "weight_b", "sketch_a", "sketch_b")).select("a", "b")
    return materialize(near, "near-pairs")


def _similar(near: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard is at least the threshold, counted exactly.

    Neither pairs nor texts have a bound, so their joins are sort-merge joins at any size.
    """
    text = texts.select("doc_id", "text")
    full = near.join(text.toDF("a", "text_a").hint("merge"), "a").join(text.toDF("b", "text_b").hint("merge"), "b")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, known, held = WordHashes(), {}, 0

        def keys(text: str) -> np.ndarray:
            nonlocal held
            if text not in known:
                if held > KEPT_SHINGLES:
                    known.clear()
                    held = 0
                known[text] = np.unique(_occurrences(shingles(text, hashes)))
                held += len(known[text])
            return known[text]

        for pdf in batches:
            keep = []
            for x, y in zip(pdf["text_a"], pdf["text_b"], strict=True):
                x, y = keys(x), keys(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= THRESHOLD * (len(x) + len(y) - common))
            yield pdf.loc[np.array(keep, bool), ["a", "b"]]

    return materialize(full.mapInPandas(count, "a long, b long"), "links")


def _shareable(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, shared): weight of the shingles that at least one other of these nodes has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches:
            for node, text in zip(pdf["node"], pdf["text"], strict=True):
                h, n = np.unique(shingles(text, hashes), return_counts=True)
                yield pd.DataFrame({"h": h.view(np.int64), "node": node, "n": n})

    rows = nodes.join(texts.select(F.col("doc_id").alias("node"), "text"), "node").select("node", "text")
    own = rows.mapInPandas(run, "h long, node long, n long")
    single = own.groupBy("h").agg(F.count("*").alias("df"), F.max("node").alias("node"), F.max("n").alias("n"))
    alone = single.filter("df = 1").groupBy("node").agg(F.sum("n").alias("alone"))
    return nodes.join(alone, "node", "left").select(
        "node", (F.col("weight") - F.coalesce(F.col("alone"), F.lit(0))).alias("shared")
    )


def _next_stars(known: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) of a new leader of each bucket with its members in other components.

    The leader is the member with most mates outside the component that has most members.
    """
    comp = found.select("node", F.col("component_id").alias("comp"))
    now = known.join(comp, "node", "left").select("key", "node", "mates", F.coalesce("comp", "node").alias("comp"))
    now = materialize(now, "round-members")
    per = now.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = per.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "comp"))["comp"].alias("main"))
    main = materialize(main.filter("parts > 1").select("key", "main"), "round-open")
    now = now.join(main, "key")
    top = F.max(F.struct("mates", (-F.col("node")).alias("minus"), F.col("comp").alias("led"))).alias("top")
    led = now.filter("comp <> main").groupBy("key").agg(top)
    led = materialize(led.select("key", (-F.col("top.minus")).alias("leader"), "top.led"), "round-leaders")
    pairs = now.join(led, "key").filter("comp <> led")
    return pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _second_round(members: DataFrame, nodes: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of bucket mates in different components, by the rules above."""
    comp = found.select("node", F.col("component_id").alias("comp"))
    now = members.join(nodes.select("node", "weight", "sketch"), "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    now = materialize(now.select("key", "node", "weight", "sketch", "comp"), "members")
    per = now.groupBy("key", "comp").agg(F.count("*").alias("n"))
    open_ = per.groupBy("key").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("main")
    )
    open_ = materialize(open_.filter("parts > 1").select("key", "n", F.col("main.comp").alias("main")), "open")
    now = materialize(now.join(open_, "key"), "open-members")
    large = now.filter(F.col("n") > SMALL_BUCKET).select("node", "weight").distinct()
    shared = _shareable(materialize(large, "large"), texts)
    keys = now.groupBy("node").agg(F.collect_list("key").alias("keys"))  # at most one per band
    now = now.join(shared, "node", "left").join(keys, "node")
    now = materialize(now, "bounded-members")
    one = now.filter("comp <> main")
    names = ("node", "comp", "weight", "sketch", "shared", "n", "main", "keys")
    one, two = (
        x.select("key", *[F.col(c).alias(f"{c}_{s}") for c in names]) for x, s in ((one, "a"), (now, "b"))
    )
    most = F.least("shared_a", "shared_b")
    enough = most >= (F.col("weight_a") + F.col("weight_b")) * (THRESHOLD / (1 + THRESHOLD)) - 1e-6
    # two members outside the main component meet from both sides; one is enough
    once = (F.col("comp_b") == F.col("main_b")) | (F.col("node_a") < F.col("node_b"))
    alike = _alike("weight_a", "weight_b", "sketch_a", "sketch_b")
    # members whose texts have too little in common with any other are gone before the join;
    # mates in small buckets need not be among those that the bound has counted
    bounded = F.coalesce(F.col("shared_a") >= THRESHOLD * F.col("weight_a") - 1e-6, F.lit(True))
    alive = (F.col("n_a") <= SMALL_BUCKET) | bounded
    # a pair that shares several buckets meets in one of them
    here = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    met = one.filter(alive).join(two, "key").filter(
        (F.col("comp_a") != F.col("comp_b")) & once & ((F.col("n_b") <= SMALL_BUCKET) | enough) & alike & here
    )
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, class_id (the smallest id of its class), n_copies.

    ``n_copies`` counts the rows with the very same words. Texts are compared word by word, as
    written; white space does not count. Rows whose text is NULL or has no words are alone in
    their class, rows with a NULL id have a NULL class. Rows with one id are one document: if
    their texts differ, they share a class. Other columns are not read. An empty table gives
    an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = materialize(signed(texts), "signatures")
    same = marked.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("n_copies"))
    same = materialize(same, "same-text")
    # ids that stand for several texts, or texts under several ids, are links without counting
    rows = marked.select("doc_id", "digest", "weight", "bands", "sketch")
    first = rows.join(same.select("digest", "node"), "digest")
    exact = first.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    nodes = materialize(first.filter("doc_id = node").drop("digest", "doc_id").dropDuplicates(["node"]), "nodes")

    bands = nodes.select("node", F.explode("bands").alias("key"))
    buckets = materialize(bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = materialize(bands.join(buckets, "key"), "members")
    mates = materialize(members.groupBy("node").agg(F.sum("n").alias("mates")), "mates")
    known = materialize(members.join(mates, "node"), "known-members")
    leaders = known.groupBy("key").agg(F.max(F.struct("mates", (-F.col("node")).alias("minus"))).alias("top"))
    leaders = materialize(leaders.select("key", (-F.col("top.minus")).alias("leader")), "leaders")
    stars = members.join(leaders, "key").filter("node <> leader")
    stars = stars.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    stars = materialize(stars, "stars")
    # only texts that some pair needs are kept for counting
    needed = members.select(F.col("node").alias("doc_id")).distinct()
    kept = texts.filter("text is not null").join(needed.hint("merge"), "doc_id", "left_semi")
    kept = materialize(kept.dropDuplicates(["doc_id"]), "bucket-texts")
    links = _similar(_near(stars, nodes), kept)
    early = materialize(components(links), "components")
    met = stars
    for _ in range(ROUNDS):
        more = _next_stars(known, early).join(met, ["a", "b"], "left_anti")
        more = materialize(more, "next-stars")
        links = _similar(_near(more, nodes), kept)
        if links.isEmpty():
            break
        met = met.unionByName(more)
        joined = early.select(F.col("node").alias("a"), F.col("component_id").alias("b"))
        early = materialize(components(joined.unionByName(links)), "components")
    second = materialize(_second_round(members, nodes, early, kept), "second-round")
    second = materialize(second.join(met, ["a", "b"], "left_anti"), "second-pairs")
    # what is connected already goes on as stars
    joined = early.select(F.col("node").alias("a"), F.col("component_id").alias("b"))
    joined = joined.unionByName(_similar(second, kept)).unionByName(exact)
    found = components(joined).withColumnRenamed("node", "doc_id")
    own = marked.select("doc_id", "digest").join(same.select("digest", "n_copies"), "digest")
    own = own.groupBy("doc_id").agg(F.max("n_copies").alias("n_copies")).join(found, "doc_id", "left")
    return texts.select("doc_id").join(own, "doc_id", "left").select(
        "doc_id",
        F.coalesce(F.col("component_id"), F.col("doc_id")).alias("class_id"),
        F.coalesce(F.col("n_copies"), F.lit(1)).cast("long").alias("n_copies"),
    )


def one_per_class(docs: DataFrame) -> DataFrame:
    """The rows that stay: of every class the document with the smallest id, once.

    Rows with a NULL id are kept, for nothing says that they are copies.
    """
    drop = materialize(classes(docs).filter("doc_id <> class_id").select("doc_id").distinct(), "near-copies")
    left = docs.join(drop, "doc_id", "left_anti")
    return left.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(docs.filter("doc_id is null"))
