"""Prefix trie of conversations, totals of its subtrees by time-forward processing.

A node is a sequence of first turns; its key is a running 128-bit hash of (depth, turn), so that no
text travels and a conversation of any length is hashed in blocks. Counting keys gives the nodes.

Totals go from the leaves to the root. Nodes are cut into shards: ``weight`` bounds the turns below
a node, and a node is in its parent's shard if both have the same ``weight div SHARD_TURNS``. Such
a shard is a subtree of at most ``SHARD_TURNS`` turns, or a piece of a path as long at most. In a
shard nodes are sorted by level, deepest first, and each sends its totals forward to its parent
through a priority queue that spills; what reaches the root of a shard goes on to the shard above.
Shards with weight under ``SHARD_TURNS`` need nothing from others. For the few nodes above them the
shard roots are one more tree, of at most some two roots for each ``SHARD_TURNS`` turns, walked in the same
way; after that the shards above know what comes to each of their nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quotelift.llm.common import materialize, word_count
from quotelift.operators.ordering import add_position

GROUP, HEADS = 20, 4  # a conversation takes up to HEADS - 1 first turns of the first of its GROUP ids
SHARD_TURNS = 1 << 16
#: Turns hashed in one window; messages a queue holds in memory; bytes of ids in one row.
BLOCK, QUEUE, CHUNK = 1 << 12, 1 << 18, 1 << 16
KEY, UP = ["depth", "k1", "k2"], ["p1", "p2"]


class SpillingQueue:
    """A priority queue of tuples, smallest first, that keeps ``limit`` of them in memory.

    What is too much is written in sorted runs where Spark itself spills, to files without a
    name that end with the task; a task that is run again starts with an empty queue.
    """

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        place = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=place if place and os.path.isdir(place) else None)  # noqa: SIM115
        for item in sorted(self.heap):
            pickle.dump(item, file, pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self.spilled += len(self.heap)
        self.heap.clear()
        self.runs.append(file)
        self._advance(len(self.runs) - 1)

    def _advance(self, run: int) -> None:
        try:
            heapq.heappush(self.heads, (pickle.load(self.runs[run]), run))
        except EOFError:
            self.runs[run].close()

    @property
    def heads(self) -> list:
        return self.__dict__.setdefault("_heads", [])

    def least(self) -> tuple | None:
        first = [h[0] for h in (self.heap[:1], self.heads[0][:1] if self.heads else []) if h]
        return min(first) if first else None

    def pop(self) -> tuple:
        item = self.least()
        if self.heads and self.heads[0][0] == item:
            _, run = heapq.heappop(self.heads)
            self._advance(run)
            return item
        return heapq.heappop(self.heap)


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, words): the turns of each conversation in order, from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), word_count(text).alias("words")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    placed = add_position(rows, order, "pos", ["conv_id"], "n_own")
    return placed.select(
        "conv_id", "pos", "n_own", "words", F.xxhash64("digest").alias("t1"), F.xxhash64(F.lit(1), "digest").alias("t2")
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, len, depth, t1, t2, words): every conversation rebuilt; depth 0 is a row of its own."""
    turns = materialize(_turns(conversations), "turns")
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    own = turns.groupBy("conv_id").agg(F.max("n_own").cast("long").alias("n_own"))
    given = turns.filter((F.col("pos") < HEADS) & (first == F.col("conv_id")))
    given = given.groupBy(F.col("conv_id").alias("first")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t1", "t2", "words"))).alias("given")  # at most three
    )
    nothing = F.array().cast("array<struct<pos:long,t1:long,t2:long,words:long>>")
    known = own.withColumns({"first": first, "h": borrowed}).join(given, "first", "left")
    known = known.withColumn("given", F.coalesce(F.slice("given", 1, F.col("h").cast("int")), nothing))
    known = known.withColumn("b", F.size("given").cast("long")).withColumn(
        "len", F.col("b") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    )
    known = materialize(known.select("conv_id", "h", "b", "len", "given"), "conversations")
    taken = known.select("conv_id", "len", F.inline("given")).withColumnRenamed("pos", "depth")
    later = turns.join(known.drop("given"), "conv_id").filter(F.col("pos") > F.col("h"))
    later = later.withColumn("depth", F.col("pos") - F.col("h") + F.col("b"))
    zero = F.lit(0).cast("long")
    roots = known.select("conv_id", "len", zero.alias("depth"), zero.alias("t1"), zero.alias("t2"), zero.alias("words"))
    columns = roots.columns
    return roots.unionByName(taken.select(columns)).unionByName(later.select(columns))


def _paths(rows: DataFrame) -> DataFrame:
    """Adds the key of each row's node and that of its parent (p1, p2)."""
    rows = rows.withColumn("block", F.expr(f"depth div {BLOCK}"))
    # the hash of a turn holds its depth, so that the order of a sequence counts; the root is 0, 0
    for t, k in (("t1", "k1"), ("t2", "k2")):
        rows = rows.withColumn(t, F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.xxhash64("depth", t)).cast("long"))
        inside = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
        rows = rows.withColumn(k, F.bit_xor(t).over(inside))
    long = rows.filter(F.col("len") >= BLOCK).groupBy("conv_id", "block").agg(F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    long = long.select("conv_id", "block", F.bit_xor("b1").over(before).alias("b1"), F.bit_xor("b2").over(before).alias("b2"))
    rows = rows.join(long, ["conv_id", "block"], "left")
    for t, k, b, p in (("t1", "k1", "b1", "p1"), ("t2", "k2", "b2", "p2")):
        rows = rows.withColumn(k, F.col(k).bitwiseXOR(F.coalesce(b, F.lit(0).cast("long"))))
        rows = rows.withColumn(p, F.col(k).bitwiseXOR(F.col(t)))
    return rows.select("conv_id", "len", *KEY, *UP, "words")


def _nodes(paths: DataFrame) -> DataFrame:
    return paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.sum(F.col("len") - F.col("depth")).alias("weight"),
    )


def _sharded(nodes: DataFrame, paths: DataFrame, shard_turns: int) -> DataFrame:
    """Adds layer (weight div shard_turns) and the key of the root of each node's shard."""
    heavy = nodes.filter(F.col("weight") >= shard_turns)
    layer = F.expr(f"weight div {shard_turns}")
    layers = paths.select("conv_id", *KEY).join(heavy.select(*KEY, layer.alias("layer")), KEY, "left")
    layers = layers.withColumn("layer", F.coalesce("layer", F.lit(0).cast("long")))
    # the node's smallest conversation passes through its shard's root
    tops = layers.groupBy("conv_id", "layer").agg(F.min(F.struct(*KEY)).alias("top"))
    return nodes.withColumn("layer", layer).join(tops, ["conv_id", "layer"])


ADDED = ["in_children", "in_leaves", "in_saved"]
SUMS = ["children", "leaves", "saved"]


def _forward(of: Callable[[dict], tuple], to: Callable[[dict], tuple], queue: int) -> Callable:
    """A pass over rows sorted by (shard, depth descending, key): totals go to ``to`` in each shard.

    ``of`` is the place of a row in a shard's order, ``to`` that of the row it reports to.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = SpillingQueue(queue)
        for frame in frames:
            rows = frame.to_dict("records")
            out: dict[str, list] = {s: [] for s in SUMS}
            for row in rows:
                children, leaves, saved = row["in_children"], row["in_leaves"], row["in_saved"]
                here = of(row)
                while (first := waiting.least()) is not None and first[0] == here:
                    _, more, more_leaves, more_saved = waiting.pop()
                    children, leaves, saved = children + more, leaves + more_leaves, saved + more_saved
                if not row["is_top"]:
                    waiting.push((to(row), 1, leaves, saved))
                for name, value in zip(SUMS, (children, leaves, saved), strict=True):
                    out[name].append(value)
            yield frame.assign(**out)

    return run


def _within(nodes: DataFrame, partitions: int, queue: int) -> DataFrame:
    """Totals within each shard; ``is_top`` marks the roots, whose totals go on to other shards."""
    start = nodes.withColumns(
        {
            "is_top": (F.col("top.depth") == F.col("depth")),
            "in_leaves": F.col("in_leaves") + F.when(F.col("weight") == 0, 1).otherwise(0),
            "in_saved": F.col("in_saved") + (F.col("n_convs") - 1) * F.col("words"),
            "s1": F.col("top.k1"),
            "s2": F.col("top.k2"),
            "sd": F.col("top.depth"),
        }
    ).drop("top")
    columns = start.columns
    dealt = start.repartition(partitions, "s1", "s2", "sd")
    dealt = dealt.sortWithinPartitions("s1", "s2", "sd", F.col("depth").desc(), "k1", "k2")
    of = lambda r: (r["s1"], r["s2"], r["sd"], -r["depth"], r["k1"], r["k2"])
    to = lambda r: (r["s1"], r["s2"], r["sd"], 1 - r["depth"], r["p1"], r["p2"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    done = dealt.mapInPandas(_forward(of, to, queue), schema + "".join(f", {s} long" for s in SUMS))
    return done.select(*columns, *SUMS)


def _received(tops: DataFrame) -> DataFrame:
    """What the parents of shard roots get: their key, children, leaves, saved."""
    up = tops.filter(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    return up.agg(F.count(F.lit(1)).alias("r_children"), F.sum("leaves").alias("r_leaves"), F.sum("saved").alias("r_saved"))


def _with_received(nodes: DataFrame, received: DataFrame) -> DataFrame:
    joined = nodes.join(received, KEY, "left")
    return joined.withColumns({f"in_{s}": F.coalesce(f"r_{s}", F.lit(0).cast("long")) for s in SUMS}).drop(*[f"r_{s}" for s in SUMS])


def _across(heavy: DataFrame, partitions: int, queue: int) -> DataFrame:
    """Totals of shards that get something from others, from what the shards beside them give.

    The roots of these shards, one row for each, are a tree of their own, walked in one task.
    """
    inside = materialize(_within(heavy, partitions, queue), "shards-above")
    place = inside.select(F.struct(*KEY).alias("node"), F.struct(F.col("sd").alias("depth"), F.col("s1").alias("k1"), F.col("s2").alias("k2")).alias("above"))
    roots = inside.filter("is_top").withColumn("node", F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")))
    roots = roots.join(place, "node", "left").drop(*ADDED).withColumnsRenamed({s: f"in_{s}" for s in SUMS})
    roots = roots.withColumns({"is_top": F.col("above").isNull(), "ad": F.col("above.depth"), "a1": F.col("above.k1"), "a2": F.col("above.k2")})
    roots = roots.select(*KEY, *UP, "is_top", *ADDED, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("ad", "a1", "a2")])
    of = lambda r: (-r["depth"], r["k1"], r["k2"])
    to = lambda r: (-r["ad"], r["a1"], r["a2"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in roots.schema)
    ordered = roots.repartition(1).sortWithinPartitions(F.col("depth").desc(), "k1", "k2")
    return ordered.mapInPandas(_forward(of, to, queue), schema + "".join(f", {s} long" for s in SUMS))


def _totals(nodes: DataFrame, queue: int) -> DataFrame:
    """Every node with children, leaves and saved of its whole subtree."""
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    zeros = {c: F.lit(0).cast("long") for c in ADDED}
    light = materialize(_within(nodes.filter("layer = 0").withColumns(zeros), partitions, queue), "shards")
    keep = [*KEY, *UP, "conv_id", "n_convs", *SUMS]
    above = nodes.filter("layer > 0")
    if above.isEmpty():
        return light.select(keep)
    heavy = materialize(_with_received(above, _received(light.filter("is_top"))), "above")
    roots = _received(_across(heavy, partitions, queue))
    both = heavy.join(roots, KEY, "left").withColumns(
        {f"in_{s}": F.col(f"in_{s}") + F.coalesce(f"r_{s}", F.lit(0).cast("long")) for s in SUMS}
    )
    done = _within(both.drop(*[f"r_{s}" for s in SUMS]), partitions, queue)
    return light.select(keep).unionByName(done.select(keep))


def _ends(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256): the hash over the ids of the conversations that end at a node.

    Ids are joined to pieces of text where they lie sorted; only pieces meet at the hash, which
    takes them one by one.
    """
    ends = paths.filter(F.col("depth") == F.col("len")).select(*KEY, "conv_id")
    ordered = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")

    def pieces(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            rows = zip(*(frame[c].tolist() for c in [*KEY, "conv_id"]), strict=True)
            for key, group in groupby(rows, key=itemgetter(0, 1, 2)):
                ids = [r[3] for r in group]
                for at in range(0, len(ids), CHUNK // 16):
                    part = ids[at : at + CHUNK // 16]
                    out.append((*key, part[0], ",".join(map(str, part))))
            yield pd.DataFrame(out, columns=[*KEY, "first", "ids"])

    schema = "depth long, k1 long, k2 long"
    joined = ordered.mapInPandas(pieces, f"{schema}, first long, ids string")
    dealt = joined.repartition(*KEY).sortWithinPartitions(*KEY, "first")

    def hashed(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for f in frames for r in f.itertuples(index=False, name=None))
        out = []
        for key, group in groupby(rows, key=itemgetter(0, 1, 2)):
            digest = hashlib.sha256()
            for n, row in enumerate(group):
                digest.update(("," * (n > 0) + row[4]).encode())
            out.append((*key, digest.hexdigest()))
            if len(out) == QUEUE:
                yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
                out = []
        yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])

    return dealt.mapInPandas(hashed, f"{schema}, ends_sha256 string")


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, queue: int = QUEUE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn``, NULL first, equal ones by the SHA-256 of role and text; NULL
    role or text is empty. Repeated rows are turns of their own. Rows without ``conv_id`` belong
    to no conversation and are left out; an empty table gives no rows. Texts of any length are
    hashed where they are read. A conversation, a first turn or a node may have any share of the
    rows: turns are placed by ranges, hashed in blocks, and nodes are counted before they meet.
    Only the four columns are read; other columns do not clash.
    """
    paths = materialize(_paths(rebuilt(conversations)), "paths")
    nodes = materialize(_nodes(paths), "nodes")
    sharded = materialize(_sharded(nodes, paths, shard_turns), "sharded")
    totals = _totals(sharded, queue)
    parents = nodes.select(
        F.col("depth").alias("p_depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    joined = totals.withColumn("p_depth", F.col("depth") - 1).join(parents, ["p_depth", "p1", "p2"], "left")
    named: list[Column] = [
        F.col("conv_id"),
        F.col("depth"),
        F.col("parent_conv_id"),
        F.col("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    ]
    return joined.join(_ends(paths), KEY, "left").select(named)
