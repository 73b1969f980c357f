"""Source divergence audit: how the term shares of the sources of a language differ.

1. Document frequencies of terms per language are counted; a language keeps the terms that enough of
   its documents have. Their position in byte order is their ordinal.
2. The sorted kept terms are built into minimal acyclic transducers, one for every ``SHARD_TERMS``
   ordinals of a language: the outputs along the path of a term add up to its ordinal.
3. The texts are streamed through the transducers and counted again, by ordinal. While the packed
   transducers take no more than ``BROADCAST_BYTES``, every task has them all and only counts of
   kept terms are shuffled. Beyond that, counted terms are dealt to the transducer they belong
   to, sorted, and streamed through it there; the counts are the same.
4. Shares are exact whole numbers. The distance of two sources is summed over blocks of ordinals
   and tiles of sources, so that no task holds a whole vocabulary; ordinals break ties.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quotelift.llm.common import materialize
from quotelift.operators.ordering import add_position

MIN_DOCUMENTS, SMOOTHING, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Terms in one transducer, and ordinals and sources in one block of the sum of distances.
SHARD_TERMS, BLOCK, TILE = 1 << 16, 1 << 13, 64
BROADCAST_BYTES = 32 << 20
#: A task hands its counts on when it holds this many, and cuts texts into parts of about this many bytes.
HELD, PART = 300_000, 1 << 20

#: A-Z to a-z; every other byte below 128 that is no letter to a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in parts; parts are cut where a term ends."""
    if len(text) <= PART:
        yield text.translate(_FOLD).split()
        return
    rest = b""
    for at in range(0, len(text), PART):
        piece = rest + text[at : at + PART].translate(_FOLD)
        cut = piece.rfind(b" ") + 1 if at + PART < len(text) else len(piece)
        yield piece[:cut].split()
        rest = piece[cut:]


class Transducer:
    """A packed minimal acyclic transducer from byte strings to consecutive ordinals."""

    def __init__(self, first: int, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray):
        self.first, self.keys, self.targets, self.outputs, self.final = first, keys, targets, outputs, final

    @classmethod
    def build(cls, terms: Iterable[bytes], first: int) -> Transducer:
        """From sorted distinct terms, of which the smallest gets the ordinal ``first``.

        States of the last path stay open; one that no later term can change is replaced by an
        equal state met before. States are numbered when they close, targets before sources.
        """
        register: dict[tuple, int] = {}
        closed: list[tuple] = []  # (final, ((label, target), ...))
        path: list[list] = [[False, []]]  # open states from the root: [final, arcs]
        last = b""

        def close(down_to: int) -> None:
            while len(path) - 1 > down_to:
                final, arcs = path.pop()
                state = (final, tuple(arcs))
                number = register.get(state)
                if number is None:
                    number = register[state] = len(closed)
                    closed.append(state)
                path[-1][1].append((last[len(path) - 1], number))

        for term in terms:
            same = 0
            while same < min(len(term), len(last)) and term[same] == last[same]:
                same += 1
            close(same)
            last = term
            path.extend([False, []] for _ in range(len(term) - same))
            path[-1][0] = True
        close(0)
        root = len(closed)
        closed.append((path[0][0], tuple(path[0][1])))
        # how many terms lie below each state; an arc adds what is passed before it
        below = [0] * len(closed)
        keys, targets, outputs = [], [], []
        for number, (final, arcs) in enumerate(closed):
            passed = int(final)
            for label, target in arcs:
                keys.append(((root - number) << 8) | label)  # the root is state 0
                targets.append(root - target)
                outputs.append(passed)
                passed += below[target]
            below[number] = passed
        order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        final = np.array([f for f, _ in reversed(closed)], dtype=bool)
        return cls(
            first,
            np.array(keys, dtype=np.int64)[order],
            np.array(targets, dtype=np.int32)[order],
            np.array(outputs, dtype=np.int32)[order],
            final,
        )

    def pack(self) -> bytes:
        head = struct.pack("<qqq", self.first, len(self.keys), len(self.final))
        return b"".join([head, *(x.tobytes() for x in (self.keys, self.targets, self.outputs, self.final))])

    @classmethod
    def unpack(cls, blob: bytes) -> Transducer:
        first, arcs, states = struct.unpack_from("<qqq", blob)
        at, found = 24, []
        for kind, n in ((np.int64, arcs), (np.int32, arcs), (np.int32, arcs), (bool, states)):
            found.append(np.frombuffer(blob, kind, n, at))
            at += found[-1].nbytes
        return cls(first, *found)

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """The ordinal of each term, -1 for terms that were not built in; all terms walk at once."""
        out = np.full(len(terms), -1, dtype=np.int64)
        if not terms or not len(self.keys):
            return out
        lengths = np.fromiter(map(len, terms), dtype=np.int64, count=len(terms))
        data = np.frombuffer(b"".join(terms), dtype=np.uint8).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        alive, state, total = np.arange(len(terms)), np.zeros(len(terms), dtype=np.int64), np.zeros(len(terms), dtype=np.int64)
        for step in range(int(lengths.max()) + 1):
            ended = lengths[alive] == step
            done = alive[ended]
            out[done] = np.where(self.final[state[ended]], self.first + total[ended], -1)
            alive, state, total = alive[~ended], state[~ended], total[~ended]
            if not len(alive):
                break
            key = (state << 8) | data[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[arc] == key
            alive, arc, total = alive[known], arc[known], total[known]
            total = total + self.outputs[arc]
            state = self.targets[arc].astype(np.int64)
        return out


def _read(documents: DataFrame) -> DataFrame:
    """NULL text, lang and source as empty, text as bytes, source only where it is read."""
    filled = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")}
    return documents.select(
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), filled["lang"], filled["source"]
    )


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(text, *other columns) of each row, one at a time."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


_DF = pa.schema([("lang", pa.string()), ("term", pa.string()), ("n", pa.int64())])


def _document_frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            terms = pa.array(list(counts), pa.binary()).cast(pa.string())
            columns = [pa.array([lang] * len(counts)), terms, pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=_DF)
        held.clear()

    for text, lang in _texts(batches):
        own: set[bytes] = set()
        for part in terms_of(text):
            own.update(part)
        held.setdefault(lang, Counter()).update(own)
        if sum(map(len, held.values())) > HELD:
            yield from rows()
    yield from rows()


def vocabulary(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, ordinal, n_terms): the kept terms of each language in byte order, from 1."""
    docs = _read(documents).select("text", "lang")
    counted = docs.mapInArrow(_document_frequencies, "lang string, term string, n long")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_documents)
    return add_position(kept.select("lang", "term"), [F.col("term").asc()], "ordinal", ["lang"], "n_terms")


def transducers(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """(lang, shard, low, blob): one packed transducer for each ``shard_terms`` ordinals; low is its first term."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ordinal")
        terms = [t.encode() for t in rows["term"]]
        blob = Transducer.build(terms, int(rows["ordinal"].iloc[0])).pack()
        return pd.DataFrame({"lang": [key[0]], "shard": [key[1]], "low": [terms[0]], "blob": [blob]})

    numbered = kept.withColumn("shard", F.expr(f"(ordinal - 1) div {shard_terms}"))
    return numbered.groupBy("lang", "shard").applyInPandas(build, "lang string, shard long, low binary, blob binary")


class _Shards:
    """Which transducer of a language a term belongs to."""

    def __init__(self, lows: Iterable[tuple[str, int, bytes]]):
        self.lows: dict[str, tuple[list, list]] = {}
        for lang, shard, low in sorted(lows):
            names, firsts = self.lows.setdefault(lang, ([], []))
            names.append(shard)
            firsts.append(low)

    def split(self, lang: str, terms: list[bytes]) -> Iterator[tuple[int, slice]]:
        """Slices of sorted terms by transducer; a language without kept terms has none."""
        names, firsts = self.lows.get(lang, ([], []))
        if not names:
            return
        edges = [0, *(bisect_left(terms, low) for low in firsts[1:]), len(terms)]
        for name, start, stop in zip(names, edges, edges[1:], strict=False):
            if stop > start:
                yield name, slice(start, stop)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str, list[bytes], list[int]]]:
    """(lang, source, sorted terms, their counts), whenever enough is held and at the end."""
    held: dict[tuple[str, str], Counter] = {}

    def rows() -> Iterator[tuple[str, str, list[bytes], list[int]]]:
        for (lang, source), counts in held.items():
            terms = sorted(counts)
            yield lang, source, terms, [counts[t] for t in terms]
        held.clear()

    for text, lang, source in _texts(batches):
        counts = held.setdefault((lang, source), Counter())
        for part in terms_of(text):
            counts.update(part)
            if sum(map(len, held.values())) > HELD:
                yield from rows()
                counts = held.setdefault((lang, source), Counter())
    yield from rows()


_CELLS = "lang string, source string, ordinal long, n long"


def _cells(lang: str, source: str, ordinals: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    kept = ordinals >= 0
    n = int(kept.sum())
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(ordinals[kept]), pa.array(counts[kept])],
        names=["lang", "source", "ordinal", "n"],
    )


def recount(documents: DataFrame, built: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of each kept term in each source that has it."""
    spark, docs = documents.sparkSession, _read(documents)
    size = built.agg(F.sum(F.length("blob"))).first()[0] or 0
    # one row per transducer: a few for every 65,536 kept terms
    shards = _Shards((r["lang"], r["shard"], bytes(r["low"])) for r in built.select("lang", "shard", "low").collect())
    if size <= broadcast_bytes:
        packed = {(r["lang"], r["shard"]): bytes(r["blob"]) for r in built.collect()}  # at most broadcast_bytes
        sent = spark.sparkContext.broadcast(packed)

        def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opened = {k: Transducer.unpack(blob) for k, blob in sent.value.items()}
            for lang, source, terms, counts in _counted(batches):
                numbers = np.array(counts, dtype=np.int64)
                for shard, part in shards.split(lang, terms):
                    yield _cells(lang, source, opened[lang, shard].ordinals(terms[part]), numbers[part])

        found = docs.mapInArrow(stream, _CELLS)
    else:
        routed = "lang string, shard long, source string, term binary, n long, blob binary"

        def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for lang, source, terms, counts in _counted(batches):
                for shard, part in shards.split(lang, terms):
                    n = len(terms[part])
                    columns = [
                        pa.array([lang] * n), pa.array([shard] * n, pa.int64()), pa.array([source] * n),
                        pa.array(terms[part], pa.binary()), pa.array(counts[part], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "shard", "source", "term", "n"])

        def through(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine = None
            for batch in batches:
                rows = batch.to_pandas()
                fresh = rows["blob"].notna()
                for _, run in rows.groupby(fresh.cumsum(), sort=False):
                    if run["blob"].iloc[0] is not None:
                        machine, run = Transducer.unpack(run["blob"].iloc[0]), run.iloc[1:]
                    ordinals = machine.ordinals(list(run["term"]))
                    columns = [pa.array(run["lang"], pa.string()), pa.array(run["source"], pa.string()), pa.array(ordinals), pa.array(run["n"].to_numpy())]
                    out = pa.RecordBatch.from_arrays(columns, names=["lang", "source", "ordinal", "n"])
                    yield out.filter(pa.array(ordinals >= 0))

        once = docs.mapInArrow(route, routed.replace(", blob binary", ""))
        once = once.groupBy("lang", "shard", "source", "term").agg(F.sum("n").alias("n"))
        rows = once.withColumn("blob", F.lit(None).cast("binary"))
        heads = built.select("lang", "shard", F.lit("").alias("source"), F.lit(b"").alias("term"), F.lit(0).cast("long").alias("n"), "blob")
        dealt = rows.unionByName(heads).repartition("lang", "shard")
        found = dealt.sortWithinPartitions("lang", "shard", F.col("blob").isNull()).mapInArrow(through, _CELLS)
    return found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * terms)), exactly."""
    top = (count + SMOOTHING).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + SMOOTHING * terms).cast("decimal(28,0)")
    return (F.call_function("div", top, bottom) + 1).cast("long")


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """As :func:`_share`, three digits at a time, so that 64 bits are enough."""
    bottom = total + SMOOTHING * terms
    if bottom >= 1 << 53:
        return np.array([1 + SCALE * (int(c) + SMOOTHING) // bottom for c in counts], dtype=np.int64)
    digits, rest = np.divmod(counts + SMOOTHING, bottom)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, bottom)
        digits = digits * 1000 + digit
    return digits + 1


def _distances(cells: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language, both ways.

    ``groups`` has lang, source, number (from 0), total, n_terms. Each task sums one block of
    ordinals for one pair of tiles of sources.
    """
    last_tile = F.expr(f"(max(number) OVER (PARTITION BY lang)) div {tile}")
    placed = groups.withColumn("tile", F.expr(f"number div {tile}")).withColumn("last_tile", last_tile)
    spread = placed.select(
        "*", F.explode(F.sequence(F.lit(0), F.expr(f"greatest(n_terms - 1, 0) div {block}"))).alias("block")
    )
    heads = spread.withColumns({"ordinal": F.lit(0).cast("long"), "n": F.lit(0).cast("long")})
    filled = cells.join(placed, ["lang", "source"]).withColumn("block", F.expr(f"(ordinal - 1) div {block}"))
    columns = ["lang", "source", "number", "total", "n_terms", "tile", "last_tile", "block", "ordinal", "n"]
    rows = heads.select(columns).unionByName(filled.select(columns))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_tile"))))
    rows = rows.withColumns({"ti": F.least("tile", "other"), "tj": F.greatest("tile", "other")})

    def summed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        lang, at, ti, tj = key
        heads = part[part["ordinal"] == 0].sort_values("number")
        body = part[part["ordinal"] > 0]
        first, terms = int(at) * block, int(heads["n_terms"].iloc[0])
        width = max(0, min(block, terms - first))
        totals, tiles = heads["total"].to_numpy(), heads["tile"].to_numpy()
        where = {s: i for i, s in enumerate(heads["source"])}
        counts = np.zeros((len(heads), width), dtype=np.int64)
        counts[body["source"].map(where).to_numpy(dtype=np.int64), body["ordinal"].to_numpy() - 1 - first] = body["n"]
        shares = np.vstack([_shares(c, int(t), terms) for c, t in zip(counts, totals, strict=True)]) if width else counts
        names, out = heads["source"].to_numpy(), []
        for i in range(len(names)):
            if tiles[i] != ti:
                continue
            far = np.abs(shares - shares[i]).sum(axis=1)
            for j in range(len(names)):
                if tiles[j] == tj and (ti != tj or j > i):
                    out += [(lang, names[i], names[j], int(far[j])), (lang, names[j], names[i], int(far[j]))]
        return pd.DataFrame(out, columns=["lang", "source", "item", "value"])

    parts = rows.groupBy("lang", "block", "ti", "tj").applyInPandas(
        summed, "lang string, source string, item string, value long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    documents: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    shard_terms: int = SHARD_TERMS,
    block: int = BLOCK,
    tile: int = TILE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows lang, source, part, item, value, rank; ranks count from 1 per group and part.

    Part ``pair`` has each other source of the language as item and the summed distance of their
    shares as value; part ``term`` has the ``TOP`` terms whose share in the source exceeds that in
    the language by most. Larger values come first, equal ones in byte order of the item (for
    terms: by ordinal).

    NULL text, lang and source read as empty; a source whose documents have no terms takes part
    with counts of 0, and a language without kept terms has distances of 0 and no terms. Repeated
    rows count as often as they occur. Very long texts are split in parts within a task. An empty
    table gives no rows. Only text, lang and source are read; other columns do not clash.
    """
    kept = materialize(vocabulary(documents, min_documents), "kept-terms")
    built = materialize(transducers(kept, shard_terms), "transducers")
    cells = materialize(recount(documents, built, broadcast_bytes), "counts")
    sizes = kept.groupBy("lang").agg(F.max("n_terms").alias("n_terms"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    named = _read(documents).select("lang", "source").distinct()
    groups = add_position(named, [F.col("source").asc()], "number", ["lang"]).join(totals, ["lang", "source"], "left")
    groups = groups.join(sizes, "lang", "left").select(
        "lang",
        "source",
        (F.col("number") - 1).cast("long").alias("number"),
        F.coalesce("total", zero).alias("total"),
        F.coalesce("n_terms", zero).alias("n_terms"),
    )
    groups = materialize(groups, "groups")
    by_value = [F.col("value").desc(), F.col("item").asc()]
    group = W.partitionBy("lang", "source")
    pairs = _distances(cells, groups, block, tile).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(group.orderBy(*by_value)).alias("rank")
    )
    whole = cells.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    own = cells.join(groups, ["lang", "source"]).join(langs, "lang").join(whole, ["lang", "ordinal"])
    own = own.withColumn("p", _share(F.col("n"), F.col("total"), F.col("n_terms")))
    own = own.withColumn("value", F.col("p") - _share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms")))
    place = F.row_number().over(group.orderBy(F.col("value").desc(), F.col("ordinal").asc()))
    best = own.filter("value > 0").select("lang", "source", "ordinal", "value", place.alias("rank")).filter(F.col("rank") <= TOP)
    named = best.join(kept.select("lang", "ordinal", "term"), ["lang", "ordinal"])
    terms = named.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
