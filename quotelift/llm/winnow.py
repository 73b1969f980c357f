"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed, runs of ``K`` words combined, and of every ``PICK`` neighbouring runs the least
hash is kept: one fingerprint for each window of ``K + PICK - 1 = 10`` words. Two texts that
share a window share its fingerprint, so texts without a fingerprint of the benchmark are done
after one semi join on single numbers. Only where fingerprints meet are hits extended: the windows
of those texts are compared as wholes (fingerprint and hash of all ten words, 128 bits).

Arrays stay inside a row (one text), and every join has one row per key on the benchmark's side,
so neither a passage that very many documents share nor a phrase of very many items makes pairs
of rows. Copies of a text share their result; sets of windows that many documents have alike are
turned into item lists once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelift.llm.common import LOWER, UPPER, materialize

#: Words are runs of digits, letters a-z and all characters from U+0080. A class that lists them is
#: matched several times faster than one that excludes the rest.
LOWERED_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
ANY_CASE_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
WINDOW, K = 10, 4
PICK = WINDOW - K + 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _meet(left: Column, right: Column, shift: int, f: Callable[[Column, Column], Column]) -> Column:
    """f(left[i], right[i + shift]) wherever both exist."""
    size = F.greatest(F.least(F.size(left), F.size(right) - shift), F.lit(0))
    return F.zip_with(F.slice(left, 1, size), F.slice(right, 1 + shift, size), f)


def _joined(left: Column, right: Column, shift: int) -> Column:
    return _meet(left, right, shift, lambda a, b: F.xxhash64(a, b))


def _least(values: Column, shift: int) -> Column:
    return _let(values, lambda v: _meet(v, v, shift, lambda a, b: F.least(a, b)))


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(LOWERED_WORD), F.lit(0))


def _hashed(words: Column, seed: int = 0) -> Column:
    return F.transform(words, lambda w: F.xxhash64(F.lit(seed), w))


def _runs(hashes: Column, n: int) -> Column:
    """The hash of each ``n`` neighbouring words, from runs of 1, 2, 4 and 8."""
    sizes = [s for s in (8, 4, 2, 1) if n & s]

    def power(size: int) -> Column:
        if size == 1:
            return hashes
        return _let(power(size // 2), lambda half: _joined(half, half, size // 2))

    done, out = sizes[0], power(sizes[0])
    for s in sizes[1:]:
        out, done = _joined(out, power(s), done), done + s
    return out


def fingerprints(hashes: Column) -> Column:
    """The least hash of the ``PICK`` runs of ``K`` words in each window of ``WINDOW`` words."""
    two = _least(_runs(hashes, K), 1)
    return _let(_least(two, 2), lambda four: _meet(four, four, PICK - 4, lambda a, b: F.least(a, b)))


def _windows(words: Column) -> Column:
    """(a, b) for each window of ten words: its fingerprint and the hash of the whole."""

    def both(hashes: Column) -> Column:
        pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
        return F.zip_with(fingerprints(hashes), _runs(hashes, WINDOW), pair)

    return _let(_hashed(words), both)


def _short_windows(words: Column, n: int) -> Column:
    """(a, b) for each ``n`` neighbouring words: two hashes of the whole."""
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    return _let(
        words,
        lambda w: F.zip_with(
            _let(_hashed(w), lambda h: _runs(h, n)), _let(_hashed(w, 1), lambda h: _runs(h, n)), pair
        ),
    )


def item_windows(items: DataFrame, item: str = "item_id") -> DataFrame:
    """(item, len, a, b): the windows of each benchmark item, once each.

    An item of fewer than ten words, but not none, is one window.
    """
    split = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    split = split.filter(F.size("words") > 0)
    n = F.size("words")
    parts = [
        split.filter(n >= WINDOW).select("item", F.lit(WINDOW).alias("len"), F.inline(_windows(F.col("words"))))
    ]
    # at most nine numbers
    for size in sorted(r["n"] for r in split.select(n.alias("n")).filter(F.col("n") < WINDOW).distinct().collect()):
        found = split.filter(n == size).select(
            "item", F.lit(size).alias("len"), F.inline(_short_windows(F.col("words"), size))
        )
        parts.append(found)
    return reduce(DataFrame.unionByName, parts).distinct()


def _digest(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2")]


def hits(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """(d1, d2, start, len, a, b): where windows of the benchmark occur in texts, once each.

    d1 and d2 are hashes of the text; ``windows`` has len, a and b, once each.
    """
    texts = documents.select("text", *_digest(F.col("text")))
    # Searched for in every text: single fingerprints. F.get on an empty array would be NULL; explode gives no row.
    marks = F.array_distinct(_let(_hashed(words_of(F.col("text"))), fingerprints))
    known = windows.filter(F.col("len") == WINDOW)
    met = texts.select("d1", "d2", F.explode(marks).alias("a")).join(
        known.select("a").distinct(), "a", "left_semi"
    )
    met = materialize(met.select("d1", "d2").distinct(), "texts-with-fingerprints")
    found = (
        texts.join(met, ["d1", "d2"], "left_semi")
        .select("d1", "d2", F.posexplode(_windows(words_of(F.col("text")))).alias("start", "at"))
        .select("d1", "d2", "start", "at.a", "at.b")
        .join(known, ["a", "b"])
    )
    columns = ["d1", "d2", "start", "len", "a", "b"]
    parts = [found.select(columns)]
    # at most nine numbers
    for size in [r["len"] for r in windows.filter(F.col("len") < WINDOW).select("len").distinct().collect()]:
        grams = F.posexplode(_short_windows(words_of(F.col("text")), size)).alias("start", "at")
        short = texts.select("d1", "d2", grams).select("d1", "d2", "start", "at.a", "at.b")
        parts.append(short.join(windows.filter(F.col("len") == size), ["a", "b"]).select(columns))
    return reduce(DataFrame.unionByName, parts).distinct()


def contaminated(documents: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """One row per document row: key, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the words inside any occurrence of a window of the benchmark, ``n_items``
    the items of which a window occurs; ``items_sha256`` is of their ids, sorted as strings and
    joined by commas (of the empty string if none). NULL and empty texts have no words. Rows that
    share an id, or have none, are judged one by one; items that share an id are one item, and
    items without an id are one whose id is the empty string. Very long texts are taken whole: their
    arrays are as long as the text. Ties between equal hashes need no order, since the least hash
    is taken by value. An empty benchmark leaves every document clean; an empty table has no rows.
    Only key, text and the item's columns are read; other columns do not clash.
    """
    owned = materialize(item_windows(items, item), "item-windows")
    windows = owned.select("len", "a", "b").distinct()
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end"))))
    kinds = F.array_sort(F.collect_set(F.struct("len", "a", "b")))
    zero = F.lit(0).cast("int")
    covered = F.aggregate(
        "spans",
        F.struct(zero.alias("n"), zero.alias("end")),
        lambda so, x: F.struct(
            (so["n"] + F.greatest(zero, x["end"] - F.greatest(x["start"], so["end"]))).alias("n"),
            F.greatest(so["end"], x["end"]).alias("end"),
        ),
        lambda so: so["n"],
    )
    by_text = hits(documents, windows).groupBy("d1", "d2").agg(spans.alias("spans"), kinds.alias("kinds"))
    by_text = by_text.select(
        "d1", "d2", covered.cast("long").alias("n_hit"), "kinds", F.sha2(F.col("kinds").cast("string"), 256).alias("set")
    )
    by_text = materialize(by_text, "hit-texts")
    # texts with the same windows have the same items: look those up once
    sets = by_text.groupBy("set").agg(F.first("kinds").alias("kinds"))
    names = (
        sets.select("set", F.inline("kinds"))
        .join(owned, ["len", "a", "b"])
        .groupBy("set")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    names = names.select(
        "set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    )
    result = by_text.drop("kinds").join(names, "set").drop("set")
    n_words = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long")
    rows = documents.select(F.col(key).alias("_key"), n_words.alias("n_words"), *_digest(F.col("text")))
    return rows.join(result, ["d1", "d2"], "left").select(
        F.col("_key").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0).cast("long")) > 0).alias("contaminated"),
    )
