"""URL filter: a blocked Bloom filter in front of an exact hash join, and host/path rules.

The listed URLs are hashed into blocks of 256 bits, eight bits per URL, all in one block. The
filter is a small table (block, four words); joining it by block lets possible hits through
and stops nearly all other URLs at once. Only the possible hits take part in the exact join
with the list, which removes the false positives. Spark broadcasts the filter while its size
is below the session's threshold and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelift.llm.common import LOWER, UPPER

WORDS, PROBES = 4, 8
BITS_PER_URL = 16


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host and its subdomains below a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """What follows the first '://' up to '/', '?', '#' or the end; '' without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host, path without closing slashes, and the query without tracking fields.

    Scheme and fragment do not count. '' for NULL and for text without '://'.
    """
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    query = F.regexp_replace(query, r"(^|&)(utm_[^=&]*|ref)=[^&]*", "")
    query = F.regexp_replace(query, r"^&", "")
    base = F.concat(host_of(url), F.regexp_replace(path_of(url), r"/+$", ""))
    return F.concat(base, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


def _bits(url: Column) -> list[Column]:
    """The masks of a URL's eight bits in the four words of its block."""
    source = F.xxhash64(url, F.lit(1))
    places = [F.shiftrightunsigned(source, 8 * i).bitwiseAND(F.lit(255)) for i in range(PROBES)]
    one = F.lit(1).cast("long")
    masks = []
    for w in range(WORDS):
        parts = [
            F.when(F.floor(p / 64) == w, F.call_function("shiftleft", one, (p % 64).cast("int"))).otherwise(
                F.lit(0).cast("long")
            )
            for p in places
        ]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), parts))
    return masks


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(0)), F.lit(blocks))


def build_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3) from the distinct canonical URLs of ``listed``."""
    masks = listed.select(
        _block(F.col("url"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_bits(F.col("url")))]
    )
    return masks.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def rule_columns(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits; NULL if none does.

    Rules are a short list of the caller's; long lists belong into the list of URLs.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text, r.verdict)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def judge(
    pages: DataFrame, listed: DataFrame, key: str = "page_id", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per input row: key, host, path, rule, listed, verdict.

    ``listed`` has a column url (any spelling). The verdict is the rule's, else block for a
    listed URL and allow for any other. NULL or malformed URLs have empty host and path, are
    never listed and are allowed. Only ``key`` and url are read of ``pages``; repeated rows
    are judged one by one; an empty list or an empty table is fine.
    """
    entries = listed.select(canonical(F.col("url")).alias("url")).filter("url <> ''").distinct()
    # a block of 256 bits for every 16 URLs
    blocks = max(1, -(-entries.count() * BITS_PER_URL // (64 * WORDS)))
    table = build_filter(entries, blocks)
    url = F.col("url")
    rows = pages.select(
        F.col(key).alias(key),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        canonical(url).alias("canon"),
    )
    masks = _bits(F.col("canon"))
    probed = rows.withColumn("block", _block(F.col("canon"), blocks)).join(table, "block", "left")
    inside = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(masks)]
    may = F.coalesce(reduce(lambda a, b: a & b, inside), F.lit(False)) & (F.col("canon") != "")
    probed = probed.select(key, "host", "path", "canon", may.alias("may"))
    hits = probed.filter("may").join(
        entries.select(F.col("url").alias("canon"), F.lit(True).alias("listed")), "canon", "left"
    )
    columns = [key, "host", "path", F.coalesce(F.col("listed"), F.lit(False)).alias("listed")]
    passed = probed.filter(~F.col("may")).withColumn("listed", F.lit(False))
    text, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return (
        hits.select(*columns)
        .unionByName(passed.select(*columns))
        .select(key, "host", "path", text.alias("rule"), "listed", F.coalesce(verdict, own).alias("verdict"))
    )
