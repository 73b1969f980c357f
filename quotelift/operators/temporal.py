"""Snapshot history: latest state, status entry times, reference date, day counts.

The latest snapshot and all entry times come from one aggregation on the key, which
combines on the map side; a key that holds a third of the history is reduced before
the shuffle instead of being sorted in one window task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelift.functions import as_date, status_key


def latest_of(df: DataFrame, ts: str, tie: str, columns: Sequence[str] | None = None) -> Column:
    """Aggregate: the newest row as a struct; NULL times lose, the larger tie wins."""
    return F.max_by(F.struct(*(columns or df.columns)), F.struct(F.col(ts), F.col(tie)))


def latest_snapshot(
    df: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the snapshot with the greatest time.

    The row travels through the shuffle as one struct that Spark cannot prune; name the
    ``columns`` to carry if only some are needed.
    """
    newest = latest_of(df, ts, tie, columns)
    return df.groupBy(key).agg(newest.alias("_row")).select("_row.*")


def reference_time(df: DataFrame, ts: str) -> Column:
    """Newest time in the whole table as a scalar subquery.

    The newest row of every key is kept, so this equals the maximum over the latest
    snapshots; nothing is brought to the driver.
    """
    return df.agg(F.max(ts).alias("ts")).scalar()


def days_since_update(latest: DataFrame, history: DataFrame, ts: str, out: str) -> DataFrame:
    """Days between each latest snapshot and the newest time of the table."""
    newest = reference_time(history, ts)
    return latest.withColumn(out, F.datediff(newest.cast("date"), F.col(ts).cast("date")))


def stale_to_lost(
    df: DataFrame,
    status: str,
    days: str,
    open_statuses: Sequence[str],
    stale_days: int,
    lost: str,
    old: str,
    flag: str,
) -> DataFrame:
    """Open rows without an update for more than ``stale_days`` become lost.

    The previous status and a flag are kept. The flag is NULL where it cannot be told.
    """
    stale = F.col(days) > stale_days
    open_and_stale = status_key(status).isin(list(open_statuses)) & stale
    closed = df.withColumn(old, F.col(status)).withColumn(
        status, F.when(open_and_stale, lost).otherwise(F.col(status))
    )
    was_open = status_key(old).isin(list(open_statuses))
    return closed.withColumn(flag, (status_key(status) == lost.upper()) & was_open & stale)


def entry_time(status: str, ts: str, value: str) -> Column:
    """Aggregate: first time a key was seen in a status.

    The first row in a status is always a change into it, so no lag is needed.
    """
    return F.min(F.when(status_key(status) == value.upper(), F.col(ts)))


def first_status_entry(
    df: DataFrame, key: str, ts: str, status: str, values: Mapping[str, str]
) -> DataFrame:
    """Entry time per key into each status; ``values`` maps output names to statuses."""
    return df.groupBy(key).agg(*[entry_time(status, ts, v).alias(o) for o, v in values.items()])


def latest_with_entries(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    status: str,
    values: Mapping[str, str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Latest snapshot (with the given columns) and entry times per key in one shuffle."""
    both = df.groupBy(key).agg(
        latest_of(df, ts, tie, columns).alias("_row"),
        *[entry_time(status, ts, v).alias(o) for o, v in values.items()],
    )
    return both.select("_row.*", *values)


def reference_date(
    status: str, flag: str, ts: str, issued_at: str, lost_at: str, issued: str, lost: str
) -> Column:
    """Date a row is measured against: its closing date, or its snapshot date if open."""
    state = status_key(status)
    return (
        F.when(state == issued.upper(), F.col(issued_at).cast("date"))
        .when((state == lost.upper()) & F.col(flag), F.col(ts).cast("date"))
        .when(state == lost.upper(), F.col(lost_at).cast("date"))
        .otherwise(F.col(ts).cast("date"))
    )


def days_to_reference(df: DataFrame, mapping: Mapping[str, str], reference: str) -> DataFrame:
    """Replace each date column by its distance in days to the reference date."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    days = [F.datediff(as_date(df, o), F.col(reference)).alias(n) for o, n in present.items()]
    return df.select(*[c for c in df.columns if c not in present], *days)


def days_between(df: DataFrame, end: str, start: str, out: str) -> DataFrame:
    return df.withColumn(out, F.datediff(F.col(end), F.col(start)))


def touched_keys(batch: DataFrame, key: str) -> DataFrame:
    return batch.select(key).distinct()


def touched_history(history: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """All snapshots of the keys that occur in the batch.

    Rules that look back need the whole history of a key, not only its new rows.
    """
    return history.join(touched_keys(batch, key), key, "left_semi")


def publish_latest(
    published: DataFrame, recomputed: DataFrame, batch: DataFrame, key: str
) -> DataFrame:
    """Replace the keys of the batch in a published table; one row per key stays."""
    kept = published.join(touched_keys(batch, key), key, "left_anti")
    return kept.unionByName(recomputed)
