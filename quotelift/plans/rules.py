"""Ordered, switchable rules folded over a DataFrame.

A rule is a function ``DataFrame -> DataFrame`` with an id, a description and the
columns it needs. Applying rules only builds a plan; row counts per rule come from
``DataFrame.observe`` in the same job that consumes the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Outcome of one rule in the log.
APPLIED = "APPLIED"
SKIPPED_DISABLED = "SKIPPED_DISABLED"
SKIPPED_MISSING_COLS = "SKIPPED_MISSING_COLS"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    description: str
    fn: Callable[[DataFrame], DataFrame]
    enabled: bool = True
    requires: tuple[str, ...] = ()


class RuleError(RuntimeError):
    """A rule raised while its plan was being built; nothing was written."""


@dataclass
class LogEntry:
    table: str
    rule_id: str
    status: str
    description: str
    reason: str | None = None
    columns_added: list[str] = field(default_factory=list)
    columns_dropped: list[str] = field(default_factory=list)
    observation: Observation | None = None

    @property
    def rows_after(self) -> int | None:
        """Row count behind the rule; waits for the first action on the result."""
        return self.observation.get["rows"] if self.observation else None


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that fills in when the frame is first consumed."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def apply_rules(
    df: DataFrame,
    rules: Iterable[Rule],
    table: str = "",
    toggles: Mapping[str, Mapping[str, bool]] | None = None,
    enable: bool = True,
    count_rows: bool = False,
) -> tuple[DataFrame, list[LogEntry]]:
    """Fold ``rules`` over ``df`` in order.

    Toggles are keyed by table and rule id and can only switch a rule off. A rule whose
    columns are absent is skipped and logged; a rule that raises stops the run.
    """
    switches = (toggles or {}).get(table, {})
    log = []
    for rule in rules:
        if not (enable and rule.enabled and switches.get(rule.rule_id, True)):
            log.append(LogEntry(table, rule.rule_id, SKIPPED_DISABLED, rule.description))
            continue
        missing = [c for c in rule.requires if c not in df.columns]
        if missing:
            reason = "missing columns: " + ", ".join(missing)
            log.append(
                LogEntry(table, rule.rule_id, SKIPPED_MISSING_COLS, rule.description, reason)
            )
            continue
        before = df.columns
        try:
            df = df.transform(rule.fn)
        except Exception as error:
            raise RuleError(f"rule {table}.{rule.rule_id} failed: {error}") from error
        entry = LogEntry(table, rule.rule_id, APPLIED, rule.description)
        entry.columns_added = [c for c in df.columns if c not in before]
        entry.columns_dropped = [c for c in before if c not in df.columns]
        if count_rows:
            df, entry.observation = counted(df)
        log.append(entry)
    return df, log


def log_frame(spark: SparkSession, log: Sequence[LogEntry]) -> DataFrame:
    """The rule log as a small table, one row per rule in the order applied."""
    rows = [
        (
            i,
            e.table,
            e.rule_id,
            e.status,
            e.reason,
            ",".join(e.columns_added),
            ",".join(e.columns_dropped),
            e.rows_after,
        )
        for i, e in enumerate(log, start=1)
    ]
    schema = (
        "step int, table_name string, rule_id string, status string, reason string, "
        "columns_added string, columns_dropped string, rows_after bigint"
    )
    return spark.createDataFrame(rows, schema)


def consume(df: DataFrame) -> None:
    """Run the plan once without keeping its rows, so that observations fill in."""
    df.write.format("noop").mode("overwrite").save()
