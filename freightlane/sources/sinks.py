"""Where rejected rows, profiles and reconciliation reports are written."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F


def write_rejects(rejects: DataFrame, root: str, table: str, run: str, batch: int = 0) -> str:
    """Rejected rows as CSV with a header, in a folder of their own per table, run and batch."""
    folder = f"{root.rstrip('/')}/table={table}/run={run}/batch={batch}"
    rejects.write.mode("overwrite").options(header=True, escape='"').csv(folder)
    return folder


def write_profile(profile: DataFrame, folder: str) -> None:
    """A profile as JSON lines, one per column."""
    profile.write.mode("overwrite").json(folder)


def report(checks: DataFrame, source_engine: str, target_engine: str, at: datetime | None = None) -> DataFrame:
    """One row: when, which engines, every table with its checks and verdict, and the overall verdict.

    The number of checks follows from the contracts, not from the data, so one row can hold them.
    """
    tables = checks.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("check", "column_name", "source", "target", "pass", "error"))).alias("checks"),
        F.bool_and("pass").alias("pass"),
    )
    return tables.agg(
        F.sort_array(F.collect_list(F.struct("table_name", "checks", "pass"))).alias("tables"),
        F.coalesce(F.bool_and("pass"), F.lit(True)).alias("all_pass"),
    ).select(
        F.lit((at or datetime.now(timezone.utc)).isoformat()).alias("validated_at"),
        F.lit(source_engine).alias("source_engine"),
        F.lit(target_engine).alias("target_engine"),
        "tables",
        "all_pass",
    )


def write_report(checks: DataFrame, folder: str, source_engine: str, target_engine: str) -> None:
    """The report as one JSON document."""
    report(checks, source_engine, target_engine).write.mode("overwrite").json(folder)
