"""Views that follow their tables batch by batch, without reading the tables again.

For the summaries, how often each (group, column, value) stands in a table is kept (operators/lanes.py). A batch adds the counts
of its new rows and takes away those of its deleted rows; a value counts as long as its count is above zero. Every batch
stores its own counts in its own folder, so repeating a batch replaces what it had stored. The views are read from the sum of
all batches, and `compact` makes one batch of them.

The interaction views are joins. What a batch adds to them is the join of its new rows with the other table, both ways.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from freightlane.operators.lanes import added, distinct_from, gathered, lane_rows
from freightlane.operators.load import BATCH, RUN, batch_folder
from freightlane.plans import views

#: What is kept for each summary view: part -> the columns it is grouped by.
DATASOURCE_PARTS = {"details": views.DATASOURCE_GROUP, "queries": ("query_id",)}
WORKBOOK_PARTS = views.WORKBOOK_GROUPS


def store(parts: Mapping[str, DataFrame], place: str, run: str, batch: int) -> None:
    """Keep a batch's counts; a repeated batch replaces its own.

    The parts are independent jobs, submitted together so that the last tasks of one leave no cores idle.
    """

    def keep(part: str) -> None:
        parts[part].write.mode("overwrite").parquet(batch_folder(f"{place}/{part}", run, batch))

    with ThreadPoolExecutor(max(1, len(parts))) as pool:
        list(pool.map(keep, parts))


def stored(spark: SparkSession, place: str, part: str) -> DataFrame:
    """All batches' counts of a part."""
    return spark.read.parquet(f"{place}/{part}").drop(RUN, BATCH)


def recall(spark: SparkSession, place: str, part: str, group: Sequence[str]) -> DataFrame:
    """The sum of all batches' counts of a part."""
    return added(stored(spark, place, part), group)


def recall_groups(spark: SparkSession, place: str, part: str, group: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """The sum of all batches' counts of a part for distinct_from(), which then needs no shuffle but for hot groups."""
    return gathered(stored(spark, place, part), group, by)


def compact(spark: SparkSession, place: str, into: str, groups: Mapping[str, Sequence[str]], run: str = "compacted") -> None:
    """The counts of all batches as one batch of another folder, to go on from there."""
    store({part: recall(spark, place, part, group) for part, group in groups.items()}, into, run, 0)


def plus_minus(new: DataFrame | None, gone: DataFrame | None, lanes: Callable[[DataFrame, int], DataFrame], group: Sequence[str]) -> DataFrame:
    """The counts of new rows less those of deleted ones; an update is both. `lanes` gives rows that are not added up yet."""
    return one_sum([lanes(rows, sign) for rows, sign in ((new, 1), (gone, -1)) if rows is not None], group)


def one_sum(sides: Sequence[DataFrame], group: Sequence[str]) -> DataFrame:
    return added(sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1]), group)


def follow_datasources(
    place: str,
    run: str,
    batch: int,
    details: DataFrame | None = None,
    gone: DataFrame | None = None,
    queries: DataFrame | None = None,
    gone_queries: DataFrame | None = None,
    flag: object = views.DATASOURCE,
) -> None:
    """Add a batch of datasource details and custom queries, new and deleted ones, to what the summary is read from."""
    parts = {}
    if details is not None or gone is not None:
        lanes = lambda rows, sign: views.datasource_lanes(rows, flag, F.lit(sign), lane_rows)
        parts["details"] = plus_minus(details, gone, lanes, DATASOURCE_PARTS["details"])
    if queries is not None or gone_queries is not None:
        ids = lambda rows, sign: lane_rows(
            rows.select(views.query_ids(rows).alias("query_id")).filter(F.col("query_id").isNotNull()), ("query_id",), {}, F.lit(sign)
        )
        parts["queries"] = plus_minus(queries, gone_queries, ids, DATASOURCE_PARTS["queries"])
    store(parts, place, run, batch)


def datasource_summary(spark: SparkSession, place: str) -> DataFrame:
    details, queries = (recall_groups(spark, place, part, group) for part, group in DATASOURCE_PARTS.items())
    return views.datasource_summary_of(details, distinct_from(queries, DATASOURCE_PARTS["queries"], ()))


def follow_workbooks(
    place: str, run: str, batch: int, new: Mapping[str, DataFrame], gone: Mapping[str, DataFrame] | None = None, flag: object = views.WORKBOOK, plain: bool = True
) -> None:
    """Add a batch to what the workbook summary is read from.

    new, gone: the rows by parameter of views.workbook_lanes(). `plain` says that all workbook ids are whole numbers; it has to be
    the same for all batches, as not every batch has rows of all tables to tell it from.
    """
    tables = ("dashboard_details", "datasource_details", "custom_queries", "usage")
    sides = [
        views.workbook_lanes(**{t: rows.get(t) for t in tables}, flag=flag, plain=plain, weight=sign, lanes=lane_rows)
        for rows, sign in ((new, 1), (gone or {}, -1))
    ]
    parts = {}
    for part, group in WORKBOOK_PARTS.items():
        found = [side[part] for side in sides if part in side]
        if found:
            parts[part] = one_sum(found, group)
    store(parts, place, run, batch)


def workbook_summary(spark: SparkSession, place: str) -> DataFrame:
    by = views.WORKBOOK_KEY
    return views.workbook_summary_of({part: recall_groups(spark, place, part, group, by) for part, group in WORKBOOK_PARTS.items()})


def follow_log(place: str, run: str, batch: int, history: DataFrame, names: Sequence[str], gone: DataFrame | None = None) -> None:
    """Add a batch of a history table to what its load log is read from."""
    group = ("load_time", *names)
    lanes = lambda rows, sign: lane_rows(rows, group, {}, F.lit(sign))
    store({"log": plus_minus(history, gone, lanes, group)}, place, run, batch)


def load_log(spark: SparkSession, place: str, names: Sequence[str]) -> DataFrame:
    group = ("load_time", *names)
    return distinct_from(recall_groups(spark, place, "log", group), group, ()).orderBy(F.desc("load_time"), *names)


def new_interactions(
    view: Callable[[DataFrame, DataFrame], DataFrame], details: DataFrame, new_details: DataFrame, events: DataFrame, new_events: DataFrame
) -> DataFrame:
    """What new rows of either table add to an interaction view; details and events are the tables without them.

    The new rows are the small side of both joins, so the tables are filtered by them and need not be shuffled.
    """
    return view(new_details, events).unionByName(view(details.unionByName(new_details), new_events))
