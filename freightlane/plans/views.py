"""The six summary views over datasource, dashboard, custom-query, usage and event tables.

Each takes the tables it reads as DataFrames and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from freightlane.functions.scalars import as_text, blank_to_null, joined_text, or_zero
from freightlane.functions.types import is_integral
from freightlane.operators.joins import comparable, fan_out_join, key_of
from freightlane.operators.lanes import distinct_from, lane_counts

DATASOURCE = "Datasource"
WORKBOOK = "Workbook"


def _flagged(details: DataFrame, flag: object) -> DataFrame:
    """The rows of one kind. The flag is compared as it is stored, so the filter reaches the scan."""
    return details.filter(F.col("flag") == F.lit(flag))


def _per_source(column: str) -> Column:
    """Values of a column, told apart by the datasource they belong to."""
    return joined_text(F.col("datasource_id"), F.lit("||"), F.col(column))


DATASOURCE_GROUP = ("datasource_id", "datasource", "contains_extract", "ds_project")
#: The counts of a datasource, and what each of them counts.
DATASOURCE_COUNTS = {
    "dashboard_cnt": "dashboard_id",
    "sheet_cnt": "sheet_id",
    "field_cnt": "field_id",
    "workbook_cnt": "workbook_id",
    "table_cnt": "table_name",
    "column_cnt": "column_name",
}


def datasource_lanes(
    datasource_details: DataFrame, flag: object = DATASOURCE, weight: Column | None = None, lanes: Callable[..., DataFrame] = lane_counts
) -> DataFrame:
    """How often each value stands in each datasource group: what the summary's counts are read from. `lanes` is lane_counts or,
    to be added up later, lane_rows."""
    counted = {name: blank_to_null(F.col(c)) for name, c in DATASOURCE_COUNTS.items()}
    return lanes(_flagged(datasource_details, flag), DATASOURCE_GROUP, counted, weight)


def query_ids(custom_queries: DataFrame) -> Column:
    whole = is_integral(custom_queries.schema["custom_query_id"].dataType)
    return F.col("custom_query_id") if whole else blank_to_null(F.col("custom_query_id"))


def datasource_summary(datasource_details: DataFrame, custom_queries: DataFrame, flag: object = DATASOURCE) -> DataFrame:
    """Per datasource: how many dashboards, sheets, fields, workbooks, tables, columns, custom queries.

    A custom query belongs to a datasource when the two ids are equal, and the datasource id is a grouping
    key. So the left join can run on the grouped rows: at most one custom query id can match a group. `flag` is what
    marks datasource rows.
    """
    found = custom_queries.select(query_ids(custom_queries).alias("query_id")).filter(F.col("query_id").isNotNull()).distinct()
    return datasource_summary_of(datasource_lanes(datasource_details, flag), found)


def datasource_summary_of(lanes: DataFrame, found: DataFrame) -> DataFrame:
    """The summary from the counted values of datasource_lanes() and the distinct query ids (query_id)."""
    groups = distinct_from(lanes, DATASOURCE_GROUP, list(DATASOURCE_COUNTS))
    plain = comparable(lanes.schema["datasource_id"].dataType, found.schema["query_id"].dataType)
    return groups.join(found, key_of(F.col("datasource_id"), plain) == key_of(F.col("query_id"), plain), "left").select(
        *groups.columns, F.when(F.col("query_id").isNotNull(), 1).otherwise(0).cast("long").alias("custom_query_cnt")
    )


def _newest_first(history: DataFrame, *names: str) -> DataFrame:
    """Distinct load times and names. Sorting by the names too lets one large load spread over many tasks."""
    return history.select("load_time", *names).distinct().orderBy(F.desc("load_time"), *names)


def datasource_load_log(datasource_history: DataFrame) -> DataFrame:
    """When each datasource was loaded, newest first."""
    return _newest_first(datasource_history, "datasource", "datasource_id")


def datasource_interactions(
    datasource_details: DataFrame, events: DataFrame, flag: object = DATASOURCE, salts: int = 0
) -> DataFrame:
    """One row per event and matching datasource detail row. `salts` deals the events of hot items over so many parts."""
    named = events.select(
        "event_id", "item_luid", F.col("event_type").alias("interaction_type"), F.col("event_date").alias("interaction_date")
    )
    return fan_out_join(
        _flagged(datasource_details, flag), named, "datasource_luid", "item_luid", ["datasource", "datasource_id"], salts
    ).select("event_id", "datasource", "datasource_id", "interaction_type", "interaction_date")


#: The counts of a workbook: those of its datasource rows, of its dashboard rows and of its custom queries.
OFFERED = ("datasource_cnt", "total_field_cnt", "total_column_cnt", "total_table_cnt")
USED = ("dashboard_cnt", "sheet_cnt", "used_field_cnt", "used_column_cnt", "used_table_cnt")
QUERIED = ("custom_query_cnt",)
#: The tables of the workbook summary, by what each is grouped, and on what the groups are joined.
WORKBOOK_GROUPS = {"offered": ("workbook_id",), "used": ("workbook_id", "workbook"), "queries": ("workbook_id",), "views": ("workbook_id",)}
WORKBOOK_KEY = ("workbook_id",)


def workbook_lanes(
    dashboard_details: DataFrame | None,
    datasource_details: DataFrame | None,
    custom_queries: DataFrame | None,
    usage: DataFrame | None,
    flag: object = WORKBOOK,
    plain: bool | None = None,
    weight: int = 1,
    lanes: Callable[..., DataFrame] = lane_counts,
) -> dict[str, DataFrame]:
    """The counted values that the workbook summary is read from, for the tables that are given.

    Ids are made text before grouping unless all are whole numbers (`plain`), so the grouped rows are already partitioned
    by the join key. `weight` -1 counts deleted rows. `lanes` is lane_counts or, to be added up later, lane_rows.
    """
    tables = [t for t in (dashboard_details, datasource_details, custom_queries, usage) if t is not None]
    plain = all(is_integral(t.schema["workbook_id"].dataType) for t in tables) if plain is None else plain
    sign = F.lit(weight)

    def keyed(table: DataFrame) -> DataFrame:
        return table.withColumn("workbook_id", key_of(F.col("workbook_id"), plain))

    out = {}
    if datasource_details is not None:
        counted = (F.col("datasource_id"), F.col("field_id"), _per_source("column_name"), _per_source("table_name"))
        rows = keyed(_flagged(datasource_details, flag))
        out["offered"] = lanes(rows, WORKBOOK_GROUPS["offered"], dict(zip(OFFERED, counted, strict=True)), sign)
    if dashboard_details is not None:
        counted = (
            F.col("dashboard_id"), F.col("sheet_id"), F.col("field_id"), _per_source("column_name"), _per_source("table_name")
        )
        out["used"] = lanes(keyed(dashboard_details), WORKBOOK_GROUPS["used"], dict(zip(USED, counted, strict=True)), sign)
    if custom_queries is not None:
        out["queries"] = lanes(keyed(custom_queries), WORKBOOK_GROUPS["queries"], {QUERIED[0]: F.col("custom_query_id")}, sign)
    if usage is not None:
        views = F.coalesce(F.col("total_views").cast("long"), F.lit(0).cast("long")) * weight
        out["views"] = lanes(keyed(usage), WORKBOOK_GROUPS["views"], {}, views)
    return out


def workbook_summary(
    dashboard_details: DataFrame,
    datasource_details: DataFrame,
    custom_queries: DataFrame,
    usage: DataFrame,
    flag: object = WORKBOOK,
) -> DataFrame:
    """Per workbook: what its dashboards use, against what its datasources offer, plus queries and views.

    Every input is reduced to one row per workbook before the joins.
    """
    return workbook_summary_of(workbook_lanes(dashboard_details, datasource_details, custom_queries, usage, flag))


def workbook_summary_of(lanes: Mapping[str, DataFrame]) -> DataFrame:
    """The summary from the counted values of workbook_lanes()."""
    names = {"offered": OFFERED, "used": USED, "queries": QUERIED}
    offered, used, queries = (distinct_from(lanes[k], WORKBOOK_GROUPS[k], n) for k, n in names.items())
    views = distinct_from(lanes["views"], WORKBOOK_GROUPS["views"], (), rows="view_cnt")
    joined = used.join(offered, "workbook_id", "left").join(queries, "workbook_id", "left").join(views, "workbook_id", "left")
    return joined.select(
        as_text(F.col("workbook_id")).alias("workbook_id"),
        "workbook",
        "dashboard_cnt",
        "sheet_cnt",
        or_zero(F.col("datasource_cnt")).alias("datasource_cnt"),
        or_zero(F.col("total_field_cnt")).alias("total_field_cnt"),
        "used_field_cnt",
        or_zero(F.col("total_column_cnt")).alias("total_column_cnt"),
        "used_column_cnt",
        or_zero(F.col("total_table_cnt")).alias("total_table_cnt"),
        "used_table_cnt",
        or_zero(F.col("custom_query_cnt")).alias("custom_query_cnt"),
        or_zero(F.col("view_cnt")).alias("view_cnt"),
    )


def workbook_load_log(dashboard_history: DataFrame) -> DataFrame:
    """When each workbook was loaded, newest first."""
    return _newest_first(dashboard_history, "workbook", "workbook_id")


def workbook_interactions(usage: DataFrame, events: DataFrame) -> DataFrame:
    """One row per event and matching usage row. Usage has a row per view, so a plain join does; a view with
    very many events is split by Spark's skew join."""
    plain = comparable(usage.schema["view_id"].dataType, events.schema["item_luid"].dataType)
    return usage.join(events, key_of(usage["view_id"], plain) == key_of(events["item_luid"], plain)).select(
        events["event_id"], usage["workbook"], usage["workbook_id"], events["event_type"], events["event_date"]
    )


# The name of each view and of the tables it reads.
VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "datasource_details_base_smry": (datasource_summary, ("datasource_details_base", "custom_query_details_base")),
    "datasource_details_load_log": (datasource_load_log, ("datasource_details_hist",)),
    "datasource_interaction_smry": (datasource_interactions, ("datasource_details_base", "event_details_base")),
    "workbook_details_base_smry": (
        workbook_summary,
        ("dashboard_details_base", "datasource_details_base", "custom_query_details_base", "usage_statistics_base"),
    ),
    "workbook_details_load_log": (workbook_load_log, ("dashboard_details_hist",)),
    "workbook_interaction_smry": (workbook_interactions, ("usage_statistics_base", "event_details_base")),
}


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Make every view whose tables are given available to SQL under its name; the names registered."""
    ready = [name for name, (_, needed) in VIEWS.items() if all(t in tables for t in needed)]
    for name in ready:
        build, needed = VIEWS[name]
        build(*[tables[t] for t in needed]).createOrReplaceTempView(name)
    return ready
