"""Options for reading and writing tables over JDBC.

No database is needed to build them; the driver jar is given to Spark with spark.jars.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000
BATCH_SIZE = 5_000

# JDBC driver class and how an identifier is quoted, per engine.
DRIVERS = {
    "postgres": "org.postgresql.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "mysql": "com.mysql.cj.jdbc.Driver",
}
QUOTES = {"postgres": ('"', '"'), "sqlserver": ("[", "]"), "mysql": ("`", "`")}
PORTS = {"postgres": 5432, "sqlserver": 1433, "mysql": 3306}
READ_UNCOMMITTED = "SET TRANSACTION ISOLATION LEVEL READ UNCOMMITTED"


def url(engine: str, host: str, database: str, port: int | None = None) -> str:
    port = port or PORTS[engine]
    if engine == "sqlserver":
        return f"jdbc:sqlserver://{host}:{port};databaseName={database}"
    if engine == "mysql":
        return f"jdbc:mysql://{host}:{port}/{database}?rewriteBatchedStatements=true"
    return f"jdbc:postgresql://{host}:{port}/{database}"


def identifier(engine: str, name: str) -> str:
    """A quoted name; 'schema.table' is quoted part by part."""
    left, right = QUOTES[engine]
    return ".".join(left + part.replace(right, right * 2) + right for part in name.split("."))


def read_options(
    engine: str, connection: str, table: str, user: str, password: str, dirty: bool = False
) -> dict[str, str]:
    """Options of a table read. `dirty` reads without waiting for writers, on engines that lock readers."""
    options = {
        "url": connection,
        "driver": DRIVERS[engine],
        "dbtable": identifier(engine, table),
        "user": user,
        "password": password,
        "fetchsize": str(FETCH_SIZE),
        "pushDownPredicate": "true",
    }
    if dirty and engine == "sqlserver":
        options["sessionInitStatement"] = READ_UNCOMMITTED
    return options


def range_options(column: str, low: int, high: int, partitions: int) -> dict[str, str]:
    """Options that read a numeric key in equal ranges, one task each. The outer ranges are open."""
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(partitions),
    }


def boundary_predicates(engine: str, column: str, boundaries: Sequence[object]) -> list[str]:
    """One predicate per range between boundaries, for keys of any ordered type (numbers, text, UUIDs).

    Together they cover every row once: the first also takes NULL keys and the last is open.
    """
    name = identifier(engine, column)

    def literal(value: object) -> str:
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"

    if not boundaries:
        return ["1 = 1"]
    cuts = [literal(b) for b in boundaries]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{name} < {cuts[0]} OR {name} IS NULL", *inner, f"{name} >= {cuts[-1]}"]


def range_predicates(engine: str, column: str, low: int, high: int, pages: int) -> list[str]:
    """Predicates for equal ranges of an integer key."""
    span = high - low + 1
    cuts = sorted({low + span * i // pages for i in range(1, pages)} - {low})
    return boundary_predicates(engine, column, cuts)


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    ranges: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A table read in parallel, by key ranges or by one predicate per task."""
    if predicates:
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(predicates), properties=rest)
    return spark.read.format("jdbc").options(**options, **(ranges or {})).load()


def write_options(engine: str, connection: str, table: str, user: str, password: str, writers: int) -> dict[str, str]:
    """Options of an append. `writers` bounds the connections; each task commits as one transaction."""
    return {
        "url": connection,
        "driver": DRIVERS[engine],
        "dbtable": identifier(engine, table),
        "user": user,
        "password": password,
        "batchsize": str(BATCH_SIZE),
        "numPartitions": str(writers),
        "isolationLevel": "READ_COMMITTED",
    }


def append_table(df: DataFrame, options: Mapping[str, str]) -> None:
    """Append rows; give it the result of load.new_rows so that known keys are not sent again."""
    df.write.format("jdbc").options(**options).mode("append").save()


def catalog_settings(name: str, engine: str, connection: str, user: str, password: str) -> dict[str, str]:
    """Session settings for a JDBC catalog, whose tables take aggregates and limits pushed down.

    With it a count, sum, minimum or maximum over a remote table runs in the database.
    """
    prefix = f"spark.sql.catalog.{name}"
    return {
        prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        f"{prefix}.url": connection,
        f"{prefix}.driver": DRIVERS[engine],
        f"{prefix}.user": user,
        f"{prefix}.password": password,
        f"{prefix}.pushDownAggregate": "true",
        f"{prefix}.pushDownLimit": "true",
    }
