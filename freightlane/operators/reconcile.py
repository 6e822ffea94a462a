"""Compare a source table with its loaded target: checks, verdicts and the row-level diff."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from freightlane.functions.compare import counts_match, values_match
from freightlane.functions.scalars import literal, quoted, stacked
from freightlane.functions.types import (
    NUMERIC_TYPES,
    TEMPORAL_TYPES,
    is_fractional,
    is_integral,
    is_temporal,
)
from freightlane.operators.profile import distinct_counts
from freightlane.plans.contract import ColumnSpec, Contract

ROW_COUNT, SUM, MIN, MAX, DISTINCT = "L1_ROW_COUNT", "L2_SUM", "L2_MIN", "L2_MAX", "L3_DISTINCT"
CHECKS = "table_name string, check string, column_name string, source string, target string, pass boolean, error string"


def _planned(contract: Contract) -> list[tuple[str, ColumnSpec]]:
    """Which checks a contract asks for, column by column."""
    plan = []
    for spec in contract.columns:
        if spec.base in NUMERIC_TYPES:
            plan.append((SUM, spec))
        if spec.base in NUMERIC_TYPES | TEMPORAL_TYPES:
            plan += [(MIN, spec), (MAX, spec)]
        if spec.target in contract.key:
            plan.append((DISTINCT, spec))
    return plan


def _problem(df: DataFrame | None, side: str, name: str, check: str, spec: ColumnSpec) -> str | None:
    """Why a check cannot run on this side, or None."""
    if df is None:
        return f"{side} table is missing"
    types = {f.name.lower(): f.dataType for f in df.schema}
    dtype = types.get(name.lower())
    if dtype is None:
        return f"{side} column {name} is missing"
    numeric = is_integral(dtype) or is_fractional(dtype)
    if check == SUM and not numeric:
        return f"{side} column {name} is {dtype.simpleString()}, not a number"
    if check in (MIN, MAX) and not (is_temporal(dtype) if spec.base in TEMPORAL_TYPES else numeric):
        return f"{side} column {name} is {dtype.simpleString()}, not {spec.base}"
    return None


def _aggregate(check: str, column: str, dtype: T.DataType) -> Column:
    c = quoted(column)
    if check == SUM:
        # Integers are added as decimals: a 64-bit sum overflows on large tables.
        return F.expr(f"string(coalesce(sum({f'CAST({c} AS DECIMAL(20,0))' if is_integral(dtype) else c}), 0))")
    return F.expr(f"string({'min' if check == MIN else 'max'}({c}))")


def _measured(df: DataFrame, checks: Sequence[tuple[str, str, str]], label: str) -> DataFrame:
    """(check, column_name, <label>) for one side; `checks` are (check, column of df, reported name).

    All counts, sums and extremes come from one pass without a shuffle of rows; distinct keys are counted
    apart, reading only the key columns.
    """
    types = {f.name.lower(): f.dataType for f in df.schema}
    facts = df.agg(
        F.expr("string(count(1))").alias("n"),
        *[
            _aggregate(check, c, types[c.lower()]).alias(f"a{i}")
            for i, (check, c, _) in enumerate(checks)
            if check != DISTINCT
        ],
    )
    rows = [(literal(ROW_COUNT), literal(None), literal(None), "n")]
    for i, (check, c, name) in enumerate(checks):
        key, value = (literal(c), literal(None)) if check == DISTINCT else (literal(None), f"a{i}")
        rows.append((literal(check), literal(name), key, value))
    long = stacked(facts, ("check", "column_name", "key_column", "value"), rows)
    keys = [c for check, c, _ in checks if check == DISTINCT]
    if not keys:
        return long.select("check", "column_name", F.col("value").alias(label))
    # One row per key column; a column without any value has none, which is a count of zero.
    counts = F.broadcast(distinct_counts(df, keys).withColumnRenamed("column_name", "key_column"))
    counted = F.expr("if(key_column IS NULL, value, string(coalesce(distinct_count, 0)))")
    return long.join(counts, "key_column", "left").select("check", "column_name", counted.alias(label))


def table_checks(
    source: DataFrame | None,
    target: DataFrame | None,
    contract: Contract,
    row_count_tolerance: float = 0.0,
    float_tolerance: float = 1e-4,
    strict: bool = True,
    conformed: bool = False,
) -> DataFrame:
    """One row per check of a table: both values as text, whether they match, and why not if they cannot.

    `source` has the contract's source column names, or its target names when `conformed`. With `strict`,
    an empty source needs an empty target. A table or column that is missing or of the wrong kind gives an
    error row and a failed check; it never stops the others.
    """
    frames = [f for f in (source, target) if f is not None]
    if not frames:
        raise ValueError("neither a source nor a target frame was given")
    spark = frames[0].sparkSession
    runnable: list[tuple[str, str, ColumnSpec]] = []
    errors = []
    if len(frames) < 2:
        side = "source" if source is None else "target"
        errors.append((contract.name, ROW_COUNT, None, None, None, False, f"{side} table is missing"))
    for check, spec in _planned(contract):
        source_name = spec.target if conformed else spec.source_name
        problem = _problem(source, "source", source_name, check, spec) or _problem(
            target, "target", spec.target, check, spec
        )
        if problem:
            errors.append((contract.name, check, spec.target, None, None, False, problem))
        else:
            runnable.append((check, source_name, spec))
    error_rows = spark.createDataFrame(errors, CHECKS)
    if len(frames) < 2:
        return error_rows
    left = _measured(source, [(check, name, spec.target) for check, name, spec in runnable], "source")
    right = _measured(target, [(check, spec.target, spec.target) for check, _, spec in runnable], "target")
    right = right.withColumnsRenamed({"check": "check_r", "column_name": "column_r"})
    # Both sides have one row per planned check, so the broadcast is bounded by the contract.
    same = (F.col("check") == F.col("check_r")) & F.col("column_name").eqNullSafe(F.col("column_r"))
    paired = left.join(F.broadcast(right), same)
    temporal = [spec.target for spec in contract.columns if spec.base in TEMPORAL_TYPES]
    kind = F.when(F.col("column_name").isin(temporal), "temporal").otherwise("numeric")
    kind = F.when(F.col("check") == DISTINCT, "exact").otherwise(kind)
    counts = counts_match(F.col("source").try_cast("long"), F.col("target").try_cast("long"), row_count_tolerance, strict)
    matched = F.when(F.col("check") == ROW_COUNT, counts).otherwise(
        values_match(F.col("source"), F.col("target"), kind, float_tolerance)
    )
    checked = paired.select(
        F.lit(contract.name).alias("table_name"), "check", "column_name", "source", "target",
        matched.alias("pass"), F.lit(None).cast("string").alias("error"),
    )
    return checked.unionByName(error_rows) if errors else checked


def all_checks(parts: Iterable[DataFrame]) -> DataFrame:
    """The checks of several tables as one frame."""
    return reduce(DataFrame.unionByName, parts)


def reconcile_tables(
    contracts: Iterable[Contract],
    read_source: Callable[[Contract], DataFrame],
    read_target: Callable[[Contract], DataFrame],
    tables: Iterable[str] | None = None,
    at_once: int = 4,
    **options: object,
) -> DataFrame:
    """The checks of every contract, or of the chosen source tables; `options` go to table_checks().

    Tables are independent jobs, `at_once` of them submitted together. A table that cannot be read, or whose checks fail
    while they run, gives error rows and the others go on. The driver holds one row per check; their number
    follows from the contracts, not from the data.
    """
    wanted = set(tables) if tables else None
    chosen = sorted((c for c in contracts if wanted is None or c.source_table in wanted), key=lambda c: c.name)
    if not chosen:
        raise ValueError("no contract was chosen")

    def found(read: Callable[[Contract], DataFrame], contract: Contract) -> DataFrame | None:
        try:
            return read(contract)
        except AnalysisException:
            return None

    def settled(contract: Contract) -> tuple[SparkSession | None, list[tuple]]:
        try:
            checks = table_checks(found(read_source, contract), found(read_target, contract), contract, **options)
            return checks.sparkSession, [tuple(r) for r in checks.collect()]
        except Exception as failure:  # whatever ends this table's job must not end the others
            reason = str(failure).strip().splitlines() or [type(failure).__name__]
            return SparkSession.getActiveSession(), [(contract.name, ROW_COUNT, None, None, None, False, reason[0][:500])]

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        results = list(pool.map(settled, chosen))
    spark = next((s for s, _ in results if s), None) or SparkSession.builder.getOrCreate()
    return spark.createDataFrame([r for _, found_rows in results for r in found_rows], CHECKS)


def table_verdicts(checks: DataFrame) -> DataFrame:
    """A table passes when all its checks do."""
    return checks.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("pass")).alias("passed"),
        F.count_if(~F.col("pass")).alias("failed"),
        F.bool_and("pass").alias("pass"),
    )


def run_verdict(checks: DataFrame) -> DataFrame:
    """One row for the whole run."""
    tables = table_verdicts(checks)
    return tables.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("pass")).alias("tables_passed"),
        F.count_if(~F.col("pass")).alias("tables_failed"),
        F.coalesce(F.sum("passed"), F.lit(0)).alias("checks_passed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("checks_failed"),
        F.coalesce(F.bool_and("pass"), F.lit(True)).alias("all_pass"),
    )


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row. The null flags matter: the hash itself skips NULLs, so (1, NULL) and (NULL, 1)
    would agree."""
    parts = [part for c in columns for part in (F.col(quoted(c)).isNull(), F.col(quoted(c)))]
    return F.xxhash64(F.lit(seed), *parts)


def row_hash_halves(columns: Sequence[str]) -> list[Column]:
    """The halves of two 64-bit row hashes, as numbers that can be summed over very many rows."""
    hashes = [_row_hash(columns, seed) for seed in (17, 71)]
    return [part for h in hashes for part in (F.shiftright(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1)))]


def common_types(source: DataFrame, target: DataFrame) -> dict[str, T.DataType]:
    """The type in which each column of two frames is compared: its own, a whole number for whole numbers of different
    sizes, else text."""
    ours, theirs = ({f.name: f.dataType for f in side.schema} for side in (source, target))

    def wide(c: str) -> T.DataType:
        both_whole = is_integral(ours[c]) and is_integral(theirs[c])
        return ours[c] if ours[c] == theirs[c] else T.LongType() if both_whole else T.StringType()

    return {c: wide(c) for c in source.columns}


def row_diff(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that differ: 'missing' from the target, 'extra' in it, or 'changed', with row counts.

    Both frames have the same columns (conform first). Each side adds its rows to one grouping by key, as
    +1/-1 and plus/minus the halves of two 64-bit row hashes. So one shuffle of narrow, map-side combined
    rows does it, a repeated or hot key stays one row per task, and repeated rows are compared as
    multisets. NULL keys compare like any other value. A column of different types is compared as text, whole
    numbers of different sizes as numbers.
    """
    columns = source.columns
    types = common_types(source, target)

    def signed(df: DataFrame, sign: int) -> DataFrame:
        aligned = df.select(*[F.col(quoted(c)).cast(types[c]).alias(c) for c in columns])
        return aligned.select(
            *[quoted(k) for k in key],
            F.lit(int(sign > 0)).alias("in_source"),
            F.lit(int(sign < 0)).alias("in_target"),
            *[(part * sign).alias(f"h{i}") for i, part in enumerate(row_hash_halves(columns))],
        )

    sides = signed(source, 1).unionByName(signed(target, -1))
    grouped = sides.groupBy(*[quoted(k) for k in key]).agg(
        F.sum("in_source").alias("source_rows"),
        F.sum("in_target").alias("target_rows"),
        *[F.sum(f"h{i}").alias(f"h{i}") for i in range(4)],
    )
    same = reduce(lambda a, b: a & b, [F.col(f"h{i}") == 0 for i in range(4)])
    difference = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "extra")
        .when((F.col("source_rows") != F.col("target_rows")) | ~same, "changed")
    )
    return grouped.select(*[quoted(k) for k in key], difference.alias("difference"), "source_rows", "target_rows").filter(
        F.col("difference").isNotNull()
    )
