"""Column profile and value distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def percent(part: Column, total: Column) -> Column:
    """Share in percent as DOUBLE, 0 for an empty total."""
    return F.coalesce(F.try_divide(part.cast("double") * 100, total.cast("double")), F.lit(0.0))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, NULL counts, numeric range and mean, flag counts.

    One global aggregate over one scan, map-side combined, then the single
    result row is turned into long form.
    """
    return profile_rows(df.agg(*profile_metrics(df.schema, columns)), df.schema, columns)


def _fields(schema: T.StructType, columns: Sequence[str] | None) -> list[T.StructField]:
    return [f for f in schema.fields if columns is None or f.name in columns]


def profile_metrics(schema: T.StructType, columns: Sequence[str] | None = None) -> list[Column]:
    """The aggregates of :func:`profile`; SQL text because a wide table needs several hundred of them."""
    aggs = ["count(1) AS n"]
    for i, f in enumerate(_fields(schema, columns)):
        c = "`" + f.name.replace("`", "``") + "`"
        aggs.append(f"count({c}) AS c{i}")
        if isinstance(f.dataType, NUMERIC):
            aggs += [f"CAST({fn}({c}) AS DOUBLE) AS {fn}{i}" for fn in ("min", "max", "avg")]
        elif isinstance(f.dataType, T.BooleanType):
            aggs += [f"count_if({c}) AS t{i}", f"count_if(NOT {c}) AS f{i}"]
    return [F.expr(x) for x in aggs]


def profile_rows(row: DataFrame, schema: T.StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """The row of :func:`profile_metrics` in long form."""
    rows = []
    for i, f in enumerate(_fields(schema, columns)):
        low = high = mean = "CAST(NULL AS DOUBLE)"
        true = false = "CAST(NULL AS BIGINT)"
        if isinstance(f.dataType, NUMERIC):
            low, high, mean = f"min{i}", f"max{i}", f"avg{i}"
        elif isinstance(f.dataType, T.BooleanType):
            true, false = f"t{i}", f"f{i}"
        rows.append(
            f"named_struct('position', {i}, 'column', {_text(f.name)}, 'dtype', {_text(f.dataType.simpleString())}, "
            f"'non_null', c{i}, 'nulls', n - c{i}, "
            f"'pct_null', coalesce(try_divide(CAST(n - c{i} AS DOUBLE) * 100, CAST(n AS DOUBLE)), 0D), "
            f"'min', {low}, 'max', {high}, 'mean', {mean}, 'true_count', {true}, 'false_count', {false})"
        )
    return row.selectExpr(f"inline(array({', '.join(rows)}))")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Value counts without NULL, with the share of **all** rows.

    One pass: the total is the sum of all groups, NULL included; the sub-query
    reuses the grouped rows' exchange and reads nothing again.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.where(F.col("value").isNotNull()).select("value", "n", percent(F.col("n"), total).alias("pct"))
