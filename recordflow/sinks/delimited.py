"""Writing record files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

# The file dialect and formats.
DIALECT = {
    "sep": ";",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
DATE_FORMAT = "yyyy-MM-dd"


def render_flags(df: DataFrame) -> DataFrame:
    """Booleans as ``True`` / ``False`` text, all other columns unchanged."""
    return df.select(
        *[
            F.initcap(F.col(f"`{f.name}`").cast("string")).alias(f.name)
            if isinstance(f.dataType, T.BooleanType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_records_csv(df: DataFrame, path: str, date_format: str = DATE_FORMAT, mode: str = "errorifexists") -> None:
    """One ``;`` file per partition with header; NULL and empty text are both empty.

    Unlike a single spreadsheet file there is no byte-order mark: Spark writes
    many files, and the reader needs none.
    """
    (
        render_flags(df)
        .write.mode(mode)
        .options(
            header="true",
            dateFormat=date_format,
            timestampFormat=date_format,
            timestampNTZFormat=date_format,
            **DIALECT,
        )
        .csv(path)
    )


def write_structured(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Replace the structured data set under its fixed name; Parquet keeps the types.

    Readers see nothing while it is rewritten; where that matters, use
    :func:`recordflow.sinks.versions.write_version`.
    """
    if fmt == "csv":
        write_records_csv(df, path, mode="overwrite")
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def text_lines(df: DataFrame) -> DataFrame:
    """Every row as one ``;``-joined line, the form of the text export."""
    flat = render_flags(df)
    return flat.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in flat.columns]), DIALECT).alias("value"))


def write_text(df: DataFrame, path: str) -> None:
    text_lines(df).write.text(path)


def preview_lines(df: DataFrame, *order: str, rows: int = 10, columns: int = 5, width: int = 20) -> DataFrame:
    """Summary lines of the first rows: leading columns, each cut to a width."""
    names = df.columns[:columns]
    cells = [F.substring(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")), 1, width) for c in names]
    return df.orderBy(*order).limit(rows).select(F.concat_ws(" | ", *cells).alias("line"))


def preview_header(df: DataFrame, columns: int = 5) -> DataFrame:
    """Total and column line of the summary."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.lit(", ".join(df.columns[:columns])).alias("columns"))


def run_metrics(
    df: DataFrame, files: DataFrame | None = None, started: datetime | None = None, finished: datetime | None = None
) -> DataFrame:
    """One row: rows, columns, the size of a file inventory in MB and the run's duration."""
    seconds = (finished - started).total_seconds() if started and finished else None
    if files is None:
        size = F.lit(None).cast("double")
    else:
        size = F.round(files.agg(F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1048576)).scalar(), 2)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), size.alias("size_mb"),
        F.lit(seconds).cast("double").alias("duration_seconds"),
    )
