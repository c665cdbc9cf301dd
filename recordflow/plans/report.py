"""The text report of a structuring run, as ordered lines."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

# Texts of the report and type names shown for columns.
RULE = "=" * 80
TITLE = "RELATÓRIO DE ESTRUTURAÇÃO DE DADOS - "
SUMMARY, QUALITY, DETAIL = "RESUMO GERAL", "QUALIDADE DOS DADOS", "DETALHAMENTO POR COLUNA"
TYPE_NAMES = {
    "bigint": "Int64",
    "int": "Int64",
    "double": "float64",
    "boolean": "bool",
    "timestamp": "datetime64[ns]",
    "timestamp_ntz": "datetime64[ns]",
    "string": "object",
}


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def two_decimals(c: Column) -> Column:
    return F.translate(F.format_number(c, 2), ",", "")


def plain_number(c: Column) -> Column:
    """A double without exponent: whole numbers with one decimal."""
    whole = (c == F.floor(c)) & (F.abs(c) < 1e16)
    return F.when(whole, F.translate(F.format_number(c, 1), ",", "")).otherwise(c.cast("string"))


def _heading(*titles: str) -> list[str]:
    return [RULE, *titles, RULE]


def _type_name(dtype: Column) -> Column:
    named = F
    for kind, name in TYPE_NAMES.items():
        named = named.when(dtype == kind, F.lit(name))
    return named.otherwise(dtype)


def column_lines(profile: DataFrame) -> DataFrame:
    """``position, line_no, line``: the detail block of every profiled column."""
    share = F.lit(100.0) - F.col("pct_null")
    lines = F.array(
        F.lit(""),
        F.concat(F.lit("Coluna: "), "column"),
        F.concat(F.lit("  Tipo: "), _type_name(F.col("dtype"))),
        F.concat(F.lit("  Não Nulos: "), thousands(F.col("non_null")), F.lit(" ("), two_decimals(share), F.lit("%)")),
        F.concat(F.lit("  Nulos: "), thousands(F.col("nulls")), F.lit(" ("), two_decimals(F.col("pct_null")), F.lit("%)")),
        F.when(
            F.col("min").isNotNull(),
            F.concat(
                F.lit("  Min: "), plain_number(F.col("min")), F.lit(", Max: "), plain_number(F.col("max")),
                F.lit(", Média: "), two_decimals(F.col("mean")),
            ),
        ),
        F.when(
            F.col("true_count").isNotNull(),
            F.concat(
                F.lit("  True: "), thousands(F.col("true_count")), F.lit(", False: "), thousands(F.col("false_count"))
            ),
        ),
    )
    return profile.select("position", F.posexplode(F.filter(lines, lambda x: x.isNotNull())).alias("line_no", "line"))


def distribution_lines(values: DataFrame, label: str) -> DataFrame:
    """``value, line`` for a distribution; its order is that of the values."""
    line = F.concat(
        F.lit(label + " "), F.col("value").cast("string"), F.lit(": "), thousands(F.col("n")), F.lit(" ("),
        two_decimals(F.col("pct")), F.lit("%)"),
    )
    return values.select("value", line.alias("line"))


def report_lines(
    dataset: str,
    source: str,
    target: str,
    processed_at: datetime,
    columns: int,
    totals: DataFrame,
    profile: DataFrame,
    distributions: Mapping[tuple[str, str], DataFrame],
) -> DataFrame:
    """``section, line_no, key, line``: sort by the first three to print.

    The head hangs on the single totals row, further fixed text on a constant
    row; distributions and column details stay distributed rows. So each of
    the given frames is computed once per section it gives; give it stored rows.
    """
    constant = totals.sparkSession.range(1)

    def fixed(section: int, lines: list[Column], row: DataFrame = constant) -> DataFrame:
        return row.select(F.posexplode(F.array(*lines)).alias("line_no", "line")).select(
            F.lit(section).alias("section"), F.col("line_no").cast("long"), F.lit(None).cast("string").alias("key"),
            F.lit(None).cast("double").alias("number"), "line",
        )

    def texts(lines: list[str]) -> list[Column]:
        return [F.lit(x) for x in lines]

    # The wording of the report, line by line.
    head = [
        *texts(_heading(TITLE + dataset)),
        F.lit(f"Data/Hora: {processed_at:%Y-%m-%d %H:%M:%S}"),
        F.lit(f"Arquivo de Origem: {source}"),
        *texts(["", *_heading(SUMMARY)]),
        F.concat(F.lit("Total de Registros: "), thousands(F.col("total"))),
        F.lit(f"Total de Colunas: {columns}"),
        *texts(["", *_heading(QUALITY)]),
        F.concat(
            F.lit("Registros Completos: "), thousands(F.col("complete")), F.lit(" ("),
            two_decimals(F.col("pct_complete")), F.lit("%)"),
        ),
        F.concat(F.lit("Com Descritores: "), thousands(F.col("described"))),
        F.concat(F.lit("Publicados na Internet: "), thousands(F.col("published"))),
        F.lit(""),
    ]
    parts = [fixed(0, head, totals)]
    section = 1
    for (title, label), values in distributions.items():
        parts.append(fixed(section, texts(_heading(title))))
        parts.append(
            distribution_lines(values, label).select(
                F.lit(section + 1).alias("section"), F.lit(0).cast("long").alias("line_no"),
                F.col("value").cast("string").alias("key"), F.col("value").try_cast("double").alias("number"), "line",
            )
        )
        parts.append(fixed(section + 2, texts([""])))
        section += 3
    parts.append(fixed(section, texts(_heading(DETAIL))))
    parts.append(
        column_lines(profile).select(
            F.lit(section + 1).alias("section"),
            (F.col("position") * 100 + F.col("line_no")).cast("long").alias("line_no"),
            F.lit(None).cast("string").alias("key"), F.lit(None).cast("double").alias("number"), "line",
        )
    )
    parts.append(fixed(section + 2, texts(["", RULE, f"Arquivo Processado: {target}", RULE])))
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionAll(part)
    return lines


def in_print_order(lines: DataFrame) -> DataFrame:
    """The lines alone, in reading order; numeric values sort as numbers."""
    return lines.orderBy("section", "line_no", "number", "key").select("line")


def write_report(lines: DataFrame, path: str) -> None:
    """Text files whose names sort as the lines do: distributions have a line per value and may be long."""
    in_print_order(lines).write.mode("overwrite").text(path)
