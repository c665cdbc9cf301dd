"""Quality counts, de-duplication, profile, distribution and report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from recordflow.bindings.expressions import docs
from recordflow.bindings.registry import bind
from recordflow.operators.dedupe import dedupe_first, duplicate_count
from recordflow.operators.joins import left_join_rows
from recordflow.operators.profile import distribution, profile
from recordflow.operators.quality import quality_counts, quality_totals
from recordflow.plans.report import report_lines
from recordflow.session import scratch_path

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
ASOF = datetime(2000, 1, 1)
DOCS = "documents LEFT JOIN labels USING (doc_id)"


@bind(
    "dq_duplicates",
    """SELECT count(*) - count(DISTINCT CASE WHEN l_orderkey IS NULL THEN 'null' ELSE CAST(l_orderkey AS VARCHAR) END)
         AS duplicates FROM lineitem""",
)
def dq_duplicates(t):
    return duplicate_count(t.lineitem, ["l_orderkey"])


@bind(
    "dedupe_first",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
         l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedupe_first_query(t):
    return dedupe_first(t.lineitem, ["l_orderkey"], LINE_ORDER)


@bind(
    "dq_negatives",
    """SELECT count(*) AS rows, count(*) FILTER (c_acctbal < 0) AS "negative_c_acctbal",
              count(*) FILTER (c_custkey < 0) AS "negative_c_custkey" FROM customer""",
)
def dq_negatives(t):
    return quality_counts(t.customer, ids=["c_custkey", "c_acctbal"])


@bind(
    "dq_future_dates",
    "SELECT count(*) AS rows, count(*) FILTER (o_orderdate > TIMESTAMP '2000-01-01') AS future_o_orderdate FROM orders",
)
def dq_future_dates(t):
    return quality_counts(t.orders, dates=["o_orderdate"], asof=ASOF)


@bind(
    "quality_totals",
    f"""SELECT count(*) AS total, count(quality) AS complete, 100.0::DOUBLE * count(quality) / count(*) AS pct_complete,
               count(*) FILTER (toxic = 1) AS described, CAST(coalesce(sum(quality), 0) AS BIGINT) AS published
        FROM {DOCS}""",
)
def quality_totals_query(t):
    return quality_totals(
        docs(t), F.col("quality").isNotNull() & F.col("toxic").isNotNull(), F.col("toxic") == 1, F.col("quality")
    )


def _null_profile(column: str, position: int, dtype: str) -> str:
    return f"""SELECT {position} AS position, '{column}' AS "column", '{dtype}' AS dtype, count({column}) AS non_null,
        count(*) - count({column}) AS nulls, 100.0::DOUBLE * (count(*) - count({column})) / count(*) AS pct_null FROM d"""


@bind(
    "profile_nulls",
    f"WITH d AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM {DOCS}) "
    + " UNION ALL ".join(
        _null_profile(c, i, k)
        for i, (c, k) in enumerate(
            [("doc_id", "bigint"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
             ("quality", "int"), ("toxic", "int")]
        )
    ),
)
def profile_nulls(t):
    return profile(docs(t, "lang", "source", "n_chars")).select(
        "position", "column", "dtype", "non_null", "nulls", "pct_null"
    )


def _numeric_profile(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max,
        round(avg({column}), 4) AS mean FROM d"""


@bind(
    "profile_numeric",
    """WITH d AS (SELECT o_orderkey, o_totalprice, l_quantity, l_linenumber, CAST(NULL AS BIGINT) AS nothing
                  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey) """
    + " UNION ALL ".join(
        _numeric_profile(c) for c in ("o_orderkey", "o_totalprice", "l_quantity", "l_linenumber", "nothing")
    ),
)
def profile_numeric(t):
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_linenumber")
    rows = left_join_rows(t.orders.select("o_orderkey", "o_totalprice"), lines, "o_orderkey", "l_orderkey")
    rows = rows.withColumn("nothing", F.lit(None).cast("bigint"))
    return profile(rows).select("column", "min", "max", F.round("mean", 4).alias("mean"))


@bind(
    "profile_boolean",
    f"""WITH d AS (SELECT quality = 1 AS good, toxic = 1 AS bad FROM {DOCS})
        SELECT 'good' AS "column", count(good) AS non_null, count(*) FILTER (good) AS true_count,
               count(*) FILTER (NOT good) AS false_count FROM d UNION ALL
        SELECT 'bad', count(bad), count(*) FILTER (bad), count(*) FILTER (NOT bad) FROM d""",
)
def profile_boolean(t):
    flags = docs(t).select((F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("bad"))
    return profile(flags).select("column", "non_null", "true_count", "false_count")


@bind(
    "distribution",
    f"""SELECT quality AS value, count(*) AS n, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM documents) AS pct
        FROM {DOCS} WHERE quality IS NOT NULL GROUP BY quality""",
)
def distribution_query(t):
    return distribution(docs(t), "quality")


@bind(
    "report_lines",
    f"""WITH d AS (SELECT doc_id, n_chars, quality, toxic = 1 AS toxic FROM {DOCS}),
        s AS (SELECT count(*) AS n, count(quality) AS c, count(*) FILTER (toxic) AS x, coalesce(sum(quality), 0) AS p FROM d)
        SELECT line FROM (
          SELECT unnest([repeat('=', 80), 'RELATÓRIO DE ESTRUTURAÇÃO DE DADOS - DOCUMENTS', repeat('=', 80),
            'Data/Hora: 2000-01-01 00:00:00', 'Arquivo de Origem: documents.parquet', '',
            repeat('=', 80), 'RESUMO GERAL', repeat('=', 80),
            'Total de Registros: ' || format('{{:,}}', n), 'Total de Colunas: 4', '',
            repeat('=', 80), 'QUALIDADE DOS DADOS', repeat('=', 80),
            'Registros Completos: ' || format('{{:,}}', c) || ' (' || format('{{:.2f}}', 100.0::DOUBLE * c / n) || '%)',
            'Com Descritores: ' || format('{{:,}}', x),
            'Publicados na Internet: ' || format('{{:,}}', CAST(p AS BIGINT)), '',
            repeat('=', 80), 'DISTRIBUIÇÃO POR QUALIDADE', repeat('=', 80), '',
            repeat('=', 80), 'DETALHAMENTO POR COLUNA', repeat('=', 80),
            '', repeat('=', 80), 'Arquivo Processado: structured', repeat('=', 80)]) AS line FROM s
          UNION ALL
          SELECT 'Qualidade ' || quality || ': ' || format('{{:,}}', count(*)) || ' ('
                 || format('{{:.2f}}', 100.0::DOUBLE * count(*) / any_value(n)) || '%)'
          FROM d, s WHERE quality IS NOT NULL GROUP BY quality
          UNION ALL
          SELECT unnest(['', 'Coluna: ' || col, '  Tipo: ' || kind,
            '  Não Nulos: ' || format('{{:,}}', k) || ' (' || format('{{:.2f}}', 100 - 100.0::DOUBLE * (n - k) / n) || '%)',
            '  Nulos: ' || format('{{:,}}', n - k) || ' (' || format('{{:.2f}}', 100.0::DOUBLE * (n - k) / n) || '%)'] || extra)
          FROM (
            SELECT 'doc_id' AS col, 'Int64' AS kind, count(doc_id) AS k, count(*) AS n,
              ['  Min: ' || format('{{:.1f}}', min(doc_id)::DOUBLE) || ', Max: ' || format('{{:.1f}}', max(doc_id)::DOUBLE)
               || ', Média: ' || format('{{:.2f}}', avg(doc_id))] AS extra FROM d UNION ALL
            SELECT 'n_chars', 'Int64', count(n_chars), count(*),
              ['  Min: ' || format('{{:.1f}}', min(n_chars)::DOUBLE) || ', Max: ' || format('{{:.1f}}', max(n_chars)::DOUBLE)
               || ', Média: ' || format('{{:.2f}}', avg(n_chars))] FROM d UNION ALL
            SELECT 'quality', 'Int64', count(quality), count(*),
              ['  Min: ' || format('{{:.1f}}', min(quality)::DOUBLE) || ', Max: ' || format('{{:.1f}}', max(quality)::DOUBLE)
               || ', Média: ' || format('{{:.2f}}', avg(quality))] FROM d UNION ALL
            SELECT 'toxic', 'bool', count(toxic), count(*),
              ['  True: ' || format('{{:,}}', count(*) FILTER (toxic)) || ', False: '
               || format('{{:,}}', count(*) FILTER (NOT toxic))] FROM d))""",
)
def report_lines_query(t):
    """The lines of the report on documents; reading order is fixed by ``in_print_order``."""
    # The report reads its rows several times; they are stored once, as in a structuring run.
    path = scratch_path(t.spark, "report")
    docs(t, "n_chars").withColumn("toxic", F.col("toxic") == 1).write.parquet(path)
    rows = t.spark.read.parquet(path)
    totals = quality_totals(rows, F.col("quality").isNotNull(), F.col("toxic"), F.col("quality"))
    return report_lines(
        "DOCUMENTS", "documents.parquet", "structured", ASOF, len(rows.columns), totals, profile(rows),
        {("DISTRIBUIÇÃO POR QUALIDADE", "Qualidade"): distribution(rows, "quality")},
    ).select("line")
