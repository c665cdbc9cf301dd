"""The whole structuring run on a record file derived from orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from recordflow.bindings.archive_tables import archive_tables
from recordflow.bindings.registry import bind
from recordflow.plans.structuring import PRINCIPAL, RECORD_TABLE, run_structuring
from recordflow.session import scratch_path
from recordflow.sinks.delimited import write_records_csv

ASOF = datetime(2000, 1, 1)

# The first version of every record, as written below.
RECORDS = """WITH r AS (
    SELECT o_orderkey AS id_arquivo_acervo,
           CASE o_orderstatus WHEN 'F' THEN true ELSE false END AS ic_principal,
           2019110000000 + o_orderkey AS co_protocolo_acervo,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS id_arquivo_acervo_pai,
           CASE WHEN o_orderpriority = '5-LOW' THEN o_orderdate END AS dt_emissao_etiqueta,
           CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id_categoria,
           CASE o_orderpriority WHEN '1-URGENT' THEN 2::BIGINT WHEN '3-MEDIUM' THEN NULL ELSE 1::BIGINT END AS id_situacao,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS id_descritor_informacional,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS id_descritor_catalografico,
           CASE WHEN o_orderpriority <> '2-HIGH' THEN o_custkey END AS id_descritor_tecnico,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey + 700 END AS id_descritoes_informacionais_iconografico,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS id_descritor_catalografico_iconografico,
           CASE WHEN o_totalprice > 300000 THEN 1::BIGINT WHEN o_totalprice > 200000 THEN 0::BIGINT
                WHEN o_totalprice > 100000 THEN 1::BIGINT END AS ic_publicado_internet
    FROM orders)
"""


def run(t):
    """Every record once, then once more with another category; flags of pending records are invalid."""
    records = archive_tables(t, RECORD_TABLE)[RECORD_TABLE]
    flag = F.when(F.col(PRINCIPAL).isNull(), F.lit("maybe")).otherwise(F.initcap(F.col(PRINCIPAL).cast("string")))
    records = records.withColumn(PRINCIPAL, flag)
    source = scratch_path(t.spark, "records")
    write_records_csv(records.unionAll(records.withColumn("id_categoria", F.lit(99).cast("long"))), source)
    return run_structuring(t.spark, source, scratch_path(t.spark, "structured"), ASOF)


@bind(
    "structure_records",
    RECORDS + """SELECT *,
        id_situacao IS NOT NULL AS ic_registro_completo,
        coalesce(id_descritor_informacional, id_descritor_catalografico, id_descritor_tecnico) IS NOT NULL
          AS ic_tem_descritores,
        id_descritoes_informacionais_iconografico IS NOT NULL AS ic_tem_iconografico,
        id_arquivo_acervo_pai IS NOT NULL AS ic_tem_arquivo_pai,
        year(dt_emissao_etiqueta) AS nu_ano_emissao_etiqueta FROM r""",
)
def structure_records(t):
    """File to structured rows: read, keep the first version, repair, type, derive."""
    return t.spark.read.parquet(run(t).path)


@bind(
    "structure_checks",
    RECORDS + """SELECT count(*) AS "rows", 0::BIGINT AS negative_id_arquivo_acervo, 0::BIGINT AS negative_co_protocolo_acervo,
        0::BIGINT AS negative_id_categoria, 0::BIGINT AS negative_id_situacao,
        (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS invalid_ic_principal,
        count(*) FILTER (dt_emissao_etiqueta > TIMESTAMP '2000-01-01') AS future_dt_emissao_etiqueta,
        count(*) AS duplicates FROM r""",
)
def structure_checks(t):
    """The warning counts of the same run."""
    return run(t).checks


@bind(
    "run_observed",
    RECORDS + """SELECT count(*) AS "rows", 18 AS "columns", count(*) AS total,
        count(*) FILTER (id_situacao IS NOT NULL) AS complete,
        coalesce(count(*) FILTER (id_situacao IS NOT NULL) * 100.0::DOUBLE / nullif(count(*), 0), 0) AS pct_complete,
        count(*) FILTER (coalesce(id_descritor_informacional, id_descritor_catalografico, id_descritor_tecnico) IS NOT NULL) AS described,
        CAST(coalesce(sum(ic_publicado_internet), 0) AS BIGINT) AS published, count(*) AS duplicates, true AS sized, true AS timed FROM r""",
)
def run_observed(t):
    """What a run counts while it writes: rows, quality totals and copies left out; the size is that of its files."""
    result = run(t)
    listed = t.spark.read.format("binaryFile").load(result.path).agg(F.round(F.sum("length") / 1048576, 2)).scalar()
    metrics = result.metrics.select("rows", "columns", (F.col("size_mb") == listed).alias("sized"), (F.col("duration_seconds") > 0).alias("timed"))
    return metrics.crossJoin(result.totals).crossJoin(result.checks.select("duplicates"))
