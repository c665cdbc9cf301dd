"""The operators bound to the given tables, with reference SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm.html_text import page_texts
from recordflow.llm.jaccard import jaccard_components
from recordflow.llm.licenses import scan_licences
from recordflow.llm.merkle import lowered_third, manifest, manifest_report
from recordflow.llm.neighbours import nearest
from recordflow.llm.packing import pack_documents
from recordflow.llm.pii import personal_spans, span_report
from recordflow.llm.prefix_bpe import encoding_digests
from recordflow.llm.quality import line_quality
from recordflow.llm.reference_sql import ALIASES, CONTAMINATION, JACCARD, LINK, MANIFEST, NEAREST, REDIRECTS, RESAMPLING, URLS
from recordflow.llm.resampling import resample
from recordflow.llm.substring import repeated_spans
from recordflow.llm.urls import Rule, filter_urls
from recordflow.llm.winnowing import contamination, contamination_report

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bind(name: str, sql: str | None = None):
    def register(query: Query) -> Query:
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return query

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@bind("op1_ngram_jaccard_join", JACCARD)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents"), size=3, percent=90)


@bind("op2_url_filters", URLS)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(_table(spark, folder, "pages"), RULES)


@bind("url_aliases", ALIASES)
def url_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """The same over canonical links and redirects derived from the pages, many to targets without a page of their own."""
    pages = _table(spark, folder, "pages")
    pages.createOrReplaceTempView("linked_pages")
    link = F.concat(F.lit('<head><link rel="canonical" href="'), F.expr(LINK.replace("VARCHAR(20)", "STRING")), F.lit('"></head>'))
    redirects = spark.sql(REDIRECTS.replace("VARCHAR(20)", "STRING").replace("FROM pages", "FROM linked_pages"))
    return filter_urls(pages.withColumn("html", link), RULES, redirects)


@bind("op3_pii")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return span_report(personal_spans(_table(spark, folder, "documents")))


@bind("op4_quality_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality(_table(spark, folder, "documents"))


@bind("op5_substring_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans(_table(spark, folder, "documents"))


@bind("op6_license_scans")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return scan_licences(docs.select(document_path().alias("path"), "text"))


def document_path():
    """A path for each document, as the table has none: source, language and a block of ids are its directories.

    Every tenth document stands for a licence file of a block, every hundredth
    for one of a language's directory.
    """
    number = F.col("doc_id")
    block = F.floor(number / 100).cast("string")
    return (
        F.when(number % 100 == 0, F.concat_ws("/", "source", "lang", F.concat(F.lit("LICENSE-"), number.cast("string"))))
        .when(number % 10 == 0, F.concat_ws("/", "source", "lang", block, F.concat(F.lit("LICENSE-"), number.cast("string"))))
        .otherwise(F.concat_ws("/", "source", "lang", block, F.concat(number.cast("string"), F.lit(".txt"))))
    )


@bind("op7_nearest_neighbours", NEAREST)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(_table(spark, folder, "embeddings"), k=20, query_every=20)


@bind("op8_packing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_table(spark, folder, "documents"), WORD_BPE, window=4096)


@bind("op9_sentencepiece")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_digests(_table(spark, folder, "documents"), PIECE_BPE)


@bind("op10_html_extraction")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return page_texts(_table(spark, folder, "pages"))


@bind("op11_importance_resampling", RESAMPLING)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")).drop("n_words")


@bind("op12_decontamination", CONTAMINATION)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return contamination_report(contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")))


@bind("op13_merkle_manifest", MANIFEST)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return manifest_report(manifest(_table(spark, folder, "documents"), lowered_third))
