"""Scalar expressions on documents with labels, orders, parts and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.bindings.registry import bind
from recordflow.functions.coerce import coerce_int, coerce_timestamp, is_fractional
from recordflow.functions.derive import all_present, any_present, has_parent, label_year
from recordflow.functions.flags import bool_default_false, flag_bool, flag_text, repaired_flag
from recordflow.functions.text import (
    as_text, first_non_blank, first_non_null_text, protocol_text, strip_control_chars,
)
from recordflow.functions.urls import attachment_url, build_url
from recordflow.operators.joins import left_join_rows
from recordflow.operators.outcomes import outcome_class

DOC = "documents LEFT JOIN labels USING (doc_id)"
FLAG_CASE = "CASE CAST({0} AS VARCHAR) WHEN '1' THEN 'Sim' WHEN '0' THEN 'Não' ELSE '' END"


def docs(t, *columns: str):
    """Documents with their labels; unlabelled documents have NULL flags."""
    return t.documents.select("doc_id", *columns).join(t.labels, "doc_id", "left")


@bind("flag_text", f"SELECT doc_id, {FLAG_CASE.format('quality')} AS quality_text, {FLAG_CASE.format('toxic')} AS toxic_text FROM {DOC}")
def flag_text_query(t):
    return docs(t).select(
        "doc_id", flag_text(F.col("quality")).alias("quality_text"), flag_text(F.col("toxic")).alias("toxic_text")
    )


SPELLED = "CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'FALSE' WHEN 'P' THEN o_orderpriority END"


@bind(
    "flag_text_ci",
    f"""SELECT o_orderkey, CASE WHEN lower({SPELLED}) IN ('1', 'true') THEN 'Sim'
               WHEN lower({SPELLED}) IN ('0', 'false') THEN 'Não' ELSE '' END AS flag,
             CASE WHEN lower({SPELLED}) = 'true' THEN true WHEN lower({SPELLED}) = 'false' THEN false END AS typed
        FROM orders""",
)
def flag_text_ci(t):
    spelled = F.expr(SPELLED)
    return t.orders.select(
        "o_orderkey", flag_text(spelled, ignore_case=True).alias("flag"), flag_bool(spelled).alias("typed")
    )


@bind(
    "cast_text",
    f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality, CAST(n_chars AS VARCHAR) AS n_chars FROM {DOC}",
)
def cast_text(t):
    return docs(t, "n_chars").select(*[as_text(F.col(c)).alias(c) for c in ("doc_id", "quality", "n_chars")])


@bind(
    "null_to_empty",
    """SELECT o_orderkey, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), '') AS priority,
              coalesce(l_returnflag, '') AS flag
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def null_to_empty(t):
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    lines = left_join_rows(orders, t.lineitem.select("l_orderkey", "l_returnflag"), "o_orderkey", "l_orderkey")
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return lines.select("o_orderkey", as_text(priority).alias("priority"), as_text(F.col("l_returnflag")).alias("flag"))


FIRST = "CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN '' ELSE o_orderpriority END"
SECOND = "CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN '' ELSE o_orderstatus END"


@bind(
    "first_non_blank",
    f"""SELECT o_orderkey, CASE WHEN {FIRST} <> '' THEN {FIRST} WHEN {SECOND} <> '' THEN {SECOND} ELSE '' END AS merged,
               CASE WHEN {SECOND} <> '' THEN {SECOND} WHEN {FIRST} <> '' THEN {FIRST} ELSE '' END AS inverse
        FROM orders""",
)
def first_non_blank_query(t):
    first, second = F.expr(FIRST), F.expr(SECOND)
    return t.orders.select(
        "o_orderkey", first_non_blank(first, second).alias("merged"), first_non_blank(second, first).alias("inverse")
    )


@bind(
    "first_non_null_num",
    f"""SELECT doc_id, CASE WHEN quality = 1 THEN CAST(n_chars AS VARCHAR) WHEN toxic IS NOT NULL
               THEN CAST(toxic AS VARCHAR) ELSE '' END AS code FROM {DOC}""",
)
def first_non_null_num(t):
    rows = docs(t, "n_chars")
    size = F.when(F.col("quality") == 1, F.col("n_chars"))
    return rows.select("doc_id", first_non_null_text(size, F.col("toxic")).alias("code"))


@bind("const_col", "SELECT doc_id, '' AS special_document FROM documents")
def const_col(t):
    return t.documents.select("doc_id", F.lit("").alias("special_document"))


@bind(
    "attachment_url",
    """SELECT o_orderkey, 'https://files.example.org/' || nullif(o_orderpriority, '4-NOT SPECIFIED') AS by_name,
              'https://files.example.org/' || CAST(o_custkey AS VARCHAR) AS by_id FROM orders""",
)
def attachment_url_query(t):
    name = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    prefix = "https://files.example.org/"
    return t.orders.select(
        "o_orderkey", attachment_url(prefix, name).alias("by_name"), attachment_url(prefix, F.col("o_custkey")).alias("by_id")
    )


@bind(
    "build_url",
    """SELECT p_partkey, CASE WHEN n <> '' THEN 'https://files.example.org/' || trim(b, '/') || '/' || trim(n, '/') END AS url
       FROM (SELECT p_partkey, '/' || p_brand || '//' AS b, CASE WHEN p_size > 40 THEN '' WHEN p_size > 30 THEN NULL
                    WHEN p_size > 20 THEN '/' || p_name ELSE p_name || '/' END AS n FROM part)""",
)
def build_url_query(t):
    name = F.when(F.col("p_size") > 40, F.lit("")).when(F.col("p_size") > 30, F.lit(None).cast("string")).when(
        F.col("p_size") > 20, F.concat(F.lit("/"), "p_name")
    ).otherwise(F.concat("p_name", F.lit("/")))
    bucket = F.concat(F.lit("/"), "p_brand", F.lit("//"))
    return t.part.select("p_partkey", build_url("https://files.example.org", bucket, name).alias("url"))


NUMBER_TEXT = """CASE event_type
    WHEN 'error' THEN CAST(event_id AS VARCHAR(20)) || '.0' WHEN 'click' THEN '  ' || CAST(user_id AS VARCHAR(20)) || ' '
    WHEN 'view' THEN CAST(user_id AS VARCHAR(20)) || '.5' WHEN 'signup' THEN event_type
    ELSE CAST(event_id AS VARCHAR(20)) END"""


@bind(
    "coerce_int",
    """SELECT event_id, CASE event_type WHEN 'error' THEN event_id WHEN 'click' THEN user_id
                             WHEN 'purchase' THEN event_id END AS number,
              event_type = 'view' AS fractional,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def coerce_int_query(t):
    text = F.expr(NUMBER_TEXT)
    return t.events.select(
        "event_id", coerce_int(text).alias("number"), is_fractional(text).alias("fractional"),
        coerce_int(F.get_json_object("props", "$.k")).alias("k"),
    )


@bind("coerce_int_large", "SELECT o_orderkey, o_orderkey + CAST(9007199254740993 AS BIGINT) AS number FROM orders")
def coerce_int_large(t):
    """Ids beyond the whole numbers of a double, written as decimals."""
    text = F.concat((F.col("o_orderkey") + F.lit(9007199254740993)).cast("string"), F.lit(".0"))
    return t.orders.select("o_orderkey", coerce_int(text).alias("number"))


STAMP_TEXT = """CASE o_orderstatus WHEN 'F' THEN substr(CAST(o_orderdate AS VARCHAR(40)), 1, 10)
    WHEN 'O' THEN CAST(o_orderdate AS VARCHAR(40)) ELSE {0} END"""
BAD_STAMPS = "CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN '2021-02-30' ELSE o_orderpriority END"


@bind(
    "coerce_timestamp",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS stamp FROM orders",
)
def coerce_timestamp_query(t):
    return t.orders.select("o_orderkey", coerce_timestamp(F.expr(STAMP_TEXT.format(BAD_STAMPS))).alias("stamp"))


@bind(
    "protocol_text",
    """SELECT event_id, CASE event_type
         WHEN 'error' THEN '''' || CAST(2019110000000 + event_id AS VARCHAR)
         WHEN 'click' THEN '''' || CAST(user_id AS VARCHAR) WHEN 'view' THEN 'AB-' || CAST(user_id AS VARCHAR)
         WHEN 'signup' THEN '''-' || CAST(1 + user_id AS VARCHAR) END AS protocol FROM events""",
)
def protocol_text_query(t):
    text = F.expr(
        """CASE event_type WHEN 'error' THEN CAST(2019110000000 + event_id AS STRING) || '.0'
             WHEN 'click' THEN CAST(user_id AS STRING) || '.9' WHEN 'view' THEN 'AB-' || CAST(user_id AS STRING)
             WHEN 'signup' THEN '-' || CAST(1 + user_id AS STRING) || '.9' ELSE '' END"""
    )
    return t.events.select("event_id", protocol_text(text).alias("protocol"))


@bind(
    "strip_control",
    r"""SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS clean FROM documents""",
)
def strip_control(t):
    """Control characters around every line break and at both ends are removed, the break stays."""
    dirty = F.concat(F.lit("\x01"), F.regexp_replace("text", "\n", "\x0b\n\x1f"), F.lit("\x0c"))
    return t.documents.select("doc_id", strip_control_chars(dirty).alias("clean"))


@bind("bool_default_false", f"SELECT doc_id, coalesce(quality = 1, false) AS good FROM {DOC}")
def bool_default_false_query(t):
    return docs(t).select("doc_id", bool_default_false(F.col("quality") == 1).alias("good"))


@bind(
    "dq_bool_repair",
    f"""SELECT o_orderkey, CASE WHEN {SPELLED} IS NULL THEN NULL ELSE lower({SPELLED}) = 'true' END AS repaired FROM orders""",
)
def dq_bool_repair(t):
    return t.orders.select("o_orderkey", repaired_flag(F.expr(SPELLED)).alias("repaired"))


@bind(
    "flag_complete",
    f"SELECT doc_id, quality IS NOT NULL AND toxic IS NOT NULL AND nullif(lang, 'de') IS NOT NULL AS complete FROM {DOC}",
)
def flag_complete(t):
    lang = F.nullif(F.col("lang"), F.lit("de"))
    return docs(t, "lang").select("doc_id", all_present(F.col("quality"), F.col("toxic"), lang).alias("complete"))


@bind(
    "flag_any_descriptor",
    f"""SELECT doc_id, quality IS NOT NULL OR nullif(lang, 'en') IS NOT NULL OR nullif(source, 'src0') IS NOT NULL AS described
        FROM {DOC}""",
)
def flag_any_descriptor(t):
    lang, source = F.nullif(F.col("lang"), F.lit("en")), F.nullif(F.col("source"), F.lit("src0"))
    return docs(t, "lang", "source").select("doc_id", any_present(F.col("quality"), lang, source).alias("described"))


@bind(
    "flag_iconographic",
    f"SELECT doc_id, nullif(quality, 0) IS NOT NULL OR nullif(toxic, 0) IS NOT NULL AS iconographic FROM {DOC}",
)
def flag_iconographic(t):
    quality, toxic = F.nullif(F.col("quality"), F.lit(0)), F.nullif(F.col("toxic"), F.lit(0))
    return docs(t).select("doc_id", any_present(quality, toxic).alias("iconographic"))


@bind("flag_has_parent", f"SELECT o_orderkey, coalesce({FIRST}, '') <> '' AS has_parent FROM orders")
def flag_has_parent(t):
    return t.orders.select("o_orderkey", has_parent(F.expr(FIRST)).alias("has_parent"))


@bind(
    "label_year",
    "SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END AS BIGINT) AS label_year FROM orders",
)
def label_year_query(t):
    stamp = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return t.orders.select("o_orderkey", label_year(stamp).alias("label_year"))


STATUS = "CASE l_returnflag WHEN 'A' THEN 200 WHEN 'N' THEN 404 ELSE CASE l_linestatus WHEN 'F' THEN 500 ELSE 302 END END"


@bind(
    "outcome_class",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE {STATUS} WHEN 200 THEN 'ok' WHEN 401 THEN 'unauthorized'
          WHEN 404 THEN 'not_found' WHEN 500 THEN 'server_error' ELSE 'other' END AS outcome FROM lineitem""",
)
def outcome_class_query(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", outcome_class(F.expr(STATUS)).alias("outcome"))
