"""Joins, sets and the wide extract on orders, customers, lines and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.bindings.archive_sql import archive_sql, flat_sql, member_sql
from recordflow.bindings.archive_tables import ARCHIVE_CTES, archive_tables
from recordflow.bindings.registry import bind
from recordflow.functions.text import as_text
from recordflow.operators.filters import exclude_value, published_only
from recordflow.operators.joins import (
    association_partners, association_sets, bridge_sets, child_sets, left_join_rows, lookup_join,
)
from recordflow.operators.sets import chunked_sets, distinct_join, distinct_members, joined_below
from recordflow.plans.archive import archive_spec, extract_archive, flat_spec
from recordflow.plans.layout import write_layout
from recordflow.plans.structuring import structure_extract
from recordflow.plans.wide import (
    Bridge, Children, Descriptor, Lookup, WideSpec, const, denormalize, flag, flat_extract, member_rows, members, merge, raw,
    text,
)
from recordflow.session import scratch_path

def line_sets():
    return {"flags": F.col("l_returnflag"), "years": F.year("l_shipdate")}


@bind(
    "join_lookup",
    """SELECT o_orderkey, o_custkey, c_name, c_mktsegment
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def join_lookup(t):
    customer = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return lookup_join(t.orders.select("o_orderkey", "o_custkey"), customer, "o_custkey", "c_custkey").drop("c_custkey")


@bind(
    "join_chained_lookup",
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders
       LEFT JOIN customer ON c_custkey = o_custkey
       LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def join_chained_lookup(t):
    nation = lookup_join(t.nation, t.region, "n_regionkey", "r_regionkey")
    customer = lookup_join(t.customer, nation, "c_nationkey", "n_nationkey")
    return lookup_join(t.orders, customer, "o_custkey", "c_custkey").select("o_orderkey", "c_name", "n_name", "r_name")


@bind(
    "join_child_agg",
    """SELECT o_orderkey, coalesce(flags, '') AS flags, coalesce(years, '') AS years
       FROM orders LEFT JOIN (
         SELECT l_orderkey, string_agg(DISTINCT l_returnflag, '||' ORDER BY l_returnflag) AS flags,
                string_agg(DISTINCT CAST(year(l_shipdate) AS VARCHAR), '||'
                           ORDER BY CAST(year(l_shipdate) AS VARCHAR)) AS years
         FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
)
def join_child_agg(t):
    joined = child_sets(t.orders.select("o_orderkey"), t.lineitem, "o_orderkey", "l_orderkey", line_sets())
    return joined.select(
        "o_orderkey", *[F.coalesce(F.array_join(c, "||"), F.lit("")).alias(c) for c in line_sets()]
    )


@bind(
    "join_bridge_agg",
    """SELECT o_orderkey, coalesce(names, '') AS names FROM orders LEFT JOIN (
         SELECT l_orderkey, string_agg(DISTINCT p_name, '||' ORDER BY p_name) AS names
         FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
)
def join_bridge_agg(t):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    joined = bridge_sets(
        t.orders.select("o_orderkey"), t.lineitem, part, "o_orderkey", "l_orderkey", "l_partkey",
        {"names": F.col("p_name")},
    )
    return joined.select("o_orderkey", F.coalesce(F.array_join("names", "||"), F.lit("")).alias("names"))


def pairs(t):
    """Associated records: the line's order and the order numbered like its part."""
    return t.lineitem.select(F.col("l_orderkey").alias("first"), F.col("l_partkey").alias("second"))


@bind(
    "join_association",
    """SELECT o_orderkey,
         CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS first,
         CASE WHEN o_orderkey IN (SELECT l_partkey FROM lineitem) THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS second
       FROM orders""",
)
def join_association(t):
    joined = association_sets(t.orders.select("o_orderkey"), pairs(t), "o_orderkey", "first", "second")
    return joined.select("o_orderkey", *[F.coalesce(F.array_join(c, "||"), F.lit("")).alias(c) for c in ("first", "second")])


@bind(
    "join_association_partner",
    """SELECT o_orderkey, coalesce(a.ids, '') AS to_second, coalesce(b.ids, '') AS to_first FROM orders
       LEFT JOIN (SELECT l_orderkey AS k, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), '||'
                         ORDER BY CAST(l_partkey AS VARCHAR)) AS ids FROM lineitem GROUP BY 1) a ON a.k = o_orderkey
       LEFT JOIN (SELECT l_partkey AS k, string_agg(DISTINCT CAST(l_orderkey AS VARCHAR), '||'
                         ORDER BY CAST(l_orderkey AS VARCHAR)) AS ids FROM lineitem GROUP BY 1) b ON b.k = o_orderkey""",
)
def join_association_partner(t):
    names = ("to_second", "to_first")
    joined = association_partners(t.orders.select("o_orderkey"), pairs(t), "o_orderkey", "first", "second", names)
    return joined.select("o_orderkey", *[F.coalesce(F.array_join(c, "||"), F.lit("")).alias(c) for c in names])


@bind(
    "distinct_join",
    """SELECT l_orderkey, coalesce(string_agg(DISTINCT p, '||' ORDER BY p), '') AS parts
       FROM (SELECT l_orderkey, nullif(l_returnflag, 'N') AS p FROM lineitem) GROUP BY l_orderkey""",
)
def distinct_join_one(t):
    return distinct_join(t.lineitem, "l_orderkey", {"parts": F.nullif(F.col("l_returnflag"), F.lit("N"))})


@bind(
    "distinct_join_multi",
    """SELECT l_orderkey,
         coalesce(string_agg(DISTINCT p_name, '||' ORDER BY p_name), '') AS names,
         coalesce(string_agg(DISTINCT l_returnflag, '||' ORDER BY l_returnflag), '') AS flags,
         coalesce(string_agg(DISTINCT CAST(year(l_shipdate) AS VARCHAR), '||'
                             ORDER BY CAST(year(l_shipdate) AS VARCHAR)), '') AS years
       FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""",
)
def distinct_join_multi(t):
    lines = lookup_join(t.lineitem, t.part.select("p_partkey", "p_name"), "l_partkey", "p_partkey")
    return distinct_join(lines, "l_orderkey", {"names": F.col("p_name"), **line_sets()})


@bind(
    "distinct_members",
    """SELECT DISTINCT l_orderkey, field, value FROM (
         SELECT l_orderkey, 'flags' AS field, l_returnflag AS value FROM lineitem UNION ALL
         SELECT l_orderkey, 'years', CAST(year(l_shipdate) AS VARCHAR) FROM lineitem)""",
)
def members_long(t):
    return distinct_members(t.lineitem, "l_orderkey", line_sets())


@bind(
    "sets_in_chunks",
    """SELECT source, field, count(*) AS n, CASE WHEN count(*) <= 60 THEN string_agg(value, '||' ORDER BY value) END AS text FROM (
         SELECT DISTINCT source, 'documents' AS field, CAST(doc_id AS VARCHAR) AS value FROM documents UNION
         SELECT DISTINCT source, 'languages', lang FROM documents)
       GROUP BY source, field""",
)
def sets_in_chunks(t):
    """Few keys with many members, one of them with a third of all: numbered cells, joined to text only below a bound."""
    values = {"documents": F.col("doc_id"), "languages": F.col("lang")}
    return joined_below(chunked_sets(t.documents, "source", values, cell=500), "source", most=60)


@bind(
    "group_wide_keys",
    """SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, c_mktsegment,
              l_returnflag, l_linestatus, coalesce(string_agg(DISTINCT p_name, '||' ORDER BY p_name), '') AS names
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
       LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4, 5, 6""",
)
def group_wide_keys(t):
    """Grouping on many raw keys, NULL being a group of its own, with a set per group."""
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", priority)
    wide = lookup_join(orders, t.customer.select("c_custkey", "c_mktsegment"), "o_custkey", "c_custkey")
    lines = lookup_join(
        t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"),
        t.part.select("p_partkey", "p_name"), "l_partkey", "p_partkey",
    )
    wide = left_join_rows(wide, lines, "o_orderkey", "l_orderkey")
    keys = ["o_orderkey", "o_orderstatus", "priority", "c_mktsegment", "l_returnflag", "l_linestatus"]
    grouped = distinct_join(wide.select(F.struct(*keys).alias("g"), "p_name"), "g", {"names": F.col("p_name")})
    return grouped.select("g.*", "names")


@bind(
    "group_by_child_key",
    """SELECT o_orderkey, coalesce(l_returnflag, '') AS flag,
              coalesce(string_agg(DISTINCT p_name, '||' ORDER BY p_name), '') AS names
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
       GROUP BY o_orderkey, l_returnflag""",
)
def group_by_child_key(t):
    """One row per record and child value instead of a set."""
    lines = lookup_join(
        t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag"), t.part.select("p_partkey", "p_name"),
        "l_partkey", "p_partkey",
    )
    rows = left_join_rows(t.orders.select("o_orderkey"), lines, "o_orderkey", "l_orderkey")
    grouped = distinct_join(
        rows.select(F.struct("o_orderkey", "l_returnflag").alias("g"), "p_name"), "g", {"names": F.col("p_name")}
    )
    return grouped.select("g.o_orderkey", as_text(F.col("g.l_returnflag")).alias("flag"), "names")


@bind(
    "filter_published",
    "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE CAST(quality AS VARCHAR) IN ('1', 'true')",
)
def filter_published(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return published_only(joined, "quality").select("doc_id", "quality")


@bind(
    "filter_status_keep_null",
    "SELECT doc_id, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL OR toxic <> 1",
)
def filter_status_keep_null(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return exclude_value(joined, "toxic", 1).select("doc_id", "toxic")


def orders_spec():
    """Orders as records, customers as descriptors, lines as children, parts over the bridge."""
    return WideSpec(
        "o", "orders", "o_orderkey",
        links=(
            Descriptor("c", "customer", "o", "o_custkey", "c_custkey", unique=True),
            Lookup("n", "nation", "c", "c_nationkey", "n_nationkey", unique=True),
            Lookup("r", "region", "n", "n_regionkey", "r_regionkey", unique=True),
            Children("l", "lineitem", "o", "o_orderkey", "l_orderkey"),
            Bridge("p", "links", "o", "o_orderkey", "l_orderkey", target="part", target_key="p_partkey"),
        ),
        fields=(
            text("o_orderkey", "o.o_orderkey"),
            raw("o_custkey", "o.o_custkey"),
            flag("is_final", "o.is_final"),
            text("c_name", "c.c_name"),
            text("n_name", "n.n_name"),
            text("r_name", "r.r_name"),
            merge("priority_or_segment", "o.priority", "c.c_mktsegment"),
            members("flags", "l.l_returnflag"),
            members("attachments", "l.l_partkey", "files/"),
            members("part_names", "p.p_name"),
            const("reserved"),
        ),
        where=lambda df: exclude_value(df, "o_orderstatus", "O"),
        unique_key=True,
    )


def orders_tables(t):
    final = F.when(F.col("o_orderstatus") == "F", F.lit(1)).when(F.col("o_orderstatus") == "O", F.lit(0))
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return {
        "orders": t.orders.withColumns({"is_final": final, "priority": priority}),
        "customer": t.customer,
        "nation": t.nation,
        "region": t.region,
        "lineitem": t.lineitem,
        "links": t.lineitem.select("l_orderkey", F.col("l_partkey").alias("p_partkey")),
        "part": t.part,
    }


@bind(
    "denormalize",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey,
         CASE o_orderstatus WHEN 'F' THEN 'Sim' WHEN 'O' THEN 'Não' ELSE '' END AS is_final,
         coalesce(c_name, '') AS c_name, coalesce(n_name, '') AS n_name, coalesce(r_name, '') AS r_name,
         coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), c_mktsegment, '') AS priority_or_segment,
         coalesce(string_agg(DISTINCT l_returnflag, '||' ORDER BY l_returnflag), '') AS flags,
         coalesce(string_agg(DISTINCT 'files/' || CAST(l_partkey AS VARCHAR), '||'
                             ORDER BY 'files/' || CAST(l_partkey AS VARCHAR)), '') AS attachments,
         coalesce(string_agg(DISTINCT p_name, '||' ORDER BY p_name), '') AS part_names, '' AS reserved
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
       LEFT JOIN part ON p_partkey = l_partkey
       WHERE o_orderstatus IS NULL OR o_orderstatus <> 'O'
       GROUP BY orders.o_orderkey, o_custkey, o_orderstatus, o_orderpriority, c_name, n_name, r_name, c_mktsegment
       ORDER BY orders.o_orderkey""",
)
def denormalize_orders(t):
    return wide_orders(t).orderBy(order_of_orders())


def wide_orders(t):
    return denormalize(orders_tables(t), orders_spec())


def order_of_orders():
    return F.col("o_orderkey").cast("long")


@bind(
    "extract_flat",
    """SELECT o_orderkey, o_custkey, c_name, n_name, r_name, l_returnflag AS line_flag
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def extract_flat(t):
    """Raw rows, one per record and line."""
    spec = orders_spec()
    fields = (
        raw("o_orderkey", "o.o_orderkey"), raw("o_custkey", "o.o_custkey"), raw("c_name", "c.c_name"),
        raw("n_name", "n.n_name"), raw("r_name", "r.r_name"), members("line_flag", "l.l_returnflag"),
    )
    flat = WideSpec(spec.alias, spec.table, spec.key, spec.links, fields, unique_key=True)
    return flat_extract(orders_tables(t), flat, expand="l")


ARCHIVE_URL = "https://files.example.org/archive/"


@bind("extract_archive", ARCHIVE_CTES + archive_sql(ARCHIVE_URL))
def extract_archive_full(t):
    """All 26 joins, 72 public and 7 internal columns, on an archive derived from the tables."""
    return extract_archive(archive_tables(t), ARCHIVE_URL, unique_key=True)


@bind("extract_archive_stored", ARCHIVE_CTES + archive_sql(ARCHIVE_URL))
def extract_archive_stored(t):
    """The same rows from tables stored by their link keys: child sets are made where the rows lie."""
    spec = archive_spec(ARCHIVE_URL, unique_key=True)
    layout = write_layout(archive_tables(t), spec, scratch_path(t.spark, "layout"), buckets=8)
    return denormalize(layout.tables, layout.spec)


@bind("extract_archive_members", ARCHIVE_CTES + member_sql(ARCHIVE_URL))
def extract_archive_members(t):
    """The multi-valued fields of the archive as rows."""
    return member_rows(archive_tables(t), archive_spec(ARCHIVE_URL, unique_key=True))


@bind("extract_archive_ids", ARCHIVE_CTES + archive_sql("", ids=True))
def extract_archive_ids(t):
    """An earlier form: attachments by id, no file names."""
    return denormalize(archive_tables(t), archive_spec(url_source="tx.id_arquivo_anexo", file_names=False, unique_key=True))


@bind("extract_archive_protocols", ARCHIVE_CTES + archive_sql(ARCHIVE_URL, protocol_rows=True))
def extract_archive_protocols(t):
    """An earlier form: one row per record and protocol, flags in any spelling."""
    return denormalize(archive_tables(t), archive_spec(ARCHIVE_URL, ignore_case=True, protocol_rows=True, unique_key=True))


@bind("extract_archive_flat", ARCHIVE_CTES + flat_sql())
def extract_archive_flat(t):
    """The flat archive rows, attachments expanded, other sets as text."""
    return flat_extract(archive_tables(t), flat_spec(unique_key=True), expand="tx", arrays=False)


@bind("structure_archive", ARCHIVE_CTES + f"""
    SELECT w.* REPLACE (
             TRY_CAST(dt_emissao_etiqueta AS TIMESTAMP) AS dt_emissao_etiqueta,
             '''' || co_protocolo_acervo AS co_protocolo_acervo),
           id_categoria IS NOT NULL AND id_situacao IS NOT NULL AND co_protocolo_acervo <> '' AS ic_registro_completo,
           coalesce(id_descritor_informacional, id_descritor_catalografico, id_descritor_tecnico) IS NOT NULL
             AS ic_tem_descritores,
           coalesce(id_descritoes_informacionais_iconografico, id_descritor_catalografico_iconografico) IS NOT NULL
             AS ic_tem_iconografico,
           id_arquivo_acervo_pai <> '' AS ic_tem_arquivo_pai,
           CAST(year(TRY_CAST(dt_emissao_etiqueta AS TIMESTAMP)) AS BIGINT) AS nu_ano_emissao_etiqueta
    FROM ({archive_sql(ARCHIVE_URL)}) w""")
def structure_archive(t):
    """The structured extract: 84 columns."""
    return structure_extract(extract_archive(archive_tables(t), ARCHIVE_URL, ordered=False, unique_key=True))

