"""Search, manifests, URLs, sorting and paging."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from recordflow.bindings.expressions import STATUS
from recordflow.bindings.extract import order_of_orders, wide_orders
from recordflow.bindings.registry import bind
from recordflow.bindings.runs import runs
from recordflow.functions.multivalue import SEPARATOR, split_values
from recordflow.operators.directory import By, build_page_directory
from recordflow.operators.manifest import attachment_manifest, url_params, url_params_grouped
from recordflow.operators.outcomes import outcome_failures, outcome_summary
from recordflow.operators.paging import number_rows, number_sorted, page, page_after, page_count, sort_nulls_last, top_n
from recordflow.operators.search import (
    LOOKUP_SIZE, SEARCH_SIZE, lookup, search_contains, search_exact, search_exact_or_partial, search_records,
)
from recordflow.operators.search_index import build_search_index
from recordflow.operators.sets import distinct_join
from recordflow.sources.history import history_recent
from recordflow.session import scratch_path
from recordflow.sources.tables import capped

# Orders with the names of their parts in one multi-valued cell.
CELLS = """(SELECT CAST(l_orderkey AS VARCHAR) AS id, string_agg(DISTINCT p_name, '||' ORDER BY p_name) AS names
            FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)"""


def cells(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey"
    )
    sets = distinct_join(lines, "l_orderkey", {"names": F.col("p_name")})
    return sets.select(F.col("l_orderkey").cast("string").alias("id"), "names")


@bind("lookup_exact_id", f"SELECT id, names FROM {CELLS} WHERE id = '77' ORDER BY id LIMIT 10")
def lookup_exact_id(t):
    return lookup(cells(t), "77", "id", "names", size=LOOKUP_SIZE)


@bind(
    "lookup_regex",
    f"SELECT id, names FROM {CELLS} WHERE regexp_matches(names, 'RED.*gear', 'i') OR regexp_matches(id, 'RED.*gear', 'i') ORDER BY id LIMIT 10",
)
def lookup_regex(t):
    return lookup(cells(t), "RED.*gear", "id", "names", size=LOOKUP_SIZE)


@bind("search_exact_element", f"SELECT id, names FROM {CELLS} WHERE id = 'red widget' OR list_contains(string_split(names, '||'), 'red widget')")
def search_exact_element(t):
    return search_exact(cells(t), " Red Widget ", "id", "names")


@bind("search_contains", f"SELECT id, names FROM {CELLS} WHERE contains(names, 'widget') OR contains(id, 'widget')")
def search_contains_query(t):
    return search_contains(cells(t), "WIDGET", "id", "names")


@bind(
    "search_exact_or_partial",
    f"""SELECT * FROM (SELECT 'exact' AS kind, id, names FROM {CELLS} WHERE list_contains(string_split(names, '||'), 'red widget'))
        UNION ALL SELECT * FROM (SELECT 'partial', id, names FROM {CELLS} WHERE contains(names, 'widge') OR contains(id, 'widge')
                                 ORDER BY id LIMIT 2000)""",
)
def search_exact_or_partial_query(t):
    """A term with exact hits and one that only occurs inside names."""
    rows = cells(t)
    exact = search_exact_or_partial(rows, "red widget", "id", "names").select(F.lit("exact").alias("kind"), "id", "names")
    partial = search_exact_or_partial(rows, "widge", "id", "names", size=SEARCH_SIZE).select(F.lit("partial").alias("kind"), "id", "names")
    return exact.unionAll(partial)


@bind("search_partial_all", f"SELECT id, names FROM {CELLS} WHERE contains(names, 'widge') OR contains(id, 'widge')")
def search_partial_all(t):
    """Without a size every partial hit comes back."""
    return search_exact_or_partial(cells(t), "widge", "id", "names")


@bind("lookup_pattern_all", f"SELECT id, names FROM {CELLS} WHERE regexp_matches(names, 'RED.*gear', 'i') OR regexp_matches(id, 'RED.*gear', 'i')")
def lookup_pattern_all(t):
    return lookup(cells(t), "RED.*gear", "id", "names")


_MEMBER = "id = '{0}' OR list_contains(string_split(names, '||'), '{0}')"


@bind(
    "search_index",
    f"""SELECT 'member' AS kind, id, names FROM {CELLS} WHERE {_MEMBER.format("red widget")}
        UNION ALL SELECT 'id', id, names FROM {CELLS} WHERE {_MEMBER.format("77")}
        UNION ALL SELECT 'inside', id, names FROM {CELLS} WHERE contains(names, 'widge') OR contains(id, 'widge')
        UNION ALL SELECT 'short', id, names FROM {CELLS} WHERE contains(names, 'd g') OR contains(id, 'd g')
        UNION ALL SELECT 'several', id, names FROM {CELLS} WHERE contains(names, 'gear||green') OR contains(id, 'gear||green')
        UNION ALL SELECT 'pattern', id, names FROM {CELLS} WHERE regexp_matches(names, 'RED.*gear', 'i') OR regexp_matches(id, 'RED.*gear', 'i')
        UNION ALL SELECT 'number', id, names FROM {CELLS} WHERE id = '77'""",
)
def search_index_query(t):
    """The searches above, each over one stored index of the members and letters of all cells."""
    index = build_search_index(cells(t), scratch_path(t.spark, "search-index"), "id", "names")
    found = {
        "member": index.exact(" Red Widget "), "id": index.exact("77"), "inside": index.contains("WIDGE"),
        "short": index.contains("d g"), "several": index.contains("gear||green"), "pattern": index.lookup("RED.*gear"),
        "number": index.lookup("77"),
    }
    return reduce(DataFrame.unionAll, [df.select(F.lit(kind).alias("kind"), "id", "names") for kind, df in found.items()])


# Addresses cut at their marks, as cells of many members.
PARTS = "(SELECT CAST(page_id AS VARCHAR) AS id, regexp_replace(url, '[/?&#.]+', '||', 'g') AS names FROM pages)"


@bind(
    "search_index_pages",
    f"""SELECT 'member' AS kind, id, names FROM {PARTS} WHERE {_MEMBER.format("es")}
        UNION ALL SELECT 'id', id, names FROM {PARTS} WHERE {_MEMBER.format("41")}
        UNION ALL SELECT 'inside', id, names FROM {PARTS} WHERE contains(lower(names), 'org||fr') OR contains(id, 'org||fr')
        UNION ALL SELECT 'pattern', id, names FROM {PARTS} WHERE regexp_matches(names, 'net.*/*9$', 'i') OR regexp_matches(id, 'net.*/*9$', 'i')""",
)
def search_index_pages(t):
    """The same over the addresses of all pages; some members stand in most of them."""
    parts = t.pages.select(F.col("page_id").cast("string").alias("id"), F.regexp_replace("url", "[/?&#.]+", SEPARATOR).alias("names"))
    index = build_search_index(parts, scratch_path(t.spark, "page-index"), "id", "names")
    found = {"member": index.exact("es"), "id": index.exact("41"), "inside": index.contains("org||fr"), "pattern": index.lookup("net.*/*9$")}
    return reduce(DataFrame.unionAll, [df.select(F.lit(kind).alias("kind"), "id", "names") for kind, df in found.items()])


@bind("lookup_numeric_id", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey = 77")
def lookup_numeric_id(t):
    return lookup(t.orders.select("o_orderkey", "o_orderpriority"), "77", "o_orderkey", "o_orderpriority")


@bind(
    "search_records",
    """SELECT doc_id, lang, source FROM documents
       WHERE contains(lower(text), 'the') AND lang = 'en'""",
)
def search_records_query(t):
    return search_records(t.documents, term="THE", type_column="lang", type_value="en").select("doc_id", "lang", "source")


@bind(
    "search_records_by_date",
    """SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-08-31' AND o_orderstatus = 'F'
         AND contains(lower(o_orderpriority), 'urgent')""",
)
def search_records_by_date(t):
    return search_records(
        t.orders, "Urgent", "o_orderpriority", "o_orderdate", date(1996, 3, 1), date(1996, 8, 31), "o_orderstatus", "F"
    ).select("o_orderkey", "o_orderdate", "o_orderpriority")


RAW_CELL = "' ' || coalesce(names, '') || '|| nan ||' || '||' || coalesce(names, '') || ' '"


@bind(
    "split_values",
    f"""SELECT id, array_to_string(list_filter(list_transform(string_split({RAW_CELL}, '||'), lambda x: trim(x)),
                                               lambda x: x <> '' AND lower(x) <> 'nan'), ';') AS members FROM {CELLS}""",
)
def split_values_query(t):
    cell = F.concat(F.lit(" "), "names", F.lit("|| nan ||||"), "names", F.lit(" "))
    return cells(t).select("id", F.array_join(split_values(cell), ";").alias("members"))


@bind(
    "attachment_manifest",
    f"""SELECT DISTINCT '[' || id || '] ' || file AS label, id, file, 'https://files.example.org/a/' || file AS url
        FROM (SELECT id, unnest(string_split(names, '||')) AS file FROM {CELLS})""",
)
def attachment_manifest_query(t):
    """Cells with a repeated and a blank member; the manifest lists each file once, by label."""
    doubled = cells(t).withColumn("names", F.concat("names", F.lit(SEPARATOR + " " + SEPARATOR), "names"))
    return attachment_manifest(doubled, "id", "names", "https://files.example.org", "a").orderBy("label")


PAIRS = r"""(SELECT page_id, split_part(url, '?', 1) AS base, string_split(split_part(split_part(url, '?', 2), '#', 1), '&') AS parts
             FROM pages WHERE contains(split_part(url, '#', 1), '?'))"""


@bind(
    "url_params",
    f"""SELECT page_id, base, CAST(i - 1 AS INTEGER) AS position, split_part(parts[i], '=', 1) AS key,
               split_part(parts[i], '=', 2) AS value
        FROM (SELECT page_id, base, parts, unnest(range(1, len(parts) + 1)) AS i FROM {PAIRS})""",
)
def url_params_query(t):
    return url_params(t.pages, F.col("url"), "page_id")


@bind(
    "url_params_grouped",
    f"""SELECT page_id, split_part(p, '=', 1) AS key, split_part(p, '=', 2) || ',' || upper(split_part(p, '=', 2)) AS "values"
        FROM (SELECT page_id, unnest(parts) AS p FROM {PAIRS})""",
)
def url_params_grouped_query(t):
    """Every query is repeated in upper-case values, so each key has two values."""
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    upper = F.regexp_replace(F.regexp_replace(query, "=page", "=PAGE"), "=feed", "=FEED")
    upper = F.regexp_replace(upper, "=x", "=X")
    doubled = F.concat_ws("&", F.regexp_extract("url", "^([^#]*)", 1), upper)
    grouped = url_params_grouped(t.pages, doubled, "page_id")
    return grouped.select("page_id", "key", F.array_join("values", ",").alias("values"))


@bind(
    "outcome_summary",
    f"""SELECT CASE {STATUS} WHEN 200 THEN 'ok' WHEN 404 THEN 'not_found' WHEN 500 THEN 'server_error' ELSE 'other' END
          AS outcome, count(*) AS files FROM lineitem GROUP BY 1""",
)
def outcome_summary_query(t):
    return outcome_summary(t.lineitem.select(F.expr(STATUS).alias("status")), "status")


@bind(
    "outcome_failures",
    f"""SELECT CAST(l_partkey AS VARCHAR) || '.pdf' AS file,
               CAST(l_partkey AS VARCHAR) || '.pdf: Status ' || CAST({STATUS} AS VARCHAR) AS message
        FROM lineitem WHERE {STATUS} <> 200""",
)
def outcome_failures_query(t):
    file = F.concat(F.col("l_partkey").cast("string"), F.lit(".pdf"))
    return outcome_failures(t.lineitem.select(file.alias("f"), F.expr(STATUS).alias("status")), "f", "status")


@bind(
    "sort_nulls_last",
    """SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, o_custkey FROM orders
       ORDER BY priority NULLS LAST, o_custkey, o_orderkey""",
)
def sort_nulls_last_query(t):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority")
    return sort_nulls_last(t.orders.select("o_orderkey", priority, "o_custkey"), "priority", "o_custkey", "o_orderkey")


@bind(
    "row_order",
    f"""SELECT 'sorted' AS kind, CAST(o_orderkey AS VARCHAR) AS key, row_number() OVER (ORDER BY priority NULLS LAST, o_custkey, o_orderkey) AS row_no
        FROM (SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders)
        UNION ALL SELECT 'recent', CAST(event_id AS VARCHAR), row_number() OVER (ORDER BY strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') DESC, CAST(event_id AS VARCHAR)) FROM events
        UNION ALL SELECT 'labels', label, row_number() OVER (ORDER BY label)
        FROM (SELECT DISTINCT '[' || id || '] ' || file AS label FROM (SELECT id, unnest(string_split(names, '||')) AS file FROM {CELLS}))
        UNION ALL SELECT 'extract', CAST(o_orderkey AS VARCHAR), row_number() OVER (ORDER BY o_orderkey) FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus <> 'O'""",
)
def row_order(t):
    """The place of every row in the outputs whose order is their purpose."""
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority")
    ordered = {
        "sorted": (sort_nulls_last(t.orders.select("o_orderkey", priority, "o_custkey"), "priority", "o_custkey", "o_orderkey"), "o_orderkey"),
        "recent": (history_recent(runs(t)), "id"),
        "labels": (attachment_manifest(cells(t), "id", "names", "https://files.example.org", "a").orderBy("label"), "label"),
    }
    numbered = {kind: (number_sorted(df), key) for kind, (df, key) in ordered.items()}
    numbered["extract"] = (number_rows(wide_orders(t), order_of_orders(), staged=True), "o_orderkey")
    parts = [df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), "row_no") for kind, (df, key) in numbered.items()]
    return reduce(DataFrame.unionAll, parts)


@bind("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n_query(t):
    return top_n(t.orders.select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), "o_orderkey")


@bind("scan_row_cap", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def scan_row_cap(t):
    return capped(t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey"), 100)


@bind("scan_table", "SELECT * FROM orders")
def scan_table(t):
    return t.orders


@bind("paginate", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def paginate(t):
    return page(t.orders.select("o_orderkey", "o_totalprice"), 50, 3, F.desc("o_totalprice"), "o_orderkey")


@bind("paginate_keyset", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 50")
def paginate_keyset(t):
    return page_after(t.orders.select("o_orderkey", "o_totalprice"), 50, "o_orderkey", 500)


@bind(
    "paginate_all",
    """SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) / 50.0) AS BIGINT) AS page
       FROM orders""",
)
def paginate_all(t):
    """The page of every row, as needed to jump to any page of a large result."""
    rows = number_rows(t.orders.select("o_orderkey", "o_totalprice"), F.desc("o_totalprice"), "o_orderkey")
    return rows.select("o_orderkey", F.ceil(F.col("row_no") / 50).cast("bigint").alias("page"))


@bind(
    "paginate_directory",
    """SELECT page, doc_id, n_chars, position FROM (
         SELECT doc_id, n_chars, (row_number() OVER w - 1) // 50 + 1 AS page, CAST((row_number() OVER w - 1) % 50 AS INTEGER) AS position
         FROM documents WINDOW w AS (ORDER BY n_chars DESC, doc_id)) WHERE page IN (1, 3, 4)""",
)
def paginate_directory(t):
    """Three pages by the ranges of one directory over all rows, with the place of each row on its page."""
    rows = t.documents.select("doc_id", "n_chars")
    directory = build_page_directory(rows, scratch_path(t.spark, "pages"), [By("n_chars", descending=True), "doc_id"], stride=1000)
    pages = []
    for number in (1, 3, 4):
        # A page of rows at most: the longest first, then by id.
        place = F.struct((-F.col("n_chars")).alias("n"), "doc_id")
        held = directory.page(rows, 50, number).agg(F.sort_array(F.collect_list(place)).alias("r"))
        pages.append(held.select(F.lit(number).cast("long").alias("page"), F.posexplode("r").alias("position", "o")))
    return reduce(DataFrame.unionAll, pages).select("page", "o.doc_id", (-F.col("o.n")).alias("n_chars"), "position")


@bind("page_count", "SELECT count(*) AS rows, CAST(ceil(count(*) / 50.0) AS BIGINT) AS pages FROM orders")
def page_count_query(t):
    return page_count(t.orders, 50)
