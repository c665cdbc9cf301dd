"""URL filter by host and path rules, with decisions propagated to aliases. DataFrame operations only.

Aliases are found in three ways: spellings of one address (fragment, tracking
parameters, order of parameters, final slash), canonical links and refresh
redirects in the pages' HTML, and, where given, a table of redirects. Addresses
joined by such edges form components; a component that holds a blocked address
blocks its members without a rule of their own, whether a page of that address
is in the table or only a link names it. A page's own rule always wins, so an
explicit allow is never overruled by an alias.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import Stages
from recordflow.llm.components import connected_components


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


#: Parameters that name a visit, not a page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_AMPERSAND = "&(?:amp|AMP|#0*38|#[xX]0*26);"
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """One spelling for all of a page's addresses; null where there is no ``://``."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    page = F.concat(host_of(url), F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(
        F.instr(url, "://") > 0, F.when(F.size(kept) > 0, F.concat(page, F.lit("?"), F.array_join(kept, "&"))).otherwise(page)
    )


def resolved(target: Column, url: Column) -> Column:
    """A link's target as an absolute address; null if empty."""
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    return (
        F.when(target == "", None)
        .when(F.instr(target, "://") > 0, target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(F.lit("http://"), host_of(url), target))
        .otherwise(F.concat(F.lit("http://"), host_of(url), F.when(folder == "", "/").otherwise(folder), target))
    )


def own_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as struct (length, verdict, rule); an allow before a block of the same length."""
    table = F.array(
        *(F.struct(F.lit(len(r.host + r.path)).alias("length"), F.lit(r.verdict != "block").alias("allow"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path")) for r in rules)
    )
    fits = F.filter(table, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]))
    return F.array_max(fits)


def _blocks(url: Column, rules: list[Rule]) -> Column:
    """Does the rule that fits an address block it?"""
    return ~F.coalesce(own_rule(host_of(url), path_of(url), rules)["allow"], F.lit(True))


def filter_urls(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, via)`` for every row of ``pages(page_id, url, html, ...)``.

    ``rule`` is the longest fitting rule (host and path), else null; ``verdict``
    is the rule's, else block if an alias of the page is blocked by a rule, else
    allow; ``via`` says which: rule, alias or default. ``rules`` is a parameter
    of bounded size; ``redirects(src, dst)`` may add edges. A null url or one
    without ``://`` has no host, path, rule or alias. Repeated rows, ties and
    null ids are kept as they are; other columns are ignored; null HTML has no
    links; an empty table gives no rows.

    A very common address is pre-aggregated before it is grouped, and the join
    back is a plain one that the adaptive planner splits.
    """
    stages = Stages(pages.sparkSession, "urls")
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    targets = [
        resolved(F.regexp_replace(F.coalesce(F.regexp_extract("html", pattern, 1), F.lit("")), _AMPERSAND, "&"), F.col("url"))
        for pattern in (_CANONICAL, _REFRESH)
    ]
    parsed = pages.select(F.col("page_id").alias("page_id"), url.alias("url"), html.alias("html"))
    parsed = parsed.withColumn("targets", F.array(*targets)).select(
        "page_id", host.alias("host"), path.alias("path"), address(F.col("url")).alias("address"),
        F.transform("targets", lambda t: F.struct(address(t).alias("address"), _blocks(t, rules).alias("bad"))).alias("targets"),
    ).withColumn("own", own_rule(F.col("host"), F.col("path"), rules))
    parsed = stages.write(parsed, "pages")
    links = parsed.where("address IS NOT NULL").select(F.col("address").alias("src"), F.lit(False).alias("src_bad"), F.explode("targets").alias("t"))
    links = links.select("src", "src_bad", F.col("t.address").alias("dst"), F.col("t.bad").alias("dst_bad"))
    if redirects is not None:
        # Names apart from the results': inside a lambda, an alias of the same select would be taken for the column.
        src, dst = F.col("src_url"), F.col("dst_url")
        given = redirects.select(F.col("src").cast("string").alias("src_url"), F.col("dst").cast("string").alias("dst_url"))
        links = links.unionByName(given.select(
            address(src).alias("src"), _blocks(src, rules).alias("src_bad"), address(dst).alias("dst"), _blocks(dst, rules).alias("dst_bad")
        ))
    links = links.where("src IS NOT NULL AND dst IS NOT NULL").groupBy("src", "dst").agg(F.max("src_bad").alias("src_bad"), F.max("dst_bad").alias("dst_bad"))
    links = stages.write(links, "links")
    # Both ends of a link are judged as they are written there; the address alone has lost final slashes.
    blocked = parsed.where("address IS NOT NULL AND NOT own.allow").select("address")
    blocked = blocked.unionByName(links.where("src_bad").select(F.col("src").alias("address")))
    blocked = blocked.unionByName(links.where("dst_bad").select(F.col("dst").alias("address"))).distinct()
    edges = links.where("src != dst").select("src", "dst")
    if not edges.isEmpty():
        member = stages.write(connected_components(edges, stages), "aliases")
        bad = member.join(blocked, F.col("node") == F.col("address"), "left_semi").select("component").distinct()
        reached = member.join(bad, "component", "left_semi").select(F.col("node").alias("address"))
        blocked = blocked.unionByName(reached).distinct()
    marked = parsed.join(blocked.select(F.col("address").alias("hit")), F.col("address") == F.col("hit"), "left")
    rule = F.concat("own.host", "own.path")
    return marked.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.when(F.col("own").isNotNull(), F.when(F.col("own.allow"), "allow").otherwise("block"))
        .when(F.col("hit").isNotNull(), "block").otherwise("allow").alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("hit").isNotNull(), "alias").otherwise("default").alias("via"),
    )
