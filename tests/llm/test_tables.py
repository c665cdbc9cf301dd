import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_common import AWKWARD, corpus, documents, prose
from recordflow.llm.html_text import page_texts, visible_text
from recordflow.llm.licenses import CUE, TEMPLATES, scan_licences, terms
from recordflow.llm.neighbours import Tile, nearest, vector_blocks
from recordflow.llm.queries import RULES
from recordflow.llm.urls import Rule, filter_urls

# -- urls ----------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, address string")


def own(url):
    """Host, path and rule by the contract's words."""
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        return "", "", None
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.host + r.path), default=None)


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/1", "http://www.example.com/en/1?x#y", "https://a.b.example.com/en/", "http://example.com/en", "http://example.com",
    "http://notexample.com/en/1", "http://x.net/es/1", "http://x.net/fr/", "http://net/es/", "http://x.net/de/a://b", "http://x.org/en/1", "http://x.org?q=/a#b", "ftp://ÀB.com/Ä/x#",
    "http://x.com:80/en/", "://y.net/es/z",
]


def test_urls_by_rule(spark):
    rows = [(k, u, None) for k, u in enumerate(URLS)] + [(None, URLS[4], ""), (4, URLS[4], None)]
    got = filter_urls(pages(spark, rows), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule = own(URLS[r.page_id] if r.page_id is not None else URLS[4])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.host + rule.path)
        assert r.verdict == (rule.verdict if rule else "allow")
    assert filter_urls(pages(spark, []), RULES).collect() == []


def test_blocks_reach_aliases(spark):
    link = '<html><LINK data-x=1 href="{}" rel=canonical><p>'.format
    jump = "<meta http-equiv='refresh' content='0; url={}'>".format
    rows = [
        (1, "http://x.net/es/1", ""), (2, "http://mirror.org/a", link("http://x.net/es/1")), (3, "http://far.org/b/c", jump("//mirror.org/a/")),
        (4, "http://www.example.com/en/z", link("http://x.net/es/1")), (5, "http://far.org/b/d", link("c")), (6, "http://clean.org/e", link("http://other.org/")),
        (7, "http://mirror.org/a?utm_source=q#frag", None), (8, "http://mirror.org/a?p=1", None), (9, "http://old.org/", None),
    ]
    moved = spark.createDataFrame([("http://old.org", "http://far.org/b/c")], "src string, dst string")
    got = {r.page_id: (r.verdict, r.via) for r in filter_urls(pages(spark, rows), RULES, moved).collect()}
    assert got[1] == ("block", "rule") and got[4] == ("allow", "rule")
    assert [got[k] for k in (2, 3, 5, 7, 9)] == [("block", "alias")] * 5
    assert got[6] == got[8] == ("allow", "default")
    assert filter_urls(pages(spark, rows[:1]), [Rule("allow", "net", "/es/"), Rule("block", "net", "/es/")]).first().verdict == "allow"


def test_blocked_targets_without_a_page(spark):
    link = '<link rel="canonical" href="{}">'.format
    jump = "<meta http-equiv='refresh' content='0; url={}'>".format
    rows = [
        (1, "http://mirror.org/a", link("http://x.net/es/1")), (2, "http://far.org/b", jump("http://mirror.org/a/")), (3, "http://gone.org/", None),
        (4, "http://clean.org/a", link("http://x.net/de/1")), (5, "http://q.org/a?x=1&y=2", None), (6, "http://q.org/b", link("/a?y=2&amp;x=1")),
        (7, "http://q.org/c", jump("/a?x=1&#038;y=2")), (8, "http://self.net/es", link("/es/")), (9, "http://www.example.com/en/k", link("http://x.net/fr/2")),
        (10, "http://old.org/x", None), (11, None, link("http://clean.org/a")),
    ]
    moved = spark.createDataFrame([("http://gone.org", "http://z.net/fr/9"), ("http://q.org/a?x=1&y=2", "http://z.net/es/1"), ("http://w.net/es/2", "http://old.org/x")], "src string, dst string")
    got = {r.page_id: (r.verdict, r.via) for r in filter_urls(pages(spark, rows), RULES, moved).collect()}
    assert [got[k] for k in (1, 2, 3, 5, 6, 7, 8, 10)] == [("block", "alias")] * 8
    assert got[4] == got[11] == ("allow", "default") and got[9] == ("allow", "rule")


# -- neighbours ----------------------------------------------------------------


def brute_nearest(rows, k, every):
    usable = [(i, v) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in usable if i % every == 0}:
        best = {}
        for i, v in usable:
            if i != q and len(v) == len(a):
                score = 0.0
                for x, y in zip(a, v):
                    score += x * y
                best[i] = max(best.get(i, -math.inf), score)
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out |= {(q, rank, i, score) for rank, (i, score) in enumerate(top, 1)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int")


@pytest.mark.parametrize("n, dim", [(700, 16), (60, 3), (15, 4)])
def test_nearest_equals_brute_force(spark, n, dim):
    rnd = np.random.default_rng(n)
    rows = [(k, rnd.normal(size=dim).astype(np.float32).tolist()) for k in range(n)]
    rows[5] = (5, rows[4][1])  # a tie
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * dim), (n + 3, [float("nan")] * dim), (n + 4, [None] + [1.0] * (dim - 1)), (None, rows[0][1])]
    rows += [rows[7], (20 * n, [float(np.float32(1e30))] * dim), (20 * n + 1, [float("inf")] * dim), (3 * n, [1.0, 2.0])]
    got = nearest(vectors(spark, rows).repartition(3), k=20).collect()
    assert {tuple(r) for r in got} == brute_nearest(rows, 20, 20)
    assert len(got) == len(brute_nearest(rows, 20, 20))


def test_vectors_of_extreme_size(spark):
    """Bounds that overflow or underflow lose no candidate."""
    rnd = np.random.default_rng(3)
    rows = [(k, (rnd.normal(size=4) * 10.0 ** rnd.choice([-320, -200, -160, 0, 3, 150, 200])).tolist()) for k in range(120)]
    rows += [(200, [1e200, 1e200, 1.0, 0.0]), (201, [5e-324, 0.0, 0.0, 0.0]), (220, [5e-324] * 4), (240, [1e308, -1e308, 1e308, 1.0])]
    rows = [(i, v) for i, v in rows if any(v)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {(q, r, v) for q, r, v, s in brute_nearest([(i, v) for i, v in rows], 9, 20) if not math.isnan(s)}
    got = nearest(frame, k=9).collect()
    with np.errstate(all="ignore"):
        exact = {(q, v): sum(a * b for a, b in zip(dict(rows)[q], dict(rows)[v])) for q, _, v in want}
    assert len(got) == 9 * len({i for i, _ in rows if i % 20 == 0})
    for r in got:  # no row that was left out is nearer
        assert (r.query_id, r.rank, r.vec_id) in want or not math.isfinite(r.score) or any(not math.isfinite(x) for (q, _), x in exact.items() if q == r.query_id), r


def test_blocks_do_not_depend_on_the_input_partitions(spark):
    rows = [(k, [float(k % 7), 1.0, float(k % 3)]) for k in range(2000)]
    frame = vectors(spark, rows)
    want = sorted(map(tuple, nearest(frame.repartition(1), k=3).collect()))
    assert sorted(map(tuple, nearest(frame.repartition(64), k=3).collect())) == want
    usable = frame.repartition(64).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    assert vector_blocks(usable.repartition(1), 20).count() == 2 < vector_blocks(usable, 20).count()


def test_no_vectors(spark):
    assert nearest(vectors(spark, [])).collect() == []


def test_tile_keeps_the_best_over_many_blocks():
    rnd = np.random.default_rng(1)
    rows, ids = rnd.normal(size=(3000, 24)), np.arange(3000)
    tile = Tile(ids[:40], rows[:40], 7)
    for start in range(0, 3000, 500):
        tile.add(ids[start : start + 500], rows[start : start + 500])
    exact = rows[:40] @ rows.T
    np.fill_diagonal(exact, -np.inf)
    want = {(q, v) for q in range(40) for v in np.argsort(-exact[q])[:7]}
    assert {(q, v) for q, v, _ in tile.best()} == want


# -- html ----------------------------------------------------------------------

CASES = {
    "": "",
    "<p>One<p>Two <i>x</i>y": "One\n\nTwo xy",
    "a <b> b</b>  c<br>d": "a b c\nd",
    "<div>a</div><div>b</div>c": "a\nb\nc",
    "<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>f": "- a\n- b\n  3. c\n  4. d\n- e\n\nf",
    "<pre>\na   b\n  c</pre>": "a   b\n  c",
    "x<script>var t='</p>';</script><style>p{}</style><!-- no -->y": "xy",
    "<title>no</title><p hidden>no<p style='DISPLAY : none'>no<p style=visibility:hidden>no<p>yes": "yes",
    "<details><summary>S</summary>no</details><details open><summary>S</summary>yes</details>": "S\nS\nyes",
    "&lt;b&gt; &amp;amp; &eacute;": "<b> &amp; é",
    "<table><tr><th>Name<th>Value<tr><td>long name<td>1</table>": "Name       Value\nlong name  1",
    "<table><td rowspan=2>r<td>x<tr><td>y</table>z": "r  x\n   y\n\nz",
    "<table><caption>C</caption><tr><td>a<br>b<td>c</table>": "C\na  c\nb",
    "<blockquote>q</blockquote>r": "  q\n\nr",
    "<p>a</div></span>b</p>c": "ab\n\nc",
    "<select><option>a<option>b</select>": "a\nb",
    "a<b": "a<b",
    "<a title='x>y'>t</a>": "t",
    "<!DOCTYPE html><head><title>T</title><h1>Hi</h1><p>text": "Hi\n\ntext",
    "<html><head>\n<meta charset=utf-8><link rel=x>\n<style>p{}</style>text<p>more": "text\n\nmore",
    "<head><title>T</title></head><body>a<head>b</head>c": "abc",
    "<head><script>no</script></br>a": "a",
    "<table><tbody><form><tr><td>x<td>y</form><tr><td>z</table>": "x  y\nz",
    "<table><tr>text<td>x</table>": "text\nx",
    "<table><tbody>s<b>t</b><div>u<tr><td>x</td><i>v</i></table>w": "st\nu\nv\nx\n\nw",
    "<table><caption>C<tr><td>a<table><tr>n<td>m</table></table>": "C\na\n\nn\nm",
    f"<div data-x='{'>no<p>' * 400}' hidden>no</div><p title=\"{'>' * 2000}\" style=display:none>no<p>yes": "yes",
    "<a title=it's>don't</a> <a href=x=\"y>z</a>": "don't z",
    "<p title='>x>y": "x>y",
    "<p title='a' b='>x": "x",
    "a<b <!-- no": "a<b",
    "a<svg><title>no</title><defs/><path d='M0'/><desc>no</desc>no<g><text>b<tspan>c</tspan></text></g></svg>d": "a bc d",
    "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>": "x=1",
    "<svg><path d=x><p>a": "a",
    "<xmp>&amp;<b>x</b></xmp>y": "&amp;<b>x</b>\n\ny",
    "<textarea>a &amp; b\n  c</textarea>d": "a & b\n  c\nd",
    "<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div><p style=display:nonexistent>too": "yes\n\ntoo",
    "<style>.x{display:none} #y, b.z { visibility:hidden } /* p{display:none} */ @media print { i{display:none} }</style><p class='w x'>no<p>a<b class=z>no</b><i>b</i><u id=y>no": "ab",
    "<p class=x style='display:block'>a<p class=x>no<p hidden style='display:block'>b<style>p.x{display:none}</style>": "a\n\nb",
    "<style>b{display:none!important} b.k{display:inline}</style>a<b class=k style=display:inline>no</b>": "a",
    "<ol reversed><li>a<li>b<li value=9>c<li>d</ol>": "4. a\n3. b\n9. c\n8. d",
    "<ol start=2147483640><li>a</ol><ol start=99999999999><li>b</ol>": "2147483640. a\n\n1. b",
    "<ruby>a<rp>(</rp><rt>b</rt><rp>)</rp></ruby>": "ab",
    "<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>a<tr style='visibility:visible'><td>b<td>c</table>": "   a\nb  c",
    "<table><tr><td colspan=120>" + "a" * 90 + "<td>b<tr><td>" + "c" * 90 + "<td>d<tr><td>e<td>f</table>": "a" * 90 + "  b\n" + "c" * 90 + "  d\n" + "e" + " " * 81 + "f",
    "<div>" * 119 + "<div hidden><p>no<div>no</div><b>no</b></div>yes": "yes",
    "<div>" * 130 + "<div style='display:none'><table><tr><td>no</table><p>no</div>yes": "yes",
    "<table><tr><td>" + "<b>" * 130 + "a<td>b": "a  b",
    "<ul><li>" + "<i>" * 130 + "a<li>b</ul>" + "<div>" * 150 + "<p>c<p>d<br>e<script>no</script><table><tr><td>f<td>g</table>h": "- a\n- b\n\nc\nd\ne\nf g\nh",
    "<svg><g visibility=hidden style='visibility:hidden'><text>no</text><text style='visibility:visible'>a</text></g></svg>": "a",
    "<svg><foreignObject><p>a</p>b</foreignObject></svg><pre>c<svg><text>d</text></svg></pre>": "a\n\nb\n\nc d",
}


@pytest.mark.parametrize("html", CASES)
def test_visible_text(html):
    assert visible_text(html) == CASES[html]


def test_visible_words_of_random_trees():
    """Against a second reading: the words of all elements that no ancestor, rule or own attribute hides."""
    rnd = random.Random(11)
    sheet = "<style>.gone{display:none} .dim{visibility:hidden} .lit{visibility:visible} i.gone{display:inline}</style>"
    kinds = ["", "", "", " hidden", " style='display:none'", " style='visibility:hidden'", " style='visibility:visible'", " class=gone", " class='a dim'", " class=lit", " style='display:block' hidden"]
    for _ in range(300):
        shown, count = [], 0

        def tree(depth, displayed, visibility):
            nonlocal count
            out = []
            for _ in range(rnd.randint(1, 3) if depth < 5 else 1):
                count += 1
                out.append(f" w{count} ")
                if displayed and visibility:
                    shown.append(f"w{count}")
                if depth < (140 if deep else 6) and rnd.random() < (0.97 if deep else 0.7):
                    tag, kind = rnd.choice(["div", "b", "i", "section", "span"]), rnd.choice(kinds if not deep or rnd.random() < 0.03 else [""])
                    gone = kind in (" hidden", " style='display:none'") or kind == " class=gone" and tag != "i"
                    sees = False if "visibility:hidden" in kind or "dim" in kind else True if "visible" in kind or "lit" in kind else visibility
                    out.append(f"<{tag}{kind}>" + tree(depth + 1, displayed and not gone, sees) + f"</{tag}>")
            return "".join(out)

        deep = rnd.random() < 0.2
        html = sheet + tree(0, True, True)
        found = re.findall(r"w[0-9]+", visible_text(html))
        assert found == shown, html


def test_tag_ends_take_linear_time():
    for piece in ("<a ", "<a b='", "<a b=\"'", "<a b=\">\" ", "<a b='x' c=\"", "<a =", "<a b='>' c=\">\"", "<a b=' \" c=\" '"):
        for end in ("", ">", "'", "\"", "=\""):
            start = time.perf_counter()
            visible_text(piece * 60_000 + end)
            assert time.perf_counter() - start < 10, (piece, end)


def test_every_text_of_a_table_comes_out():
    rnd = random.Random(5)
    tags = ["<table>", "</table>", "<tbody>", "<thead>", "</tbody>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "<form>", "</form>", "<div>", "</div>", "<b>", "<p>", "<li>", "<caption>", "<col>"]
    for _ in range(1500):
        parts = [rnd.choice(tags) if rnd.random() < 0.6 else f"w{k}w" for k in range(30)]
        found = re.findall(r"w\d+w", visible_text("<table>" + "".join(parts)))
        assert sorted(found) == sorted(p for p in parts if p[0] == "w"), parts


def test_broken_pages_are_no_error(spark):
    rnd = random.Random(3)
    for _ in range(1500):
        visible_text("".join(rnd.choice(["<", ">", "</", "<p>", "<li>", "<table>", "<td>", "</table>", "<ul>", "</ul>", "x", " ", '"', "'", "=", "<!--", "<script>", "&amp;", "<tr rowspan=9>", "<td colspan=3>"]) for _ in range(rnd.randint(0, 40))))
    deep = "<div>" * 50_000 + "x" + "<table><tr><td>" * 500 + "y"
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<p>a"), (3, "u", "<p>a"), (None, None, "b"), (4, "u", deep)]
    got = sorted(((r.page_id or 0), r.text, r.n_lines) for r in page_texts(pages(spark, rows)).collect())
    assert got[:5] == [(0, "b", 1), (1, "", 0), (2, "", 0), (3, "a", 1), (3, "a", 1)]
    assert "x" in got[5][1] and got[5][1].rstrip().endswith("y")
    assert page_texts(pages(spark, [])).collect() == []


# -- licences ------------------------------------------------------------------


def told_apart(unit, template):
    """Versions and qualifiers, by words: the template's are all there, and no other qualifier in a short unit."""
    words = lambda t: re.findall(r"[0-9]+(?:\.[0-9]+)*|[^\W\d_]+", t.lower())
    alike = {"noncommercial": "nc", "noderivatives": "nd", "noderivs": "nd", "sharealike": "sa"}
    qualifiers = lambda t: {alike.get(w, w) for w in words(t)} & {"affero", "lesser", "nc", "nd", "sa"}
    versions = lambda t: {w.removesuffix(".0") for w in words(t) if re.fullmatch(r"[0-9]{1,2}(\.[0-9]{1,2})?", w)}
    short = len(re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+", unit)) <= 100
    return versions(template) <= versions(unit) and (qualifiers(template) == qualifiers(unit) if short else qualifiers(template) <= qualifiers(unit))


def brute_licences(files, threshold):
    """Cosine and inheritance by the definitions, in plain Python."""
    known = sorted({p for p, _ in files if p is not None})
    text = {}
    count = {}
    for p, t in files:
        text.setdefault(p, []).append(t or "")
        for w in set(re.sub(r"[^0-9a-z\x80-\U0010FFFF]", " ", (t or "").lower()).split()):
            count[w] = count.get(w, 0) + 1
    idf = lambda w: math.log((len(files) + 1) / (count.get(w, 0) + 1)) + 1

    def vector(t):
        found = [w.decode() for w in terms(t)]
        return {w: found.count(w) * idf(w) for w in set(found)}

    def cosine(a, b):
        size = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / size if size else 0

    is_file = lambda p: re.match(r"(?i)(licen[cs]e|copying|unlicen[cs]e|notice)([-_.].*)?$", p.rpartition("/")[2])
    own = {}
    for p in known:
        units = [line for t in text[p] for line in t.split("\n") if CUE.search(line)] + [t for t in text[p] if is_file(p)]
        scored = [(-round(cosine(vector(u), vector(s)), 9), name) for u in units for name, s in TEMPLATES if told_apart(u, s)]
        scored = [x for x in scored if -x[0] >= threshold]
        if scored:
            own[p] = min(scored)
    folder = {}
    for p, best in own.items():
        if is_file(p):
            at = p.rpartition("/")[0]
            folder[at] = min(folder.get(at, best), best)
    out = {}
    for p in known:
        if p in own:
            out[p] = (own[p][1], "file" if is_file(p) else "header", -own[p][0], p)
            continue
        at = p
        out[p] = (None, None, None, None)
        while at:
            at = at.rpartition("/")[0]
            if at in folder:
                out[p] = (folder[at][1], "inherited", None, at)
                break
    return out


def test_licences_equal_brute_force(spark):
    filler = [t for _, t in corpus(9, 6)]
    files = [
        ("a/LICENSE", "Released under the MIT License.\nCopyright someone"), ("a/x.c", filler[0]), ("a/b/y.c", filler[1]), ("a/b/c/z.c", filler[2] + "\nLicensed under the Apache License, Version 2.0."),
        ("a/b/COPYING.txt", TEMPLATES[8][1]), ("a/b/c/w.c", filler[3]), ("q/r.c", filler[4]), ("top.c", "All rights reserved."), ("d/LICENSE-1", "nothing of the kind"), ("d/e.c", None),
        ("LICENCE", "This work is licensed under the GNU General Public License, version 3."), ("a/x.c", filler[0]), ("long.c", "word " * 20000 + "\nlicense " * 10), ("f/g.c", ""),
    ]
    table = spark.createDataFrame([(*f, "x", "y") for f in files + [(None, "MIT License")]], "path string, text string, licence string, score string")
    got = scan_licences(table).collect()
    assert len(got) == len(files) + 1
    want = brute_licences(files + [(None, "MIT License")], 0.6)
    for r in got:
        if r.path is None:
            assert r.licence is None
            continue
        licence, origin, score, start = want[r.path]
        assert (r.licence, r.origin, r.from_path) == (licence, origin, start), r
        assert score is None and r.score is None or abs(r.score - score) < 1e-6
    assert scan_licences(table.limit(0)).collect() == []


def test_notices_inside_other_text(spark):
    filler = " ".join(t.replace("\n", " ") for _, t in corpus(9, 12))
    wrapped = TEMPLATES[8][1].split()
    files = [
        ("a/LICENSE", "Released under the MIT License"), ("a/min.js", f"var a=1;/*! {filler} Licensed under the Apache License, Version 2.0 {filler} */f()"),
        ("a/tag.c", "// SPDX-License-Identifier: GPL-3.0-or-later"), ("a/one.js", f"/* {filler} SPDX-License-Identifier: (MPL-2.0 OR MIT). {filler} */"), ("a/isc.c", "# SPDX-License-Identifier: ISC"),
        ("a/wrap.py", "\n".join("# " + " ".join(wrapped[k : k + 7]) for k in range(0, len(wrapped), 7))), ("a/prose.txt", f"{filler} and this work is licensed under CC BY 4.0, as said. {filler}"),
        ("a/both.c", f"Copyright 2020 someone. All rights reserved. {TEMPLATES[2][1]}: {filler}"), ("a/none.c", filler),
    ]
    got = {r.path: (r.licence, r.origin) for r in scan_licences(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got == {
        "a/LICENSE": ("MIT", "file"), "a/min.js": ("Apache-2.0", "header"), "a/tag.c": ("GPL-3.0", "header"), "a/one.js": ("MPL-2.0 OR MIT", "header"), "a/isc.c": ("ISC", "header"),
        "a/wrap.py": ("GPL-3.0", "header"), "a/prose.txt": ("CC-BY-4.0", "header"), "a/both.c": ("BSD-3-Clause", "header"), "a/none.c": ("MIT", "inherited"),
    }


def test_licences_of_one_family_are_told_apart(spark):
    files = {
        "gpl2.c": ("Licensed under the GNU General Public License, version 2", "GPL-2.0"), "gpl3.c": ("under the GNU General Public License, version 3 only", "GPL-3.0"),
        "agpl.c": ("This work is licensed under the GNU Affero General Public License v3", "AGPL-3.0"), "sa.c": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
        "by.c": ("This work is licensed under a Creative Commons Attribution 4.0 International License", "CC-BY-4.0"), "by3.c": ("This work is licensed under a Creative Commons Attribution 3.0 International License", None),
        "a/LICENSE": ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n" + " ".join(prose(5, 300)), "LGPL-3.0"), "a/x.c": ("nothing", "LGPL-3.0"),
        "two.c": ("# SPDX-License-Identifier: Apache-2.0 OR MIT", "Apache-2.0 OR MIT"), "with.c": ("/* SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */", "GPL-2.0 WITH Classpath-exception-2.0"),
        "a/isc.c": ("# SPDX-License-Identifier: ISC", "ISC"), "a/odd.c": ("# SPDX-License-Identifier: LicenseRef-Own and more", "LicenseRef-Own"), "a/dash.c": ("-- SPDX-License-Identifier: mit -->", "MIT"),
        "apache1.c": ("Licensed under the Apache License, Version 1.1", None), "none.c": ("GNU General Public License", None), "isc2.c": (dict(TEMPLATES)["ISC"], "ISC"), "nc.c": ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
        "COPYING": (None, None), "empty/LICENSE": ("", None), "empty/x.c": ("plain", None),
    }
    got = {r.path: r.licence for r in scan_licences(spark.createDataFrame([(p, t) for p, (t, _) in files.items()], "path string, text string")).collect()}
    assert got == {p: want for p, (_, want) in files.items()}


def test_paths_of_documents(spark):
    from recordflow.llm.queries import document_path

    docs = documents(spark, corpus(2, 3) + AWKWARD).withColumn("path", document_path())
    assert docs.where("path IS NULL AND doc_id IS NOT NULL").count() == 0
    assert docs.where(F.col("doc_id") == 900).first().path == "s/en/LICENSE-900"
