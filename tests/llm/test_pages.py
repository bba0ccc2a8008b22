"""Operators 8 and 9: pages."""
import html as H
import random
import re

import pytest
from pyspark.sql import functions as F

from trackscene.llm import html, warc

from ..conftest import SF_SMALL

PAGES = "page_id long, url string, html string"


def plain_article(page):
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(H.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(b for b in blocks if b)


def test_articles_of_the_table(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = {r["page_id"]: plain_article(r["html"]) for r in pages.collect()}
    for r in html.query(pages).collect():
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


FURNISHED = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header class="site"><a href="/">Home</a></header><nav><ul><li>One<li>Two</ul></nav>
<div class="cookie-notice">We use cookies</div><div role="complementary">Side</div>
<main><article><header><h1>Title &amp; more</h1></header><p>First   para<b>graph</b>
goes on.<p>Second &lt;one&gt; <a href="x">link</a><br>line<script>var x = "</p>";</script>
<div class="ad-banner">Buy</div><ul><li>item a<li>item b</ul><table><tr><td>c1<td>c2</table>
<form>Mail <input><button>Go</button></form><footer>Posted by</footer></article>
<section id="comments"><article class="comment"><p>Nice!</p></article></section></main>
<aside>More</aside><footer>&copy;</footer></body></html>"""


def test_furniture_goes():
    assert html.main_text(FURNISHED) == ("Title & more\n\nFirst paragraph goes on.\n\nSecond <one> link line\n\nitem a\n\nitem b\n\nc1\n\nc2")


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("<article><p>open", "open"), ("a < b &amp c &#233;", "a < b & c é"),
    ("<script>never closed <p>x</p>", ""), ("<body><div>one</div>two<div>three</div></body>", "one\n\ntwo\n\nthree"),
    ("<!-- <p>no</p> --><p>yes</p>", "yes"), ("<p hidden=''>no</p><p>yes", "yes"), ("<p hidden>no</p><p>yes", "yes"), ("<P CLASS=x>Up</P>", "Up"), ("<main><p>in</main><p>out", "in"),
    ("<textarea>no</textarea>yes", "yes"), ("<div " + "a" * 1000, "<div " + "a" * 1000), ("<i>" * 3000 + "deep", "deep")])
def test_pieces_of_html(page, want):
    assert html.main_text(page or "") == want


def site(spark):
    """A host without articles: furniture in unnamed divs that its pages share, and texts of their own."""
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    own = {i: [" ".join(word() for _ in range(12)) + "." for _ in range(3)] for i in range(40)}
    page = lambda i: ("<html><body><div class='x1'><a href='/a'>Start</a> <a href='/b'>Contact us today.</a></div><div class='x2'>"
                      + "".join(f"<p>{t}</p>" for t in own[i]) + "</div><div class='x3'>All of this is ours. Call us.</div></body></html>")
    rows = [(i, "http://shop.example/p/%d" % i, page(i)) for i in own] + [(100, "http://one.example/", page(0)), (101, None, page(1)), (102, "odd", None)]
    return spark.createDataFrame(rows, PAGES), own


def test_low_importance_branches_leave_every_page(spark):
    pages, own = site(spark)
    tree = {r["path"]: r["importance"] for r in html.style_tree(pages).where("host = 'shop.example'").collect()}
    assert tree[">html>body>div.x1"] < html.LOW and tree[">html>body>div.x3"] < html.LOW and tree[">html>body>div.x2"] > 0.8
    got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    assert all(got[i] == "\n\n".join(t) for i, t in own.items())
    assert "ours" in got[100] and "ours" in got[101] and got[102] == ""  # a host's only pages say nothing about it


def test_equal_pages_count_once_and_shuffled_hosts_agree(spark, monkeypatch):
    pages, own = site(spark)
    copies = pages.where("page_id = 3").crossJoin(spark.range(50)).select((F.col("id") + 1000).alias("page_id"), "url", "html")
    monkeypatch.setattr(html, "BROADCAST_HOSTS", -1)
    got = {r["page_id"]: r["text"] for r in html.extract(pages.union(copies)).collect()}
    assert got[1000] == "\n\n".join(own[3]) and got[7] == "\n\n".join(own[7])
    assert html.extract(pages.limit(0)).count() == 0


def test_importance_judges_inside_articles(spark):
    """Shared furniture in unnamed divs of an article goes by importance alone; its own blocks and sentences stay."""
    r = random.Random(2)
    words = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    own = {i: [words(5), words(20) + " see <b>here</b> " + words(3) + ".", words(12) + "."] for i in range(30)}
    page = lambda t: (f"<html><body><main><article class='x'><h1>{t[0]}</h1><p>{t[1]}</p><div class='x7'>Read this too. Buy our book.</div>"  # noqa: E731
                      f"<p>{t[2]}</p><div><p>All about us.</p></div></article></main></body></html>")
    pages = spark.createDataFrame([(i, f"https://news.example/{i}", page(t)) for i, t in own.items()], PAGES)
    low = {x for row in html.low_branches(pages).collect() for x in row["low"]}
    assert ">html>body>main>article.x>div.x7" in low and not any(x.endswith(("article.x", "main", "body", "html")) for x in low)
    for row in html.extract(pages).collect():
        assert row["text"] == "\n\n".join(own[row["page_id"]]).replace("<b>", "").replace("</b>", "")
    assert "Buy our book." in html.main_text(page(own[0]))


STORY = "<p>" + "A long story of many words goes on here. " * 12 + "</p>"


@pytest.mark.parametrize("page", [
    "<body><div class='has-sidebar'>%s</div>", "<div class='with-sidebar'>%s<aside>n</aside></div>", "<div class='no-comments'>%s</div>",
    "<div id='search-page'>%s</div>", "<div class='ad-free'>%s</div>", "<div class='search widget'>%s</div>", "<form action='x'><nav>n</nav>%s</form>",
    "<object>%s</object>", "<dialog open>%s</dialog>", "<article><a href='x'>n</a></article><div>%s</div><article>n</article>",
    "<main><article>n</article></main><div class='widget'>%s</div>", "<div title='a hidden gem' alt=\"is hidden\">%s</div>", "<div data-x=hidden>%s</div>",
    "<form>%s<div id='comments'>" + "<p>nnn nnn</p>" * 200 + "</div></form>"])
def test_loose_rules_leave_the_main_text(page):
    blocks = html.main_text(page.replace("%s", STORY)).split("\n\n")
    assert " ".join(STORY[3:-4].split()) in blocks and not any("nnn" in b for b in blocks)


def test_rules_still_take_what_is_small():
    assert html.main_text("<div class='entry-header'><h1>Title</h1></div>" + STORY).startswith("Title\n\n")
    assert "no" not in html.main_text("<div class='site-header'>no</div><form>no</form><dialog>no</dialog><p Hidden>no</p><p title='x' hidden>no</p>" + STORY)
    assert html.main_text("<div class='ad'>Much longer than the article.</div><article>One</article>") == "One"


def damaged_rows(records, change):
    out = []
    for r in records:
        x = change(r)
        if x is not None:
            out.append(x)
    return out


def test_audit_finds_what_differs(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").union(spark.createDataFrame([(None, None, None), (5, "u", ""), (5, "u", "")], PAGES))
    a = warc.pages_to_records(pages, 3)
    rows = [tuple(r) for r in a.collect()]
    by_file = {}
    for r in rows:
        by_file.setdefault(r[0], []).append(r)
    for rs in by_file.values():  # records lie one after another
        assert [r[1] for r in rs] == list(range(len(rs))) and all(x[2] + x[3] == y[2] for x, y in zip(rs, rs[1:]))
    wrong = {(f, k) for f, rs in by_file.items() for k in (0, len(rs) // 2, len(rs) - 1)}
    schema = a.schema
    b = spark.createDataFrame([(f, s, o, n, bytes([x[0] ^ 255]) + bytes(x[1:]) if (f, s) in wrong else x) for f, s, o, n, x in rows], schema)
    got = warc.audit(a, b).collect()
    assert {(r["file"], r["seq"]) for r in got} == wrong and {r["status"] for r in got} == {"changed"}
    at = {(r[0], r[1]): (r[2], r[3]) for r in rows}
    assert all((r["offset"], r["size"]) == at[r["file"], r["seq"]] for r in got)
    assert warc.audit(a, a).count() == 0
    f = rows[0][0]
    fewer = spark.createDataFrame([r for r in rows if r[0] != f and r[1] != 3], schema)
    got = {(r["file"], r["seq"]): r["status"] for r in warc.audit(a, fewer).collect()}
    assert got == {(r[0], r[1]): "missing" for r in rows if r[0] == f or r[1] == 3}
    assert {r["status"] for r in warc.audit(fewer, a).collect()} == {"extra"}
    none = a.limit(0)
    assert warc.audit(none, none).count() == 0 and warc.audit(none, a).count() == len(rows)


def test_query_locates_the_damage(spark):
    import zlib
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").union(spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/pages.parquet"))
    want = {(r["file"], r["seq"]) for r in warc.pages_to_records(pages).collect() if zlib.crc32(r["record"]) % 97 == 0}
    assert {(r["file"], r["seq"]) for r in warc.query(pages).collect()} == want and want


def test_files_of_records(spark, scratch):
    import os
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    rows = warc.pages_to_records(pages, 2).orderBy("file", "seq").collect()
    for r in rows:
        with open(os.path.join(scratch, r["file"]), "ab") as f:
            f.write(r["record"])
    back = warc.read_warc(spark, scratch).orderBy("file", "seq").collect()
    assert back == rows
    headers, payload = warc.parse_record(bytes(rows[0]["record"]))
    assert headers["WARC-Type"] == "response" and payload.endswith(pages.orderBy("page_id").first()["html"].encode())
