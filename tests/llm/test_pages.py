"""HTML extraction: pages of the test tables by a plain reading of their one template, made pages of other templates, odd rows."""

import html
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartstream.llm import html_text, queries
from cartstream.llm.html_tree import read


def by_force(source):
    """The test tables' pages: an article of h1 and p."""
    article = re.search(r"<article>(.*)</article>", source or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", article[1]) if article else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def run(pages):
    """Main texts of the pages of one host, through one wrapper per kind."""
    wrappers = {}
    for page in pages:
        node = read(page)
        wrappers = html_text.joined(wrappers, {html_text.kind_of(node): html_text.items_of(node)})
    wrappers = html_text.unpacked(html_text.packed(wrappers))
    for kind, items in wrappers.items():
        html_text.mark(items, kind)
    return ["\n".join(html_text.main_texts(read(p), wrappers[html_text.kind_of(read(p))])) for p in pages]


def test_pages_of_the_table(spark, sf):
    want = {r["page_id"]: (r["url"], by_force(r["html"])) for r in pq.read_table(f"{sf}/pages.parquet").to_pylist()}
    got = queries.op11_html_extraction(spark, sf).collect()
    assert len(got) == len(want)
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def words(rng, n):
    return " ".join(rng.choices(["north", "harbour", "quiet", "lantern", "walks", "over", "river", "stone", "bread", "the"], k=n)).capitalize() + "."


def furniture(rng, body):
    """A page of one template, some parts of which are there on some pages only."""
    menu = "".join(f"<li><a href=/{w}>{w}</a>" for w in rng.choices(["home", "news", "sport", "arts"], k=rng.randint(2, 6)))
    notice = '<div id="cookie-consent"><p>We use cookies.<button>Accept</button></div>' if rng.random() < 0.5 else ""
    comments = "".join(f'<li><div class="comment"><p>{words(rng, 9)}</p></div>' for _ in range(rng.randint(0, 4)))
    return (
        f"<!doctype html><html><head><title>x</title><script>if (a < b) c('<p>')</script></head><body class='has-sidebar'>{notice}"
        f"<header><img src=l.png><span>The Daily {rng.randint(1, 9)}</span></header><nav><ul>{menu}</ul></nav>{body}"
        f"<aside><h3>Related</h3><p>{words(rng, 6)}</p></aside><section id=comments><ol>{comments}</ol>"
        f"<form><label>Your say</label><textarea>write</textarea></form></section><footer><p>Copyright {rng.randint(1990, 2020)}"
    )


@pytest.mark.parametrize("template", ["article", "main", "plain"])
def test_other_templates(template):
    rng = random.Random(template)
    pages, want = [], []
    for _ in range(40):
        blocks = [words(rng, rng.randint(8, 40)) for _ in range(rng.randint(1, 8))]
        inner = ""
        for k, b in enumerate(blocks):
            shape = rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<ul><li>{}</ul>", "<blockquote><p>{}</p></blockquote>"]) if k else "<h1>{}</h1>"
            inner += shape.format(b.replace(" the ", " <em>the</em> ", 1))
            if rng.random() < 0.2:
                inner += '<div class="ad-slot sponsored">Buy now &amp; save</div>'
        wrap = {"article": "<article class='post has-comments'>{}</article>", "main": "<div role=main>{}</div>", "plain": "<div class=c1>{}</div>"}
        pages.append(furniture(rng, wrap[template].format(inner)))
        want.append("\n".join(blocks))
    assert run(pages) == want


def test_a_template_text_is_left_out_where_nothing_marks_the_article():
    rng = random.Random(8)
    blocks = [words(rng, 30) for _ in range(12)]
    pages = [f"<body><div><h4>Our paper since 1901, every day but on Sundays.</h4><p>{b}</p></div></body>" for b in blocks]
    assert run(pages) == blocks


def test_repeated_groups_fold():
    show = lambda items: " ".join(
        i.label + (f"{{{show(i.kids)}}}" if i.kids and not i.label.startswith("(") else "") + "+" * i.many + "?" * i.opt for i in items
    )
    pages = ["<h2>a</h2><p>b</p>", "<h2>a</h2><p>b</p><h2>c</h2><p>d</p>", "<h2>a</h2><p>b</p><h2>c</h2><p>d</p><hr><ul><li>e<li>f</ul>"]
    total = html_text.items_of(read(pages[0]))
    for page in pages[1:]:
        total = html_text.align(total, html_text.items_of(read(page)))
    assert show(total) == "(h2 p)+ ul{li{#}+}?"


def test_wrappers_stay_bounded():
    rng = random.Random(2)
    total = {}
    for _ in range(60):
        page = "".join(f"<{t}>{rng.random()}</{t}>" for t in rng.choices(["p", "h2", "h3", "ul", "pre", "table", "section"], k=200))
        total = html_text.joined(total, {"plain": html_text.items_of(read(page))})
    assert len(html_text.packed(total)) < 3000


def test_tag_soup():
    one = lambda page: run([f"<article>{page}</article>"])[0]
    assert one("a <b>b<br>c &lt;d&gt;&nbsp;&#233;<p>x<div>y</div>z") == "a b c <d> é\nx\ny\nz"
    assert one("<p>a<script>1 < 2 </p></script>b<svg><text>no</text></svg>c</p>") == "abc"
    assert one("<p title='a > b'>x < y and <3</p><!-- no <p>no --><p a=\"unclosed>z</p>") == "x < y and <3\nz"
    assert one("<p>a</b></i></section>b") == "ab"
    assert one("<table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl>") == "a\nb\nc\nd\ne"
    assert one("<p>a<noscript>no<div>no</div></noscript> b<template><div></div>no</template></p>c") == "a b\nc"
    assert run(["<article>a<script>never closed <p>b"]) == ["a"] and run(["<p>a<!-- never closed <p>b"]) == ["a"]
    deep = "<div>" * 30_000 + "deep" + "</div>" * 30_000 + "<p>after"
    assert run([deep]) == ["deep\nafter"]
    long = "<article>" + "".join(f"<p>{k}" for k in range(50_000)) + "</article>"
    assert run([long])[0].split("\n") == [str(k) for k in range(50_000)]
    for soup in ["<" * 50_000, "<a" * 50_000, "<p x=\"" * 20_000, "<!--" * 50_000, "</" * 50_000, "<span class=ad>" * 20_000]:
        run([soup])


def test_odd_rows(spark):
    pages = [
        (1, None, None), (2, "no scheme", ""), (3, "http://A.org", "<p>x"), (None, None, "<article>y</article>"), (3, "http://A.org", "<p>x"),
        (4, "http://a.org/2", "just text"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn(
        "wrapper", F.lit(1)).withColumn("part", F.lit(1)).repartition(3)
    got = sorted((tuple(r) for r in html_text.extract(frame).collect()), key=str)
    assert got == sorted(
        [(1, None, "", 0), (2, "no scheme", "", 0), (3, "http://A.org", "x", 1), (3, "http://A.org", "x", 1), (None, None, "y", 1),
         (4, "http://a.org/2", "just text", 9)], key=str)
    assert html_text.extract(frame.limit(0)).count() == 0


def test_partial_wrappers_meet_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(html_text, "FAN_IN", 2)
    monkeypatch.setattr(html_text, "HOSTS", 2)
    rng = random.Random(6)
    rows, want = [], {}
    for k in range(90):
        text = words(rng, 20)
        rows.append((k, f"http://h{k % 5}.org/", furniture(rng, f"<article><p>{text}</p></article>")))
        want[k] = text
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(9)
    assert {r["page_id"]: r["text"] for r in html_text.extract(frame).collect()} == want
