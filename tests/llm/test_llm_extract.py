"""Main-text extraction: held-out pages against their article element, other furniture, broken markup."""

import html as markup
import itertools
import math
import random
import re

import numpy as np
import pytest
from lantern.llm import boosting, extract

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def trees(spark):
    return extract.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    return " ".join(markup.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split())


def test_held_out_pages(spark, trees):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").where("page_id >= 1000 AND html LIKE '%</article>%'")
    rows = extract.extract(pages, trees).join(pages.select("page_id", "html"), "page_id").collect()
    right = [r.text == article(r.html) and r.n_chars == len(r.text) for r in rows]
    assert len(rows) > 1000 and np.mean(right) > 0.995


def test_other_furniture(trees):
    body = "This is the first paragraph of a story, and it is long enough. "
    page = f"""<html><head><title>T &amp; t</title><style>p{{}}</style><script>if (a < b) document.write("<p>no</p>")</script></head><body>
    <header class="site-header"><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies, do you agree?</p></div>
    <article><h1>Head&nbsp;line</h1><p>{body * 3}<b>bo</b>ld &lt;tag&gt;</p>
    <div class="advert"><p>Buy this now.</p></div><p>{body}<br>After a break<p>Unclosed, one more.
    <ul><li>An item of the story, which says a good deal</li></ul></article>
    <aside><p>Aside text that is off.</p></aside><form><label>Mail</label><input><button>Go</button></form>
    <section id="comments"><div class="comment"><p>I disagree, said a reader.</p></div></section>
    <footer>&copy; 2020 All rights</footer></body></html>"""
    got = extract.main_text(page, trees)
    want = f"Head line {body * 3}bold <tag> {body}After a break Unclosed, one more. An item of the story, which says a good deal"
    assert got == " ".join(want.split())


def test_odd_pages(spark, trees):
    rows = [(1, None), (2, ""), (3, "plain text,\n no markup"), (4, "<"), (5, "<article><p>a<p>b"), (6, "<article><p>" + "word " * 200_000), (6, "<div " * 3000),
            (None, "<!-- x"), (7, "<article><p>" + "<div>" * 5000 + "deep"), (8, "<p a=\"x>unclosed quote</p>")]
    pages = spark.createDataFrame([(k, "u", h, "t", 3) for k, h in rows], "page_id long, url string, html string, text string, key int")
    got = extract.extract(pages, trees).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[None] == "" and by[3] == "plain text, no markup" and by[5] == "a b"
    assert extract.extract(pages.limit(0), trees).collect() == []
    none = extract.fit(pages.limit(0))
    assert extract.main_text("<div>kept</div>", none) in ("", "kept")


def test_decoding_is_the_best_allowed_choice():
    draw = random.Random(1)
    for _ in range(60):
        page = extract.Page()
        for i in range(1, 8):
            page.tags.append("div")
            page.parents.append(draw.randrange(i))
            page.tokens.append(())
        chance = [draw.uniform(0.05, 0.95) for _ in page.tags]
        keep = extract.decode(page, np.array(chance))
        score = lambda k: sum(math.log(p if x else 1 - p) for p, x in zip(chance[1:], k[1:]))
        allowed = [
            k for k in itertools.product([True, False], repeat=8)
            if k[0] and all(not k[i] or k[page.parents[i]] for i in range(1, 8))
        ]
        assert score(keep) == pytest.approx(max(map(score, allowed)))


def test_trees_learn():
    draw = np.random.default_rng(3)
    rows = draw.random((4000, 5))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 3] > 0.3)).astype(float)
    made = boosting.fit(rows[:3000], labels[:3000])
    assert ((made.predict(rows[3000:]) > 0.5) == labels[3000:]).mean() > 0.95
