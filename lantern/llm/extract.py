"""Main text of web pages by gradient-boosted trees over DOM nodes (operator 6).

Every element gets features (subtree density, attribute tokens, depth, siblings) and, from boosted trees,
a probability that it belongs to the article. Decoding chooses the most probable set of elements in which
nothing below a rejected element is kept.
"""

from __future__ import annotations

import html as markup
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm import boosting
from lantern.llm.texts import map_texts, sampled

# pages (about so many, by hash) on which the trees are fitted; every page is extracted
FIT_PAGES = 400

# Kinds of elements, and words in class, id and role attributes that tell what one is for.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
HIDDEN = frozenset("head title noscript template iframe object svg canvas math select textarea button input datalist audio video map".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
TAGS = {
    "menu": frozenset("nav menu".split()),
    "frame": frozenset("header footer aside dialog".split()),
    "form": frozenset("form fieldset label".split()) | HIDDEN,
    "article": frozenset("article main".split()),
    "text": frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd dt td".split()),
    "list": frozenset("ul ol dl table li tr".split()),
    "box": frozenset("div section body html center".split()),
    "link": frozenset("a".split()),
}
WORDS = {
    "menu": frozenset("nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs toolbar skip".split()),
    "frame": frozenset("header masthead footer foot copyright legal sidebar side rail aside widget widgets topbar bottombar".split()),
    "advert": frozenset("ad ads adv advert advertisement adverts adsense banner sponsor sponsored promo promotion outbrain taboola dfp".split()),
    "notice": frozenset("cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall dialog toast warning".split()),
    "form": frozenset("form search login signin signup register contact captcha feedback".split()),
    "comment": frozenset("comment comments reply replies disqus respond discussion commentlist reader readers".split()),
    "related": frozenset("share sharing social related recommended popular trending tags follow more".split()),
    "article": frozenset("article content main post entry story body text page hentry".split()),
}
REJECTED = ("menu", "frame", "advert", "notice", "form", "comment", "related")

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TOKEN = re.compile(r"[a-z]+")
MARKS = re.compile(r"[.,;:!?]")


@dataclass
class Page:
    """Elements in page order: tag, parent, attribute tokens; and the text runs with their element.
    A run of a block boundary has an empty text."""

    tags: list = field(default_factory=lambda: ["html"])
    parents: list = field(default_factory=lambda: [-1])
    tokens: list = field(default_factory=lambda: [()])
    runs: list = field(default_factory=list)
    owners: list = field(default_factory=list)


def parse(html: str) -> Page:
    """The elements of a page, forgiving about what is not closed; scripts, styles and comments are gone."""
    page = Page()
    opened, at = [0], 0

    def run(text: str) -> None:
        page.runs.append(text)
        page.owners.append(opened[-1])

    for piece in PIECE.finditer(html):
        if piece.start() > at:
            run(markup.unescape(html[at : piece.start()]))
        at = piece.end()
        tag = (piece["tag"] or piece["tag2"] or "").lower()
        if not tag:
            continue
        closing, attrs = piece["end"] or piece["end2"], piece["attrs"] or piece["attrs2"] or ""
        if tag not in INLINE:
            run("")
        if closing:
            for depth in range(len(opened) - 1, 0, -1):
                if page.tags[opened[depth]] == tag:
                    del opened[depth:]
                    break
            if tag not in INLINE:
                run("")
            continue
        if tag in ("html", "body") and tag in page.tags:
            continue
        if tag in CLOSES_P or tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
            for depth in range(len(opened) - 1, 0, -1):
                open_tag = page.tags[opened[depth]]
                if open_tag == tag and tag not in CLOSES_P or open_tag == "p" and tag in CLOSES_P:
                    del opened[depth:]
                    break
                if open_tag in ("div", "section", "article", "ul", "ol", "dl", "table", "td", "th", "main", "body", "aside", "nav", "footer", "header", "form"):
                    break
        if tag == "body" and page.tags[opened[-1]] == "head":
            opened.pop()
        if tag == "br" or tag in VOID:
            continue
        words: tuple = ()
        if "=" in attrs:
            words = tuple(TOKEN.findall(" ".join("".join(found) for found in NAMES.findall(attrs)).lower()))
        page.tags.append(tag)
        page.parents.append(opened[-1])
        page.tokens.append(words)
        if not attrs.endswith("/"):
            opened.append(len(page.tags) - 1)
    if at < len(html):
        run(markup.unescape(html[at:]))
    return page


FEATURES = [f"tag {k}" for k in TAGS] + [f"word {k}" for k in WORDS] + [
    "depth", "sibling", "siblings", "alike", "chars", "share", "links", "marks", "elements", "paragraphs", "inside", "holds", "page has",
]
KIND_TAGS, KIND_WORDS = list(TAGS.items()), list(WORDS.items())


def describe(page: Page) -> np.ndarray:
    """A feature vector per element, from one walk down and one up the tree."""
    n = len(page.tags)
    parents = page.parents
    depth, inside = [0] * n, [0] * n
    chars, links, marks, elements, paragraphs, holds, children = ([0] * n for _ in range(7))
    for text, owner in zip(page.runs, page.owners):
        if text:
            chars[owner] += len(text)
            marks[owner] += len(MARKS.findall(text))
    kinds: dict[tuple[int, str], int] = {}
    place = [0] * n
    for i in range(1, n):
        up = parents[i]
        depth[i] = depth[up] + 1
        inside[i] = inside[up] or page.tags[up] in TAGS["article"]
        place[i] = children[up]
        children[up] += 1
        kinds[up, page.tags[i]] = kinds.get((up, page.tags[i]), 0) + 1
    for i in range(n - 1, 0, -1):
        up, tag = parents[i], page.tags[i]
        links[i] = chars[i] if tag == "a" else links[i]
        chars[up] += chars[i]
        links[up] += links[i]
        marks[up] += marks[i]
        elements[up] += elements[i] + 1
        paragraphs[up] += paragraphs[i] + (tag == "p")
        holds[up] |= holds[i] or tag in TAGS["article"]
    has = int(any(tag in TAGS["article"] for tag in page.tags))
    rows = []
    whole = max(1, chars[0])
    for i, (tag, tokens) in enumerate(zip(page.tags, page.tokens)):
        row = [tag in some for _, some in KIND_TAGS]
        row += [any(t in some for t in tokens) for _, some in KIND_WORDS] if tokens else [False] * len(KIND_WORDS)
        size = max(1, chars[i])
        row += [
            depth[i], place[i], children[parents[i]] if i else 1, kinds.get((parents[i], tag), 1), chars[i], chars[i] / whole,
            links[i] / size, marks[i] / size, elements[i], paragraphs[i], inside[i], holds[i], has,
        ]
        rows.append(row)
    return np.array(rows, np.float64)


INDEX = {name: i for i, name in enumerate(FEATURES)}


def teach(page: Page, features: np.ndarray) -> np.ndarray:
    """Labels for fitting: an element is rejected for its tag, for an attribute token, for lying outside an
    article where the page has one, or as a short list of links; and with whatever it lies in."""
    keep = np.ones(len(page.tags))
    for i, row in enumerate(features):
        if i and not keep[page.parents[i]]:
            keep[i] = 0
            continue
        get = lambda name: row[INDEX[name]]  # noqa: B023, E731
        if page.tags[i] in ("html", "body"):
            continue
        telling = any(get(f"word {k}") for k in REJECTED) and not (get("word article") and get("share") > 0.5)
        outside = get("page has") and not get("inside") and not get("holds") and not get("tag article")
        linked = get("links") > 0.6 and (get("tag list") or get("tag box")) and get("chars") < 400
        if get("tag menu") or get("tag frame") or get("tag form") or (telling and page.tags[i] not in ("article", "main")) or outside or linked:
            keep[i] = 0
    return keep


def varied(html: str, draw: random.Random) -> str:
    """A page with furniture of other kinds put in, so that the trees also see what these pages lack."""
    words = re.sub(r"<[^>]*>", " ", html).split()[50:250] or ["word"]
    some = lambda n: " ".join(draw.choices(words, k=n))
    name = draw.choice(["class", "id"])
    link = lambda: f'<li><a href="/x">{some(2)}</a></li>'
    box = lambda kind: f'<div {name}="{draw.choice(sorted(WORDS[kind]))}"><p>{some(draw.randrange(3, 40))}</p></div>'
    furniture = [
        lambda: f"<aside><h3>{some(2)}</h3><p>{some(draw.randrange(5, 60))}</p></aside>",
        lambda: f"<header><h2>{some(4)}</h2><p>{some(6)}</p></header>",
        lambda: f"<form><label>{some(2)}</label><input name=q><button>{some(1)}</button></form>",
        lambda: f"<ul>{''.join(link() for _ in range(draw.randrange(3, 9)))}</ul>",
        *[lambda kind=kind: box(kind) for kind in REJECTED],
        lambda: f'<section {name}="comments">' + "".join(f'<div class="comment"><p>{some(draw.randrange(4, 60))}</p></div>' for _ in range(3)) + "</section>",
    ]
    if draw.random() < 0.4:  # a short article
        head, mark, rest = html.partition("</p>" if draw.random() < 0.5 else "</h1>")
        html = head + mark + rest[max(0, rest.find("</article>")) :] if mark and "</article>" in rest else html
    for _ in range(draw.randrange(0, 6)):
        place = draw.choice(["</article>", "<article>", "</body>", "</p><p>"])
        extra = draw.choice(furniture)()
        before, mark, after = html.partition(place)
        if mark:
            html = before + (extra + mark if place.startswith("</a") or place == "</body>" else "</p>" + extra + "<p>" if place == "</p><p>" else mark + extra) + after
    holder = draw.choice(["article", "article", "main", "div class=content", "div id=post", "section"])
    return html.replace("<article>", f"<{holder}>").replace("</article>", f"</{holder.split()[0]}>")


def fit(pages: DataFrame, key: str = "page_id", html: str = "html") -> boosting.Trees:
    """Trees fitted on about ``FIT_PAGES`` pages, chosen by hash, as they are and varied. Without pages all
    elements are kept."""
    chosen = sampled(pages.where(F.col(html).isNotNull() & (F.length(html) < 1 << 20)), FIT_PAGES, 3, key, html)
    draw, rows, labels = random.Random(6), [np.zeros((0, len(FEATURES)))], [np.zeros(0)]
    for row in sorted(r[0] for r in chosen.select(html).collect()):
        for text in (row, varied(row, draw), varied(row, draw)):
            page = parse(text)
            features = describe(page)
            rows.append(features)
            labels.append(teach(page, features))
    return boosting.fit(np.concatenate(rows), np.concatenate(labels))


def decode(page: Page, chance: np.ndarray) -> list[bool]:
    """Which elements are kept: the most probable choice in which no element below a rejected one is.

    From the leaves up: an element's best score if it is rejected (with all below) and if it is kept (with
    the better choice for each child); then from the root, which is kept, down.
    """
    chance = np.clip(chance, 1e-6, 1 - 1e-6)
    kept, lost = np.log(chance).tolist(), np.log(1 - chance).tolist()
    for i in range(len(page.tags) - 1, 0, -1):
        up = page.parents[i]
        kept[up] += max(kept[i], lost[i])
        lost[up] += lost[i]
    keep = [True] * len(page.tags)
    for i in range(1, len(page.tags)):
        keep[i] = keep[page.parents[i]] and (kept[i] > lost[i] or page.tags[i] == "body")
    return keep


def main_text(html: str, trees: boosting.Trees) -> str:
    """The text of the kept elements, in page order; white space is one space, blocks are apart by one."""
    page = parse(html)
    if len(page.tags) == 1:
        return " ".join("".join(r or " " for r in page.runs).split())
    keep = decode(page, trees.predict(describe(page)))
    hidden = [tag in HIDDEN for tag in page.tags]
    return " ".join("".join((r or " ") if keep[o] and not hidden[o] else "" if r else " " for r, o in zip(page.runs, page.owners)).split())


def extract(pages: DataFrame, trees: boosting.Trees, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` of every page; a null page is an empty one and has an empty
    text. Whole pages are parsed, one after the other; repeated rows give repeated results; extra
    columns are left out; an empty table gives an empty table.
    """
    sent = pages.sparkSession.sparkContext.broadcast(trees)
    packed = pages.select(
        F.struct(F.col(key).cast("bigint").alias("id"), F.col(url).cast("string").alias("url")).alias("key"),
        F.coalesce(F.col(html), F.lit("")).alias("text"),
    )
    arrow = pa.schema([("key", pa.struct([("id", pa.int64()), ("url", pa.string())])), ("main", pa.string())])
    made = map_texts(
        packed, lambda: lambda page: (main_text(page, sent.value),), "key struct<id: bigint, url: string>, main string", arrow
    )
    return made.select(
        F.col("key.id").alias(key), F.col("key.url").alias(url), F.col("main").alias("text"), F.char_length("main").cast("bigint").alias("n_chars")
    )


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, fit(pages))
