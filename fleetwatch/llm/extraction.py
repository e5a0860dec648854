"""Main text of web pages: a conditional random field labels the leaf blocks of the DOM, Viterbi decodes them.

A leaf block is a run of text that no block element begins or ends in; scripts, styles, comments, the head and other
parts that are never shown hold none. A head ends where HTML says, with or without its end tag. A block's features are the tags and attribute words of its ancestors and its own text.
The field is trained on labelled pages: layouts put together from parts of known role (training_pages), filled with
words of the corpus at hand, so the labels are certain and the text is of the right kind.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm import crf
from fleetwatch.llm.support import pieces

#: Bounds of the training: pages whose words fill the layouts, words taken from each, layouts built.
SAMPLE_PAGES = 200
SAMPLE_WORDS = 400
LAYOUTS = 600

_VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style head title template noscript iframe canvas audio video datalist".split())
#: Parts of drawings and formulas that are never shown; the rest of their text is.
_UNSEEN_IN = {"svg": frozenset(("desc", "metadata")), "math": frozenset(("annotation", "annotation-xml"))}
#: Start tags that leave an open head open, and end tags that end it; HTML lets </head> be left out.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_ENDS_HEAD = frozenset(("body", "html", "br"))
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img object param tspan textpath "
    "math semantics annotation annotation-xml mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot mstyle merror mpadded mphantom menclose munder mover munderover mmultiscripts mprescripts mtable mtr mtd maction".split()
)
#: An opening tag that ends an open element of the same kind, up to the named containers.
_CLOSES = {"p": ({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "body", "aside", "nav", "footer", "header", "main", "form"})}
_CLOSES |= {t: ({t}, {"ul", "ol", "menu"}) for t in ("li",)}
_CLOSES |= {t: ({"dt", "dd"}, {"dl"}) for t in ("dt", "dd")}
_CLOSES |= {t: ({"td", "th"}, {"tr", "table"}) for t in ("td", "th")}
_CLOSES |= {"tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"})}
_ENDS_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

_TAGS = "nav header footer aside form article main section h1 h2 h3 h4 h5 h6 p li ul ol table td figure figcaption blockquote pre dl button select textarea label fieldset address details dialog a".split()
_BIT = {t: i for i, t in enumerate(_TAGS)}
#: Words in class, id, role and aria-label, by what they say of an element.
_WORDS = {
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs tabs toolbar topbar pagination pager toc skip",
    "head": "header masthead banner branding logo top",
    "foot": "footer copyright contentinfo colophon legal imprint bottom",
    "side": "sidebar aside widget widgets related recommend recommended recommendations complementary rail more popular trending",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion dfp adsense",
    "notice": "notice cookie cookies consent gdpr alert alerts popup modal newsletter subscribe subscription paywall dialog overlay warning",
    "comment": "comment comments reply replies respond discussion disqus",
    "form": "form search login signup signin register searchbox contact",
    "share": "share sharing social follow tags tagcloud meta byline author",
    "main": "main content article post entry story body text maincontent articlebody prose page",
}
_WORD_BIT = {w: len(_TAGS) + i for i, ws in enumerate(_WORDS.values()) for w in ws.split()}
_HIDDEN = len(_TAGS) + len(_WORDS)
N_BITS = _HIDDEN + 1
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


def _mask(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    bits = 1 << _BIT[tag] if tag in _BIT else 0
    for name, value in attrs:
        if name in ("class", "id", "role", "aria-label") and value:
            for word in _SPLIT.split(value):
                at = _WORD_BIT.get(word.lower())
                if at is not None:
                    bits |= 1 << at
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and "display:none" in value.replace(" ", "")):
            bits |= 1 << _HIDDEN
    return bits


class _Blocks(HTMLParser):
    """Collects leaf blocks: text, features of all ancestors, characters inside links, and a label if one is given."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # tag, features of it and its ancestors, labelled as main
        self.open: Counter = Counter()
        self.text: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, int, int, bool]] = []

    def flush(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((text, self.own[0], self.linked, self.own[1]))
            self.text, self.linked = [], 0

    def _pop(self, at: int):
        for tag, _, _ in self.stack[at:]:
            self.open[tag] -= 1
        del self.stack[at:]

    def _end_head(self):
        if self.stack and self.stack[-1][0] == "head":
            self._pop(len(self.stack) - 1)

    def _close(self, tags, stop):
        if not any(self.open[t] for t in tags):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at][0]
            if tag in tags:
                self._pop(at)
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag not in _IN_HEAD:
            self._end_head()
        if tag not in _INLINE:
            self.flush()
            if tag in _ENDS_P:
                self._close(*_CLOSES["p"])
        if tag in _CLOSES and tag != "p":
            self._close(*_CLOSES[tag])
        if tag in _VOID:
            return
        _, bits, main = self.stack[-1] if self.stack else ("", 0, False)
        bits |= _mask(tag, attrs) if attrs else (1 << _BIT[tag] if tag in _BIT else 0)
        if attrs:
            mark = dict(attrs).get("data-label")
            main = main if mark is None else mark == "main"
        self.stack.append((tag, bits, main))
        self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        if tag not in _IN_HEAD:
            self._end_head()
        if tag not in _INLINE:
            self.flush()

    def handle_endtag(self, tag):
        if tag in _ENDS_HEAD:
            self._end_head()
        if tag not in _INLINE:
            self.flush()
        if not self.open[tag]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._pop(at)
                return

    def handle_data(self, data):
        if self.open["head"] and data.strip(" \t\n\f\r"):
            self._end_head()
        if any(self.open[t] for t in _UNSEEN) or any(self.open[t] and any(self.open[u] for u in inside) for t, inside in _UNSEEN_IN.items()):
            return
        if not self.text:
            self.own = self.stack[-1][1:] if self.stack else (0, False)
            if data.isspace():
                return
        self.text.append(data)
        if self.open["a"]:
            self.linked += len(data)

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)


def leaf_blocks(html: str | None) -> list[tuple[str, int, int, bool]]:
    """(text, features of ancestors as bits, characters in links, labelled as main) of the blocks in page order."""
    if not html:
        return []
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


N_TEXT = 10
N_FEATURES = N_BITS + N_TEXT


def block_features(blocks: list[tuple[str, int, int, bool]]) -> np.ndarray:
    bits = np.array([b[1] for b in blocks], np.int64)
    x = np.empty((len(blocks), N_FEATURES))
    x[:, :N_BITS] = (bits[:, None] >> np.arange(N_BITS)) & 1
    own = x[:, N_BITS:]
    for row, (text, _, linked, _) in zip(own, blocks, strict=True):
        n = len(text)
        words = text.count(" ") + 1
        row[:] = (np.log(n), np.log(words), min(1.0, linked / n), n / words > 12, text[-1] in ".!?", "©" in text, text[0].isupper(), words < 4, words > 15, 1.0)
    return x


def decode(model: crf.Model, pages: list[str | None]) -> list[str]:
    """Main text of each page: its main blocks, joined by one space."""
    found = [leaf_blocks(p) for p in pages]
    flat = [b for blocks in found for b in blocks]
    if not flat:
        return [""] * len(pages)
    labels = crf.viterbi(model, model.scores(block_features(flat)), np.array([len(b) for b in found]))
    out, at = [], 0
    for blocks in found:
        out.append(" ".join(b[0] for b, y in zip(blocks, labels[at : at + len(blocks)], strict=True) if y))
        at += len(blocks)
    return out


def training_pages(words: list[str], n: int, seed: int = 7) -> list[str]:
    """Labelled pages: layouts of main and other parts; data-label says which, and is no feature."""
    pick = random.Random(seed)
    words = words or ["text"]

    def some(low, high):
        return " ".join(pick.choice(words) for _ in range(pick.randint(low, high)))

    def attr(*names):
        name = pick.choice(names)
        return pick.choice([f'class="{name}"', f'id="{name}"', f'class="x1 {name}-box"'])

    def links(low, high):
        items = [f'<a href="/{i}">{some(1, 3)}</a>' for i in range(pick.randint(low, high))]
        return pick.choice([lambda: "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", lambda: " ".join(items), lambda: "".join(f"<p>{i}</p>" for i in items)])()

    def prose(low, high):
        out = []
        for _ in range(pick.randint(low, high)):
            text = some(1, 60) + pick.choice([".", "", "!"])
            kinds = ["<p>{}</p>"] * 6 + ["<p>{}", "<p><b>{}<br>", "<h2>{}</h2>", "<h3>{}</h3>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<pre>{}</pre>", "<div>{}</div>", "<table><tr><td>{}</td></tr></table>", "<figure><figcaption>{}</figcaption></figure>", '<p><a href="#">{}</a></p>']
            out.append(pick.choice(kinds).format(text))
        return "".join(out)

    def bad(tag, body, attributes=""):
        return f'<{tag} {attributes} data-label="other">{body}</{tag}>'

    def other():
        text = lambda: pick.choice([some(1, 4), some(4, 20), links(1, 6), f"<p>{some(2, 30)}.</p>", f"<h3>{some(1, 3)}</h3><p>{some(3, 25)}.</p>"])
        return pick.choice(
            [
                lambda: bad("nav", links(2, 8)),
                lambda: bad(pick.choice(["div", "ul"]), links(2, 8), attr("menu", "nav", "navbar", "breadcrumb")),
                lambda: bad("header", pick.choice([some(1, 5), links(1, 4), f"<h1>{some(1, 4)}</h1>"])),
                lambda: bad("div", text(), attr("header", "masthead", "banner", "logo")),
                lambda: bad("footer", pick.choice(["&copy; ", ""]) + text()),
                lambda: bad("div", "&copy; " + text(), attr("footer", "copyright", "legal")),
                lambda: bad("aside", text()),
                lambda: bad("div", text(), attr("sidebar", "related", "widget", "recommended", "popular")),
                lambda: bad(pick.choice(["div", "p", "section"]), text(), attr("ad", "ads", "advert", "sponsored", "promo")),
                lambda: bad(pick.choice(["div", "section"]), text(), attr("cookie", "notice", "consent", "popup", "newsletter", "alert")),
                lambda: bad(pick.choice(["div", "section", "ol"]), "".join(bad("div", f"<p>{some(2, 40)}.</p>", attr("comment", "reply")) for _ in range(pick.randint(1, 5))), attr("comments", "discussion", "respond")),
                lambda: bad("form", f"<label>{some(1, 3)}</label><input><select><option>{some(1, 2)}</select><button>{some(1, 2)}</button>"),
                lambda: bad("div", text(), attr("login", "search", "share", "social", "tags")),
                lambda: bad("div", text(), 'hidden=""'),
                lambda: bad("div", text(), f'role="{pick.choice(["navigation", "banner", "contentinfo", "complementary", "alert", "dialog", "search"])}"'),
            ]
        )()

    def page():
        title = f"<h1>{some(1, 10)}</h1>"
        inside = "".join(prose(1, 5) + (other() if pick.random() < 0.25 else "") for _ in range(pick.randint(1, 3)))
        head = pick.choice([title, title, "", f"<header>{title}</header>"])
        shell = pick.choice(
            [lambda b: f'<article data-label="main">{b}</article>'] * 4
            + [
                lambda b: f'<main data-label="main">{b}</main>',
                lambda b: f'<main><article data-label="main">{b}</article></main>',
                lambda b: f'<div {attr("content", "post", "entry", "story", "article")} data-label="main">{b}</div>',
                lambda b: f'<section data-label="main">{b}</section>',
                lambda b: f'<div data-label="main">{b}</div>',
            ]
        )
        body = [other() for _ in range(pick.randint(0, 4))] + ([shell(head + inside)] if pick.random() < 0.95 else []) + [other() for _ in range(pick.randint(0, 4))]
        return "<html><head><title>" + some(1, 5) + "</title></head><body>" + "".join(body) + "</body></html>"

    return [page() for _ in range(n)]


def train_extraction(words: list[str], layouts: int = LAYOUTS) -> crf.Model:
    found = [b for b in map(leaf_blocks, training_pages(words, layouts)) if b]
    flat = [b for blocks in found for b in blocks]
    return crf.train(block_features(flat), np.array([int(b[3]) for b in flat]), np.array([len(b) for b in found]))


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", sample_pages: int = SAMPLE_PAGES, sample_words: int = SAMPLE_WORDS, layouts: int = LAYOUTS) -> crf.Model:
    """Train on `layouts` labelled layouts filled with words of at most sample_pages pages (first in the order of a hash
    of the key), at most sample_words from each. Without pages one filler word serves."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [" ".join(" ".join(b[0] for b in leaf_blocks(p)).split()[:sample_words]) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["words"])

    sample = pages.select(F.col(html).cast("string").alias("html"), F.xxhash64(F.col(key).cast("string")).alias("h")).where("html IS NOT NULL")
    sample = sample.orderBy("h", F.crc32(F.col("html").cast("binary"))).limit(sample_pages).select("html")
    found = sorted(r["words"] for r in sample.mapInArrow(words, "words string").collect())
    return train_extraction([w for text in found for w in text.split()], layouts)


def extract(pages: DataFrame, model: crf.Model, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text (empty if the page is null, empty or has no main block) and n_chars of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            texts = decode(shared.value, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["key", "url", "text", "n_chars"])

    narrow = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return narrow.mapInArrow(run, "key long, url string, text string, n_chars long")
