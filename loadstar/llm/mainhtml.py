"""Main text of HTML pages by a linear-chain conditional random field.

A page is the sequence of its leaf blocks; each is main text or not. The
field's weights belong to features of a block (tags and names of the elements
it stands in, its length, links, punctuation) and to pairs of neighbouring
labels (apart for neighbours in one container). They are fitted to labelled
pages by maximum likelihood, and a page is decoded by Viterbi.

Labelled pages are those that mark their own article (``article``, ``main``,
``itemprop=articleBody``): a bounded sample of the table. Since such marks
alone would be learned by heart, each sampled page is also dressed anew in
random layouts, with the same text under other tags and names and with menus,
notices, forms, comments and adverts of a page around and inside it, whose
labels are known as they are made.
"""

from __future__ import annotations

import html as markup
import random
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready
from .htmlblocks import SECTIONS, Block, blocks

# Bounds of the labelled sample: pages, and characters of a page.
SAMPLE_PAGES, SAMPLE_CHARS = 200, 40_000
LAYOUTS, SEED = 4, 20260213
STEPS, RATE, RIDGE = 120, 0.2, 0.3
_ROWS, _CHARS = 1024, 8 << 20

# Names that page authors give to the parts of a page.
PARTS = {
    "main": "article content main post entry story body text prose "
            "post-body article-body entry-content main-content page-content",
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs links "
            "tabs pagination pager toolbar",
    "header": "header masthead top branding logo site-header tagline",
    "footer": "footer bottom copyright legal colophon site-footer imprint",
    "side": "sidebar aside side widget related recommended popular trending "
            "recent tags rail more-stories",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay "
              "message disclaimer newsletter banner warning paywall",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion "
              "adslot ad-container partner",
    "form": "form search login signup subscribe contact register poll",
    "comments": "comment comments reply replies respond discussion feedback "
                "comment-list comment-body thread reader-comments guestbook",
    "share": "share social sharing follow share-buttons",
}
TAGS = {
    "main": "article main section div div div", "menu": "nav nav ul div div",
    "header": "header header div div", "footer": "footer footer div div",
    "side": "aside aside div div section", "notice": "div div section aside "
    "dialog", "advert": "div div aside section ins", "form": "form form div",
    "comments": "section div div ol aside", "share": "div ul div",
}
PHRASES = {
    "menu": "Home|About|Contact|News|Archive|Log in|Products|Blog|Start|"
            "Accueil|Inicio|Kontakt|Next|Previous|Topics",
    "header": "The Daily Page|Your source of news|Skip to content|Welcome",
    "footer": "© 2024 All rights reserved.|Privacy policy|Terms of use|"
              "Imprint|Powered by a content system|Copyright 2019-2025",
    "side": "Related articles|Popular posts|Recent entries|Tags|Most read|"
            "You may also like|Read more|Archive",
    "notice": "We use cookies to improve this site. By going on you accept "
              "them.|Accept all|This page needs a newer browser.|Please turn "
              "off your blocker.|Subscribe to our newsletter today.",
    "advert": "Advertisement|Sponsored|Buy now and save 20 %|Limited offer",
    "form": "Search|Your name|E-mail address|Send|Subscribe|Password|"
            "Leave a message|Submit",
    "comments": "Comments|3 comments|Leave a reply|Reply|Anna wrote on 3 May "
                "2021 at 14:02:|Reader replies|Posted by guest",
    "share": "Share|Tweet|Print|E-mail this|Follow us",
}
SENTENCES = (
    "The river rises in the hills and reaches the sea after two hundred "
    "miles, past towns that have grown along its banks.|It was late when they "
    "came home.|In the second year the yield fell by a third, which the "
    "report puts down to the dry spring and to the price of seed.|Nobody knew "
    "why.|Later studies, among them one with four thousand people, found no "
    "such effect, although the first authors still hold to their view of the "
    "matter.|She opened the door, looked at the letter and sat down.|The "
    "committee will meet again in June to decide on the plan.")


class Model(NamedTuple):
    weights: dict[str, float]             # of a feature, for "main text"
    start: tuple[float, float]
    end: tuple[float, float]
    steps: tuple[tuple[float, ...], tuple[float, ...]]
    # of label pairs (00, 01, 10, 11): other container, same container


def _size(n: int) -> int:
    return next((k for k, most in enumerate((2, 5, 10, 20, 40, 80))
                 if n <= most), 6)


def features(b: Block) -> list[str]:
    """Names of a block's features."""
    words = b.text.count(" ") + 1
    chars = len(b.text)
    link = b.linked / chars
    long = _size(words)
    leaf = b.path[-1][0] if b.path else ""
    last = b.text[-1]
    stop = last in ".!?…。\"”"
    out = ["all", f"words:{long}", f"leaf:{leaf}", f"leaf:{leaf}/{long}",
           f"stop:{stop}/{long}",
           f"link:{0 if not link else 1 if link < .4 else 2}",
           f"commas:{min(3, b.text.count(','))}"]
    if "©" in b.text or "Copyright" in b.text:
        out.append("copyright")
    if "|" in b.text or "·" in b.text or "»" in b.text:
        out.append("separators")
    if sum(map(str.isdigit, b.text[:200])) * 4 > min(chars, 200):
        out.append("digits")
    outer, inner = "", ()
    seen = set()
    for tag, named in b.path:
        if tag in SECTIONS:
            seen.add(f"in:{tag}")
            seen.add(f"in:{outer}/{tag}")
            outer = tag
        elif tag in ("ul", "ol", "dl", "pre", "td", "th"):
            seen.add(f"in:{tag}")
        if named:
            inner = named
            seen.update([f"name:{w}" for w in named])
    out += seen
    out += [f"near:{w}" for w in inner]
    if not inner:
        out.append("unnamed")
    out.append(f"section:{outer}")
    return out


def _box(b: Block) -> tuple:
    """What a block stands in: itself, if it has a name."""
    return b.path if b.path and b.path[-1][1] else b.path[:-1]


# ---------------------------------------------------------------- labels

_OWN = {"nav", "header", "footer", "aside", "form", "dialog", "menu"}


def own_labels(page: list[Block]) -> list[int] | None:
    """Labels that a page's own marks give its blocks, or None if it marks no
    article: main text is what stands in the marked element, but in none of
    its menus, asides, footers and forms (nor under names of such parts)."""
    other = {w for part, ws in PARTS.items() if part != "main"
             for w in ws.replace("-", " ").split()} - {"body", "top", "more",
                                                       "page", "site"}
    out, any_main = [], False
    for b in page:
        label = 0
        for tag, named in b.path:
            if tag in ("article", "main") or "articlebody" in "".join(named):
                label = 1
            elif label and (tag in _OWN - {"header"}
                            or not other.isdisjoint(named)):
                label = 0
                break
        any_main |= bool(label)
        out.append(label)
    return out if any_main else None


def _attrs(rng: random.Random, part: str) -> str:
    name = rng.choice(PARTS[part].split())
    form = rng.random()
    if form < .45:
        return f' class="{name}"'
    if form < .65:
        return f' id="{name}"'
    if form < .8:
        return f' class="c{rng.randrange(99)} {name} box"'
    return ""


class _Page:
    """A page under construction: its markup, and the label of each block."""

    def __init__(self, rng: random.Random, main: list[str], rest: list[str]):
        self.rng, self.main, self.rest = rng, main, rest
        self.html: list[str] = []
        self.labels: list[int] = []

    def put(self, tag: str, text: str, label: int, link: bool = False) -> None:
        text = markup.escape(text)
        if link:
            text = f'<a href="/x">{text}</a>'
        self.html.append(f"<{tag}>{text}</{tag}>")
        self.labels.append(label)

    def phrase(self, part: str) -> str:
        return self.rng.choice(PHRASES[part].split("|"))

    def prose(self) -> str:
        pool = self.rest if self.rng.random() < .4 and self.rest else self.main
        words = self.rng.choice(pool).split()
        return " ".join(words[:self.rng.randint(4, 60)])

    def part(self, part: str) -> None:
        """A part of the page that is not main text."""
        rng = self.rng
        tag = rng.choice(TAGS[part].split())
        attrs = _attrs(rng, part)
        if tag in ("div", "section", "ul", "ol", "ins") and not attrs:
            attrs = f' class="{rng.choice(PARTS[part].split())}"'
        tag = "div" if tag == "ins" else tag
        self.html.append(f"<{tag}{attrs}>")
        item = "li" if tag in ("ul", "ol") else None
        many = {"menu": 5, "header": 1, "footer": 2, "side": 4, "notice": 1,
                "advert": 1, "form": 3, "comments": 4, "share": 3}[part]
        for _ in range(rng.randint(1, many)):
            plain = part in ("comments", "advert", "notice", "side", "footer",
                             "header") and rng.random() < .6
            text = self.prose() if plain else self.phrase(part)
            linked = part in ("menu", "share") or (
                part in ("side", "footer") and rng.random() < .5)
            inner = item or rng.choice(
                {"menu": ["li", "li", "div"], "form": ["label", "div", "p",
                                                       "button"],
                 "comments": ["p", "p", "div", "h3", "blockquote"],
                 "side": ["h3", "li", "p", "h4"], "footer": ["p", "div"],
                 "header": ["div", "p", "h1", "h2"]}.get(part, ["p", "div"]))
            if part == "comments" and rng.random() < .4:
                name = rng.choice(PARTS[part].split())
                self.html.append(f'<div class="{name}">')
                self.put(inner, text, 0)
                self.html.append("</div>")
            else:
                self.put(inner, text, 0, linked)
        self.html.append(f"</{tag}>")

    def article(self) -> None:
        rng = self.rng
        tag = rng.choice(TAGS["main"].split())
        self.html.append(f"<{tag}{_attrs(rng, 'main')}>")
        inner = rng.random() < .3
        if inner:
            self.html.append(f"<div{_attrs(rng, 'main')}>")
        own = list(self.main)
        head = own[0].split()[:rng.randint(2, 10)]
        top = tag in ("article", "main") and rng.random() < .3
        self.html.append("<header>" * top)
        self.put(rng.choice(["h1", "h1", "h2"]), " ".join(head), 1)
        self.html.append("</header>" * top)
        for text in own[:rng.randint(2, 14)]:
            kind = rng.random()
            if kind < .08:
                self.put(rng.choice(["h2", "h3"]),
                         " ".join(text.split()[:rng.randint(1, 8)]), 1)
            elif kind < .16:
                self.html.append("<ul>")
                for _ in range(rng.randint(2, 4)):
                    self.put("li", self.prose(), 1, rng.random() < .1)
                self.html.append("</ul>")
            elif kind < .2:
                self.html.append("<blockquote>")
                self.put("p", self.prose(), 1)
                self.html.append("</blockquote>")
            elif kind < .23:
                self.html.append("<table><tr>")
                for _ in range(3):
                    self.put("td", " ".join(self.prose().split()[:5]), 1)
                self.html.append("</tr></table>")
            elif kind < .35:
                self.part(rng.choice(["advert", "side", "form", "share",
                                      "notice"]))
            self.put(rng.choice(["p", "p", "p", "p", "div"]),
                     text if rng.random() < .7 else self.prose(), 1)
        if rng.random() < .3:
            self.part("comments")
        if inner:
            self.html.append("</div>")
        self.html.append(f"</{tag}>")

    def build(self) -> tuple[str, list[int]]:
        rng = self.rng
        wrap = rng.choice([0, 1, 2])
        self.html.append("<html><body>" + "".join(
            f'<div {rng.choice(["id", "class"])}="'
            f'{rng.choice(["page", "wrapper", "container", "site", "outer"])}">'
            for _ in range(wrap)))
        for part in ("notice", "header", "menu", "advert", "menu", "side"):
            if rng.random() < .55:
                self.part(part)
        self.article()
        for part in ("share", "comments", "advert", "form", "side", "notice",
                     "menu", "footer"):
            if rng.random() < .45:
                self.part(part)
        self.html.append("</div>" * wrap + "</body></html>")
        return "".join(self.html), self.labels


def dressed(rng: random.Random, main: list[str], rest: list[str]
            ) -> tuple[str, list[int]]:
    """A page in a random layout with the given texts, and its labels."""
    return _Page(rng, main, rest).build()


# ------------------------------------------------------------------- fit

def _marginals(main, start, end, steps, same, mask):
    """Marginals of labels (blocks, pages, 2) and of neighbouring label pairs
    (blocks - 1, pages, 2, 2) over all label sequences; ``main`` is each
    block's score for label 1, arrays are (blocks, pages)."""
    top = np.maximum(main, 0)
    emit = np.exp(np.stack([-top, main - top], axis=2))
    move, last = np.exp(steps - steps.max())[same], np.exp(end - end.max())
    fore, back = np.empty_like(emit), np.empty_like(emit)
    fore[0] = np.exp(start - start.max()) * emit[0]
    fore[0] /= fore[0].sum(axis=1, keepdims=True)
    for t in range(1, len(main)):
        f, w = fore[t - 1], move[t]
        nxt = (f[:, :1] * w[:, 0] + f[:, 1:] * w[:, 1]) * emit[t]
        nxt /= nxt.sum(axis=1, keepdims=True)
        fore[t] = np.where(mask[t][:, None], nxt, f)
    back[-1] = last
    for t in range(len(main) - 2, -1, -1):
        g, w = emit[t + 1] * back[t + 1], move[t + 1]
        prev = w[:, :, 0] * g[:, :1] + w[:, :, 1] * g[:, 1:]
        prev /= prev.sum(axis=1, keepdims=True)
        back[t] = np.where(mask[t + 1][:, None], prev, last)
    one = fore * back
    one /= one.sum(axis=2, keepdims=True)
    two = fore[:-1, :, :, None] * move[1:] * (emit[1:] * back[1:])[:, :, None]
    two /= two.sum(axis=(2, 3), keepdims=True)
    return one * mask[:, :, None], two * mask[1:, :, None, None]


def fit(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS,
        rate: float = RATE, ridge: float = RIDGE) -> Model:
    """Maximum likelihood with a ridge penalty, by Adam over all pages. A
    feature that fewer than two pages hold is left out."""
    pages = [(p, y) for p, y in pages if p]
    held: dict[str, int] = {}
    rows = [[features(b) for b in p] for p, _ in pages]
    for page in rows:
        for f in {f for fs in page for f in fs}:
            held[f] = held.get(f, 0) + 1
    index = {f: k for k, f in enumerate(sorted(
        f for f, n in held.items() if n > 1))}
    width, many = max(len(p) for p, _ in pages), len(pages)
    mask = np.zeros((width, many), dtype=bool)
    gold = np.zeros((width, many), dtype="i8")
    same = np.zeros((width, many), dtype="i8")
    at, feat = [], []
    for i, ((p, y), fs) in enumerate(zip(pages, rows)):
        mask[:len(p), i], gold[:len(p), i] = True, y
        same[1:len(p), i] = [_box(a) == _box(b) for a, b in zip(p, p[1:])]
        for j, names in enumerate(fs):
            known = [index[f] for f in names if f in index]
            at += [j * many + i] * len(known)
            feat += known
    at, feat = np.array(at), np.array(feat)
    one_gold = np.eye(2)[gold] * mask[:, :, None]
    two_gold = one_gold[:-1, :, :, None] * one_gold[1:, :, None]
    tail = mask.sum(axis=0) - 1, np.arange(many)
    n = len(index)
    theta, m, v = np.zeros(n + 12), 0.0, 0.0
    for step in range(1, steps + 1):
        main = np.bincount(at, theta[feat], many * width).reshape(width, many)
        one, two = _marginals(main, theta[n:n + 2], theta[n + 2:n + 4],
                              theta[n + 4:].reshape(2, 2, 2), same, mask)
        miss = one - one_gold
        grad = np.empty_like(theta)
        grad[:n] = np.bincount(feat, miss[:, :, 1].reshape(-1)[at], n)
        grad[n:n + 2] = miss[0].sum(axis=0)
        grad[n + 2:n + 4] = miss[tail].sum(axis=0)
        for k in (0, 1):
            grad[n + 4 + 4 * k:n + 8 + 4 * k] = (two - two_gold)[
                same[1:] == k].sum(axis=0).reshape(4)
        grad += ridge * theta
        m = .9 * m + .1 * grad
        v = .99 * v + .01 * grad * grad
        theta = theta - rate * (m / (1 - .9 ** step)) / (
            np.sqrt(v / (1 - .99 ** step)) + 1e-8)
    return Model({f: float(theta[k]) for f, k in index.items()},
                 tuple(theta[n:n + 2].tolist()),
                 tuple(theta[n + 2:n + 4].tolist()),
                 (tuple(theta[n + 4:n + 8].tolist()),
                  tuple(theta[n + 8:].tolist())))


def train(pages: DataFrame, html_col: str = "html",
          sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS,
          layouts: int = LAYOUTS, seed: int = SEED) -> Model:
    """Model fitted to at most ``sample_pages`` pages of at most
    ``sample_chars`` characters that mark their own article (those with the
    smallest hashes of their markup), and to ``layouts`` new layouts of each.
    A table without such pages leaves layouts of a few fixed sentences."""
    text = F.col(html_col).cast("string")
    marked = pages.select(text.alias("h"), F.xxhash64(text).alias("k")).filter(
        F.col("h").rlike(r"(?i)<(article|main)[\s>]|itemprop=.?articleBody")
        & (F.length("h") <= sample_chars))
    # hashes first, so that no task sends pages which are not taken
    least = marked.select("k").distinct().orderBy("k").limit(
        sample_pages).agg(F.max("k")).first()[0]
    rows = [] if least is None else marked.filter(
        F.col("k") <= least).dropDuplicates(["k"]).orderBy("k").collect()
    known = []
    for r in rows:
        page = blocks(r["h"])
        labels = own_labels(page)
        if labels is not None:
            known.append((page, labels))
    sentences = SENTENCES.split("|")
    source = [([b.text for b, y in zip(p, ys) if y],
               [b.text for b, y in zip(p, ys) if not y]) for p, ys in known]
    rng = random.Random(seed)
    source += [(rng.sample(sentences, 5), sentences[:2])
               for _ in range(max(60, len(source) // 4))]
    made = []
    for main, rest in source:
        for _ in range(layouts):
            # a page's blocks by its layout; texts are cut to a bounded size
            page, labels = dressed(rng, [" ".join(t.split()[:120])
                                         for t in main[:20]], rest[:20])
            found = blocks(page)
            assert len(found) == len(labels)
            made.append((found, labels))
    return fit([(p[:80], y[:80]) for p, y in known] + made)


# ---------------------------------------------------------------- decode

def decode(page: list[Block], model: Model) -> list[int]:
    """The most likely labels of a page's blocks (Viterbi)."""
    if not page:
        return []
    weigh = model.weights.get
    back: list[tuple[int, int]] = []
    no, yes = model.start
    box = None
    for k, b in enumerate(page):
        s = sum([weigh(f, 0.0) for f in features(b)])
        here = _box(b)
        if k:
            w = model.steps[here == box]
            a, c = no + w[0], yes + w[2]
            d, e = no + w[1], yes + w[3]
            back.append((int(c > a), int(e >= d)))
            no, yes = max(a, c), max(d, e)
        yes += s
        box = here
    label = int(yes + model.end[1] >= no + model.end[0])
    out = [label]
    for pair in reversed(back):
        label = pair[label]
        out.append(label)
    return out[::-1]


def main_text(html: str | None, model: Model, memo: dict | None = None) -> str:
    """Main text of one page: its blocks of main text, one a line."""
    page = blocks(html, memo)
    return "\n".join([b.text for b, y in zip(page, decode(page, model)) if y])


def _texts(model: Model):
    def run(batches):
        memo: dict = {}
        for b in batches:
            texts, at, held = [], 0, 0
            for k, page in enumerate(b.column(1)):
                texts.append(main_text(page.as_py(), model, memo))
                held += len(texts[-1])
                if len(texts) >= _ROWS or held >= _CHARS:
                    yield _batch(b.column(0).slice(at, len(texts)), texts)
                    texts, at, held = [], k + 1, 0
            if texts:
                yield _batch(b.column(0).slice(at, len(texts)), texts)
    return run


def _batch(rows: pa.Array, texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [rows, pa.array(texts, pa.string()),
         pa.array([len(t) for t in texts], pa.int64())],
        names=["__kept", "text", "n_chars"])


def extract(pages: DataFrame, model: Model, html_col: str = "html",
            keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every page with ``text`` (its main text, empty
    if there is none) and ``n_chars``.

    * null, empty or textless markup: empty text
    * repeated rows and ids: a row each; null ids and urls stay null
    * very long pages: read whole, in one pass
    * truncated or broken markup: see :func:`loadstar.llm.htmlblocks.blocks`
    * other columns are ignored, whatever their names; an empty table gives
      no rows

    One task reads its pages one by one; nothing is shuffled."""
    python_ready(pages.sparkSession)
    kept = T.StructType([pages.schema[c] for c in keep])
    rows = pages.select(F.struct(*keep).alias("__kept"),
                        F.col(html_col).cast("string").alias("__html"))
    out = rows.mapInArrow(_texts(model), T.StructType([
        T.StructField("__kept", kept), T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType())]))
    return out.select(*[F.col("__kept")[c].alias(c) for c in keep], "text",
                      "n_chars")
