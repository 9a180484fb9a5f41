"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags. Each has features of its ancestors (tags, and
kinds of names in class, id and role) and of its text (length, links, punctuation). The field has two labels, main text
or not; it is trained on labelled pages by gradient of the likelihood (forward-backward) and decoded by Viterbi.
"""

from __future__ import annotations

import html as html_module
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from arkspark.llm.common import only, texts

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace semantics".split())
#: Elements whose text is never part of a block: scripts, styles, forms' controls and what stands in for media; of the first ones the
#: content isn't markup. SILENT ones don't even end a block.
RAW = frozenset("script style textarea title iframe noembed noframes annotation".split())
SILENT = frozenset("script style annotation".split())
DROPPED = RAW | frozenset("head template noscript svg select option datalist button canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BOUNDARY = frozenset("ul ol dl table div section article nav aside header footer main form body html".split())
TAGS = frozenset("article main section nav header footer aside form ul ol li table td th p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption dl dd dt address details div body fieldset".split())
#: Words in class, id and role by the kind of part that they name.
NAMES = {
    word: kind
    for kind, words in {
        "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner",
        "nav": "nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination toolbar tabs toc skip",
        "side": "sidebar side aside widget widgets related recommended recommendations trending popular more complementary rail",
        "comment": "comment comments reply replies disqus discussion respond feedback thread commentlist",
        "foot": "footer foot copyright legal credits colophon contentinfo",
        "head": "header masthead topbar logo branding brand banner tagline",
        "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay dialog newsletter subscribe subscription signup login share sharing social paywall message",
        "content": "article content post entry story body text main prose page maincontent",
    }.items()
    for word in words.split()
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</?[a-zA-Z][^>]*\Z|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    text: str
    features: frozenset[str]


@dataclass(slots=True)
class _Open:
    tag: str
    features: frozenset[str]


def _own_features(tag: str, attributes: str) -> set[str]:
    own = {f"in:{tag}"} if tag in TAGS else set()
    if "=" in attributes:
        for m in _NAMED.finditer(attributes):
            own |= {f"named:{NAMES[p]}" for part in _PARTS.findall(m[1] or m[2] or m[3] or "") if (p := part.lower()) in NAMES}
    return own


def _text_features(text: str, linked: int, tag: str) -> set[str]:
    words = text.count(" ") + 1
    share = linked / len(text)
    return {
        f"is:{tag}",
        "words:" + ("1-2" if words < 3 else "3-5" if words < 6 else "6-11" if words < 12 else "12-24" if words < 25 else "25-"),
        "links:" + ("none" if not linked else "some" if share < 0.5 else "most" if share < 0.9 else "all"),
        "end:" + ("stop" if text[-1] in ".!?…。" else "mark" if text[-1] in ":;," else "none"),
        *(("copyright",) if "©" in text or "(c)" in text.lower() else ()),
    }


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order; character references decoded, runs of white space made one space."""
    blocks: list[Block] = []
    stack = [_Open("", frozenset())]
    pieces: list[str] = []
    linked, in_link, dropped, at = 0, False, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            if text := " ".join("".join(pieces).split()):
                blocks.append(Block(text, stack[-1].features | _text_features(text, min(linked, len(text)), stack[-1].tag)))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if not dropped and raw:
            text = html_module.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                linked += len(text.strip())

    def pop_to(names, barrier: frozenset[str]) -> None:
        nonlocal dropped
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                dropped -= sum(x.tag in DROPPED for x in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in barrier:
                return

    while m := _TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = m[2].lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not m[1]
            elif tag == "br":
                add(" ")
            continue
        if tag in SILENT:
            if not m[1]:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        flush()
        if m[1]:
            in_link = False
            pop_to((tag,), frozenset() if tag in _BOUNDARY else _BOUNDARY)
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "xmp":  # its text is no markup, and shown as it is
            end = re.compile(r"</xmp\b[^>]*>", re.I).search(page, at)
            if not dropped:
                pieces.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
            flush()
            continue
        if tag in _CLOSED_BY:
            pop_to(_CLOSED_BY[tag], _BOUNDARY)
        elif tag == "body":
            pop_to(("head",), frozenset())
        pop_to(("p",), _BOUNDARY)
        if not m[0].endswith("/>"):
            above = stack[-1].features
            dropped += tag in DROPPED
            stack.append(_Open(tag, above | _own_features(tag, m[3])))
    add(page[at:])
    flush()
    return blocks


@dataclass
class FieldModel:
    """Weights of the label "main text" against the other by feature, of the first label, and of label pairs."""

    weights: dict[str, float]
    start: float
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The likeliest labels, by Viterbi; of equally likely ones, main text."""
        get = self.weights.get
        (a, b), (c, d) = self.pairs.tolist()
        back: list[tuple[int, int]] = []
        zero = one = 0.0
        for i, block in enumerate(blocks):
            e = sum(get(f, 0.0) for f in sorted(block.features))
            if not i:
                zero, one = 0.0, self.start + e
                continue
            to0, to1 = (zero + a, one + c), (zero + b, one + d)
            back.append((int(to0[1] >= to0[0]), int(to1[1] >= to1[0])))
            zero, one = max(to0), max(to1) + e
        if not blocks:
            return []
        label = int(one >= zero)
        labels = [bool(label)]
        for k in reversed(back):
            label = k[label]
            labels.append(bool(label))
        return labels[::-1]


def fit_field(pages: list[tuple[list[Block], list[bool]]], l2: float = 1e-3, steps: int = 250) -> FieldModel:
    """Maximum likelihood by Adam; gradients by forward-backward over all pages at once, padded to the longest."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for blocks, _ in pages for b in blocks for f in b.features})
    index = {f: i for i, f in enumerate(names)}
    n, t = len(pages), max(len(b) for b, _ in pages)
    page_of = np.array([p for p, (blocks, _) in enumerate(pages) for b in blocks for _ in b.features])
    place_of = np.array([i for blocks, _ in pages for i, b in enumerate(blocks) for _ in b.features])
    feature_of = np.array([index[f] for blocks, _ in pages for b in blocks for f in sorted(b.features)])
    cell = page_of * t + place_of
    lengths = np.array([len(b) for b, _ in pages])
    inside = np.arange(t) < lengths[:, None]
    gold = np.zeros((n, t), int)
    for p, (_, labels) in enumerate(pages):
        gold[p, : len(labels)] = labels
    gold_pairs = np.array([[((gold[:, :-1] == i) & (gold[:, 1:] == j) & inside[:, 1:]).sum() for j in (0, 1)] for i in (0, 1)])
    x = np.zeros(len(names) + 5)
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        w, start, pairs = x[: len(names)], x[-5], x[-4:].reshape(2, 2)
        e = np.zeros((n, t, 2))
        e[:, :, 1] = np.bincount(cell, w[feature_of], minlength=n * t).reshape(n, t)
        forward, backward = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        forward[:, 0] = e[:, 0] + [0, start]
        for i in range(1, t):
            forward[:, i] = np.where(inside[:, i, None], np.logaddexp(forward[:, i - 1, 0, None] + pairs[0], forward[:, i - 1, 1, None] + pairs[1]) + e[:, i], forward[:, i - 1])
        for i in range(t - 2, -1, -1):
            to = e[:, i + 1] + backward[:, i + 1]
            backward[:, i] = np.where(inside[:, i + 1, None], np.logaddexp(pairs[:, 0] + to[:, 0, None], pairs[:, 1] + to[:, 1, None]), 0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        p1 = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None]) * inside
        joint = np.exp(forward[:, :-1, :, None] + pairs + (e + backward)[:, 1:, None, :] - total[:, None, None, None]) * inside[:, 1:, None, None]
        g = np.zeros_like(x)
        error = (p1 - gold * inside) / n
        g[: len(names)] = np.bincount(feature_of, error.reshape(-1)[cell], minlength=len(names))
        g[-5] = error[:, 0].sum()
        g[-4:] = ((joint.sum(axis=(0, 1)) - gold_pairs) / n).reshape(-1)
        g += l2 * x
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    return FieldModel({f: float(x[i]) for f, i in index.items()}, float(x[-5]), x[-4:].reshape(2, 2).copy())


_MARK = "\ue000"


def labelled_page(rng: random.Random) -> str:
    """A page made by rule: its main text is marked by a private character at the start of each block."""
    pick, often, between = lambda *xs: rng.choice(xs), lambda p: rng.random() < p, rng.randint
    words = lambda low, high: " ".join("x" * between(2, 9) for _ in range(between(low, high)))
    sentence = lambda low, high: words(low, high).capitalize() + pick(".", ".", ".", "!", "?", "")
    link = lambda text: f'<a href="/{words(1, 1)}">{text}</a>'
    links = lambda low, high: "".join(f"<li>{link(words(1, 5))}</li>" for _ in range(between(low, high)))

    def main_block() -> str:
        kind = rng.random()
        text = _MARK + pick(sentence(1, 3), sentence(4, 12), sentence(12, 40), sentence(40, 120), sentence(20, 80))
        if often(0.15):
            text += " " + link(words(1, 4)) + " " + sentence(2, 20)
        if kind < 0.68:
            return f"<p>{'<b>' * often(0.1)}{text}{pick('</p>', '</p>', '')}"
        if kind < 0.78:
            tag = pick("h2", "h3", "h4")
            return f"<{tag}>{_MARK}{words(1, 8).capitalize()}</{tag}>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{_MARK}{pick(sentence(2, 6), sentence(6, 20), link(words(2, 5)) + ' ' + sentence(3, 9))}</li>" for _ in range(between(2, 5))) + "</ul>"
        if kind < 0.91:
            return pick(f"<blockquote><p>{text}</p></blockquote>", f"<blockquote>{text}</blockquote>", f"<pre>{text}</pre>", f"<figure><figcaption>{text}</figcaption></figure>")
        if kind < 0.95:
            return "<table>" + "".join(f"<tr><td>{_MARK}{words(1, 3)}</td><td>{_MARK}{words(1, 6)}</td></tr>" for _ in range(between(1, 3))) + "</table>"
        return f"<div>{text}</div>"

    def advert() -> str:
        return f'<{(t := pick("div", "div", "aside", "section"))} class="{pick("ad", "ads", "advert", "ad-banner", "sponsored", "promo", "advertisement")}">{pick(sentence(3, 20), link(sentence(2, 8)), "<p>" + sentence(3, 25) + "</p>")}</{t}>'

    def notice() -> str:
        return f'<div class="{pick("cookie-notice", "notice", "cookie-banner", "alert", "newsletter", "popup", "consent", "subscribe")}"{pick("", " role=dialog")}>{pick("", "<p>")}{sentence(5, 30)}{pick("", link(words(1, 2)))}</div>'

    def share() -> str:
        return f'<div class="{pick("share", "social", "share-links")}">{pick("<ul>" + links(2, 4) + "</ul>", words(1, 3) + link(words(1, 1)))}</div>'

    def related() -> str:
        return pick(f'<aside class="{pick("related", "sidebar", "widget")}"><h3>{words(1, 3)}</h3><ul>{links(2, 6)}</ul></aside>', f'<div class="{pick("related", "sidebar", "widget", "more-stories")}"><h4>{words(1, 3)}</h4><p>{sentence(4, 30)}</p><ul>{links(1, 5)}</ul></div>', f"<aside><p>{sentence(4, 40)}</p></aside>")

    def comments() -> str:
        name, tag = pick("comments", "comment-list", "discussion", "comment"), pick("div", "section", "ol")
        inner = pick("p", "div", "li")
        each = "".join(f'<div class="{pick("comment", "reply")}"><{inner}>{sentence(3, 60)}</{inner}></div>' if often(0.6) else f"<{inner}>{sentence(3, 60)}</{inner}>" for _ in range(between(1, 4)))
        return f'<{tag} {pick("class", "id")}="{name}"><h3>{words(1, 3)}</h3>{each}</{tag}>'

    def form() -> str:
        return f'<form action="/{words(1, 1)}">{pick("<p>" + sentence(3, 12) + "</p>", "")}<label>{words(1, 3)}</label><input name="q"><button>{words(1, 2)}</button></form>'

    title = words(2, 10).capitalize()
    body = [pick(f"<h1>{_MARK}{title}</h1>", f"<h1>{_MARK}{title}</h1>", f"<header><h1>{_MARK}{title}</h1></header>", "")]
    for _ in range(between(0, 15)):
        body.append(main_block())
        if often(0.07):
            body.append(pick(advert, share, related, notice, form)())
    if often(0.2):
        body.append(pick(share, related, comments)())
    tag, attributes = pick(("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""), ("main", ' id="content"'), ("div", ' class="content"'), ("div", ' id="main-content"'), ("div", ' class="post-body"'), ("section", ' class="entry"'), ("div", ' role="main"'), ("div", ""))
    main = f"<{tag}{attributes}>" + "".join(body) + f"</{tag}>"
    if often(0.3):
        main = f'<{(t := pick("main", "div", "section"))}{pick("", " class=wrapper", " id=page")}>{main}</{t}>'
    before = [pick(f"<nav><ul>{links(2, 8)}</ul></nav>", f'<div class="{pick("menu", "navbar", "nav-links")}"><ul>{links(2, 8)}</ul></div>', f"<header><div>{words(1, 4)}</div><nav>{link(words(1, 2))} {link(words(1, 2))}</nav></header>", f'<div id="header"><p>{sentence(2, 8)}</p><ul>{links(2, 6)}</ul></div>', "")]
    before += [part() for part in (advert, notice, form, related, advert) if often(0.3)]
    after = [part() for part in (comments, related, advert, share, form, notice, comments) if often(0.25)]
    after.append(pick(f"<footer>{sentence(3, 25)}</footer>", f"<footer>&copy; {words(1, 3)} &middot; {sentence(2, 16)}</footer>", f"<footer><ul>{links(1, 5)}</ul><p>&copy; {words(2, 6)}</p></footer>", f'<div class="{pick("footer", "copyright", "site-footer")}"><p>{sentence(3, 20)}</p></div>', ""))
    return f"<html><head><title>{title}</title><style>p{{}}</style></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def labelled_pages(n: int = 400, seed: int = 11) -> list[tuple[list[Block], list[bool]]]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        blocks = leaf_blocks(labelled_page(rng))
        labels = [b.text.startswith(_MARK) for b in blocks]
        out.append(([Block(b.text.lstrip(_MARK), b.features) for b in blocks], labels))
    return out


def main_text(page: str, model: FieldModel) -> str:
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, main in zip(blocks, model.decode(blocks), strict=True) if main)


def _extractor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in texts(batches, "html", 128):
            found = [main_text((p or b"").decode("utf-8", "replace"), shared.value) for p in rows]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract_main_text(pages: DataFrame, model: FieldModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html; other columns are ignored).

    text joins the blocks of main text by an empty line; it is empty for null or empty html and for pages without main
    text. Null ids and urls keep their rows, repeated rows give repeated results, an empty table gives no rows. Whole
    pages are read; broken markup ends blocks where its tags do. Without ``model`` one is trained on pages made by rule.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or fit_field(labelled_pages()))
    return only(pages, page_id="long", url="string", html="string").mapInArrow(_extractor(shared), "page_id long, url string, text string, n_chars long")
