"""A bidirectional LSTM, in numpy, that tells article blocks from the rest of a page.

Each block of a page is a vector: its tag path (tags, class and id parts, hashed), its words
(hashed) and a few numbers (length, link share, place).  The network reads the whole sequence
of a page in both directions, so that a block is judged by what stands around it too.

The network is trained here, from a fixed seed, on ``TRAIN_PAGES`` pages that
:func:`training_page` writes together with their labels; no page of the data is a training row.
"""

from __future__ import annotations

import random
import zlib
from functools import lru_cache

import numpy as np

from .html_blocks import Block, Path, blocks

PATH, WORD, NUMBERS, HIDDEN = 256, 64, 6, 16
TRAIN_PAGES, EPOCHS, BATCH, RATE = 600, 12, 30, 0.01


def _slot(token: str, size: int) -> int:
    return zlib.crc32(token.encode()) % size


@lru_cache(maxsize=50_000)
def _marks(element: str, prefix: str = "") -> int:
    """The slots of an element's tag and marks, as bits."""
    bits = 0
    for x in element.split(" "):
        bits |= 1 << _slot(prefix + x, PATH)
    return bits


def path_features(path: Path) -> int:
    """Bits for the tags and marks on the way down, and once more for the last two elements; kept at the path."""
    if path.features is None:
        new, node = [], path
        while node.marks is None and node.parent is not None:
            new.append(node)
            node = node.parent
        bits = node.marks or 0
        for node in reversed(new):
            node.marks = bits = bits | _marks(node.element)
        path.features = bits
        for k, element in zip(range(2), path):
            path.features |= _marks(element, f"{k}^")
    return path.features


class WordSlots(dict):
    def __missing__(self, word: str) -> int:
        slot = _slot(word.lower(), WORD)
        if len(self) < 200_000:
            self[word] = slot
        return slot


_words = WordSlots()


def vectors(page: list[Block]) -> tuple[list[int], np.ndarray]:
    """The paths' features, and the word and number part of the vectors, of a page's blocks."""
    rest = np.zeros((len(page), WORD + NUMBERS), np.float32)
    for k, b in enumerate(page):
        w = b.text.split(" ")
        counts = np.bincount([_words[x] for x in w], minlength=WORD)
        rest[k, :WORD] = counts * (1 / len(w))
        rest[k, WORD:] = (min(len(w), 60) / 60, b.linked, k / len(page), b.text[-1] in ".!?", 1 / len(w), 1)
    return [path_features(b.path) for b in page], rest


def path_matrix(features: list[int]) -> np.ndarray:
    packed = np.frombuffer(b"".join(x.to_bytes(PATH // 8, "little") for x in features), np.uint8)
    return np.unpackbits(packed.reshape(len(features), PATH // 8), axis=1, bitorder="little").astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Direction:
    """One LSTM over (time, page, feature) arrays; what lies beyond a page's end keeps the state at zero."""

    def __init__(self, rng: np.random.Generator):
        self.wx = (rng.standard_normal((PATH + WORD + NUMBERS, 4 * HIDDEN)) * 0.08).astype(np.float32)
        self.wh = (rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.2).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1

    def forward(self, projected: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        steps, n, _ = projected.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps):
            z = projected[t] + h @ self.wh + self.b
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = (f * c + i * g) * m
            tc = np.tanh(c_new)
            h_new = o * tc * m
            if keep is not None:
                keep.append((h, c, i, f, o, g, tc, m))
            h, c = h_new, c_new
            out[t] = h
        return out

    def backward(self, x: np.ndarray, d_out: np.ndarray, keep: list) -> list[np.ndarray]:
        d_wx, d_wh, d_b = np.zeros_like(self.wx), np.zeros_like(self.wh), np.zeros_like(self.b)
        dh, dc = 0, 0
        for t in range(len(keep) - 1, -1, -1):
            h, c, i, f, o, g, tc, m = keep[t]
            dh = (d_out[t] + dh) * m
            dc = dc * m + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            d_wx += x[t].T @ dz
            d_wh += h.T @ dz
            d_b += dz.sum(0)
            dh, dc = dz @ self.wh.T, dc * f
        return [d_wx, d_wh, d_b]


def _reversed(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each page's own steps in reverse order, its padding after them."""
    t = np.arange(len(x))[:, None]
    back = np.where(t < lengths, lengths - 1 - t, t)
    return np.take_along_axis(x, back.reshape(*back.shape, *[1] * (x.ndim - 2)), 0)


class Labeller:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.ways = [Direction(rng), Direction(rng)]
        self.out = (rng.standard_normal(2 * HIDDEN) * 0.2).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [w for d in self.ways for w in (d.wx, d.wh, d.b)] + [self.out, self.bias]

    def fit(self, pages: list[tuple[list[Block], list[int]]], seed: int = 7) -> Labeller:
        rng = np.random.default_rng(seed)
        data = []
        for page, labels in pages:
            paths, rest = vectors(page)
            data.append((np.concatenate([path_matrix(paths), rest], 1), np.array(labels, np.float32)))
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(data))
            for at in range(0, len(order), BATCH):
                rows = [data[k] for k in order[at:at + BATCH]]
                lengths = np.array([len(y) for _, y in rows])
                x = np.zeros((lengths.max(), len(rows), PATH + WORD + NUMBERS), np.float32)
                y = np.zeros((lengths.max(), len(rows)), np.float32)
                for k, (a, b) in enumerate(rows):
                    x[:len(b), k], y[:len(b), k] = a, b
                mask = (np.arange(len(x))[:, None] < lengths).astype(np.float32)
                xs, kept, hs = [x, _reversed(x, lengths)], ([], []), []
                for d, v, keep in zip(self.ways, xs, kept):
                    hs.append(d.forward(v @ d.wx, mask, keep))
                h = np.concatenate([hs[0], _reversed(hs[1], lengths)], 2)
                d_logit = (_sigmoid(h @ self.out + self.bias) - y) * mask / mask.sum()
                d_h = d_logit[..., None] * self.out
                grads = self.ways[0].backward(xs[0], d_h[..., :HIDDEN], kept[0])
                grads += self.ways[1].backward(xs[1], _reversed(d_h[..., HIDDEN:], lengths), kept[1])
                grads += [np.einsum("tn,tnh->h", d_logit, h), d_logit.sum(keepdims=True).reshape(1)]
                step += 1
                rate = RATE * (1 - 0.9 * epoch / EPOCHS)
                for w, g, (m, v) in zip(self.weights, grads, moments):  # Adam
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return self

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks are article text.  Pages of like length share a batch."""
        result: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            size = max(1, min(256, 40_000 // len(pages[order[at]])))
            rows = order[at:at + size]
            at += len(rows)
            lengths = np.array([len(pages[k]) for k in rows])
            known: dict[int, int] = {}
            which = np.zeros((lengths.max(), len(rows)), np.int64)
            rest = np.zeros((lengths.max(), len(rows), WORD + NUMBERS), np.float32)
            for j, k in enumerate(rows):
                paths, own = vectors(pages[k])
                which[:len(paths), j] = [known.setdefault(p, len(known)) for p in paths]
                rest[:len(paths), j] = own
            table = path_matrix(list(known))
            mask = (np.arange(len(which))[:, None] < lengths).astype(np.float32)
            logit = np.full(which.shape, self.bias[0], np.float32)
            for d, own in zip(self.ways, (self.out[:HIDDEN], self.out[HIDDEN:])):
                projected = (table @ d.wx[:PATH])[which] + rest @ d.wx[PATH:]  # each path is projected once
                back = d is self.ways[1]
                h = d.forward(_reversed(projected, lengths) if back else projected, mask)
                logit += (_reversed(h, lengths) if back else h) @ own
            for j, k in enumerate(rows):
                result[k] = logit[:lengths[j], j] > 0
        return result


_SYLLABLES = "the of an in er on re at en or es ti ed is it al ar st nt ng ou se ha as to io le ve co me de hi ri ro ic".split()
#: (tag, classes to choose from) of parts that hold the article.
_ARTICLE = [("article", ["", "post", "entry hentry", "story"]), ("main", ["", "content", "main-content"]),
            ("div", ["content", "article-body", "post-content", "entry-content", "story-body", "main", "text", "page-content", "article"]),
            ("section", ["article", "content", "post", "story"])]
#: (tag, classes, what it holds) of the other parts.
_OTHER = [
    ("nav", ["", "menu", "navbar", "main-nav"], "links"), ("div", ["menu", "nav", "navigation", "breadcrumbs", "topbar", "toolbar", "pagination"], "links"),
    ("header", ["", "site-header", "masthead"], "texts"), ("div", ["header", "site-header", "banner", "logo"], "texts"),
    ("footer", ["", "site-footer"], "texts"), ("div", ["footer", "copyright", "bottom", "legal"], "texts"),
    ("aside", ["", "sidebar", "related"], "mixed"), ("div", ["sidebar", "widget", "related", "trending", "recommended", "side"], "mixed"),
    ("div", ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "adsbox", "banner-ad"], "texts"),
    ("div", ["cookie", "cookie-notice", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "disclaimer"], "texts"),
    ("section", ["ad", "sponsored", "notice", "promo"], "texts"), ("p", ["notice", "ad", "disclaimer", "cookie"], "text"),
    ("form", ["", "search", "signup", "login", "newsletter"], "form"), ("div", ["newsletter", "subscribe", "signup", "search"], "form"),
    ("section", ["comments", "responses", "discussion"], "comments"), ("div", ["comments", "comment-list", "replies", "disqus"], "comments"),
    ("ul", ["comments", "commentlist"], "items"), ("ol", ["comments", "comment-list"], "items"),
    ("ul", ["menu", "nav", "share", "social", "breadcrumb"], "links"), ("div", ["share", "social", "tags", "byline-links", "author-box"], "links"),
]
_SIGNS = ["cookies", "subscribe", "comments", "sponsored", "copyright", "reply", "login", "menu", "newsletter", "policy", "©"]


def training_page(r: random.Random) -> tuple[str, list[int]]:
    """A page and the labels of its blocks in order (1: article text)."""
    labels: list[int] = []

    def phrase(low: int, high: int, sign: bool = False) -> str:
        w = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high))]
        w[0] = w[0].capitalize()
        if sign and r.random() < 0.3:
            w.insert(r.randrange(len(w) + 1), r.choice(_SIGNS))
        return " ".join(w) + r.choice(["", ".", "."])

    def leaf(tag: str, label: int, text: str, mark: str = "") -> str:
        labels.append(label)
        close = "" if tag in ("p", "li") and r.random() < 0.15 else f"</{tag}>"
        if r.random() < 0.1:
            text = f"<b>{text}<br>"
        return f"<{tag}{mark}>{text}{close}" + r.choice(["", "", "\n"])

    def mark(classes: list[str]) -> str:
        c = r.choice(classes)
        return "" if not c else f' {r.choice(["class", "class", "id"])}="{c}"'

    def link() -> str:
        return f'<a href="/{r.randint(1, 99)}">{phrase(1, 3, True)}</a>'

    def other() -> str:
        tag, classes, kind = r.choice(_OTHER)
        m = mark(classes)
        body: list[str] = []
        if kind == "text":
            return leaf(tag, 0, phrase(3, 30, True), m)
        if kind == "links":
            items = [leaf("li", 0, link()) for _ in range(r.randint(1, 8))]
            body = items if tag == "ul" else ["<ul>", *items, "</ul>"]
        elif kind == "items":
            body = [leaf("li", 0, phrase(2, 40, True)) for _ in range(r.randint(1, 5))]
        elif kind == "texts":
            if r.random() < 0.5:
                labels.append(0)
                body = [phrase(2, 30, True)]
            else:
                body = [leaf(r.choice(["p", "p", "div", "span-p"]).removeprefix("span-"), 0, phrase(1, 40, True)) for _ in range(r.randint(1, 3))]
        elif kind == "form":
            body = [leaf(r.choice(["p", "label", "h3", "button", "div"]), 0, phrase(1, 15, True)) for _ in range(r.randint(1, 4))]
            body = ["<form>", *body, "</form>"] if tag != "form" else body
        elif kind == "mixed":
            body = [leaf("h3", 0, phrase(1, 4))] + [leaf(r.choice(["p", "li", "div"]), 0, r.choice([link(), phrase(2, 40, True)])) for _ in range(r.randint(1, 5))]
        else:
            body = [leaf(r.choice(["h2", "h3"]), 0, phrase(1, 3, True))]
            for _ in range(r.randint(1, 4)):
                body += ['<div class="comment">', leaf("p", 0, phrase(2, 60, True)), "</div>"]
        return f"<{tag}{m}>{''.join(body)}</{tag}>"

    def article() -> str:
        tag, classes = r.choice(_ARTICLE)
        body = [leaf("h1", 1, phrase(1, 12))] if r.random() < 0.8 else []
        for _ in range(r.choice([1, 2, 5, 10, 20, 40])):
            x = r.random()
            if x < 0.7:
                body.append(leaf("p", 1, phrase(1, r.choice([3, 20, 80]))))
            elif x < 0.78:
                body.append(leaf(r.choice(["h2", "h3"]), 1, phrase(1, 8)))
            elif x < 0.84:
                body.append(leaf(r.choice(["blockquote", "pre", "div"]), 1, phrase(1, 40)))
            elif x < 0.9:
                kind = r.choice(["ul", "ol"])
                body += [f"<{kind}>", *[leaf("li", 1, phrase(1, 15)) for _ in range(r.randint(1, 5))], f"</{kind}>"]
            elif x < 0.92:
                body += ["<figure>", leaf("figcaption", 1, phrase(2, 15)), "</figure>"]
            elif x < 0.94:
                body += ["<table>", *[f"<tr>{leaf('td', 1, phrase(1, 5))}{leaf('td', 1, phrase(1, 5))}</tr>" for _ in range(3)], "</table>"]
            else:
                body.append(other())
        return f"<{tag}{mark(classes)}>{''.join(body)}</{tag}>"

    head = "<html><head>" + leaf("title", 0, phrase(2, 10)) + "<style>p{margin:0}</style><script>var a='</p>';</script></head><body>"
    before = "".join(other() for _ in range(r.randint(0, 4)))
    middle = article()
    if r.random() < 0.3:
        middle = f'<div{mark(["wrapper", "container", "page", "row", "site", "layout"])}>{middle}</div>'
    after = "".join(other() for _ in range(r.randint(0, 4)))
    return head + before + middle + after + r.choice(["</body></html>", ""]), labels


def training_set(n: int = TRAIN_PAGES, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    r = random.Random(seed)
    out = []
    while len(out) < n:
        html, labels = training_page(r)
        page = blocks(html)
        if len(page) == len(labels):
            out.append((page, labels))
    return out


@lru_cache(maxsize=1)
def trained() -> Labeller:
    return Labeller().fit(training_set())
