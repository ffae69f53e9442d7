"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags. Each
block is a vector of its hashed tag path (names, classes, ids and roles of the open elements), its
hashed words and a few sizes. A bidirectional LSTM in numpy reads the whole sequence and labels every
block main text or not, so a block is judged by its whole document. The blocks labelled main text,
trimmed and with single spaces, are joined in page order.

The network is trained here, on pages drawn from a grammar of layouts (articles under many
names, menus, headers, footers, sidebars, notices, adverts, forms, comments), once a driver.
Scripts, styles, comments and head matter are markup and never become blocks. Formulas, fallback text
of media and everything else are blocks for the network to judge.

Null and empty html gives an empty text; html cut off in the middle of a tag loses only that tag, and an
element without an end tag loses nothing but, as in a browser, what follows an open script or style. Very
long pages are read in stretches that hand their states on. Repeated rows are read each; an input column called like
the output (``text``) is replaced, all others are kept; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from corvane.llm._arrow import Words, slices

# Element names of the HTML standard by how they shape text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
FORMULA = frozenset("math mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPAQUE = frozenset("script style template iframe head title textarea".split())
RAW = frozenset(["script", "style"])
CLOSED_BY = {"p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)", re.S)
NAMED = re.compile(r"\b(class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SPACE = re.compile(r"\s+")

PATH, WORD, SIZES = 192, 48, 8
WIDTH = 2 * PATH + WORD + SIZES
HIDDEN = 24


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(path, text, share of characters inside links) of each leaf block."""
    out: list[tuple[tuple[str, ...], str, float]] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    run: list[str] = []
    linked = in_link = 0

    def close() -> None:
        nonlocal run, linked
        if run:
            text = SPACE.sub(" ", entities.unescape("".join(run))).strip()
            if text:
                out.append((tuple(x for _, own in path for x in own), text, min(1.0, linked / len(text))))
        run, linked = [], 0

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            run.append(text)
            if in_link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing = name.lower(), (m[1] or m[4]) == "/"
        if name in OPAQUE:
            if not closing and not m[0].endswith("/>"):
                close()
                gone = _end_of(name).search(page, at)
                if gone:
                    at = gone.end()
                elif name in RAW:
                    at = end
            continue
        if name in INLINE or name in FORMULA:
            if name == "a":
                in_link = 0 if closing else 1
            continue
        close()
        if name in VOID:
            continue
        if closing:
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == name:
                    del path[i:]
                    break
            continue
        while path and name in CLOSED_BY.get(path[-1][0], ()):
            path.pop()
        path.append((name, _labels(name, m[3] or "")))
    close()
    return out


@cache
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*>" if name != "head" else r"</head\s*>|(?=<body[\s>])", re.I)


@lru_cache(20_000)
def _labels(name: str, attributes: str) -> tuple[str, ...]:
    own = [name]
    for key, a, b, c in NAMED.findall(attributes) if attributes else ():
        value = a or b or c
        own.append(f"{key.lower()}={value.lower()}")
        own += [f".{x.lower()}" for x in PARTS.findall(value)]
    return tuple(own)


def _bucket(token: str, n: int) -> int:
    return zlib.crc32(token.encode()) % n


@lru_cache(50_000)
def _path(tokens: tuple[str, ...]) -> np.ndarray:
    """Hashed tokens of all open elements, and apart from them those of the innermost ones."""
    v = np.zeros(2 * PATH, np.float32)
    for t in tokens:
        v[_bucket(t, PATH)] = 1
    for t in tokens[-4:]:
        v[PATH + _bucket(t, PATH)] = 1
    return v


def vectors(page: list[tuple[tuple[str, ...], str, float]], start: int = 0, end: int | None = None) -> np.ndarray:
    """One row a block, of blocks start to end of the page."""
    whole, page = len(page), page[start:end]
    x = np.zeros((len(page), WIDTH), np.float32)
    texts = [t for _, t, _ in page]
    w = Words(pa.array(texts, pa.large_string()))
    n = np.diff(w.first)
    if len(w):
        counts = np.bincount(np.repeat(np.arange(len(page)), n) * WORD + (w.hash % np.uint64(WORD)).astype(np.int64), minlength=len(page) * WORD).reshape(len(page), WORD)
        x[:, 2 * PATH : 2 * PATH + WORD] = np.sqrt(counts / np.maximum(1, n)[:, None])
    for i, (path, text, link) in enumerate(page):
        x[i, : 2 * PATH] = _path(path)
        x[i, -SIZES:] = (np.log1p(n[i]) / 5, link, text[-1] in ".!?\"”»", min(len(path), 20) / 10, (start + i) / max(1, whole - 1), np.log1p(whole) / 5, "©" in text or "|" in text, text.count(",") / (n[i] + 1))
    return x


class Labeller:
    """A bidirectional LSTM over block vectors and a logit on both states."""

    def __init__(self, seed: int = 29):
        rng = np.random.Generator(np.random.PCG64(seed))
        side = lambda: [rng.normal(0, 0.08, (WIDTH, 4 * HIDDEN)).astype(np.float32), rng.normal(0, 0.12, (HIDDEN, 4 * HIDDEN)).astype(np.float32), np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)]
        self.p = [*side(), *side(), rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)]
        self.m, self.v, self.t = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0

    @staticmethod
    def _gates(z: np.ndarray) -> tuple[np.ndarray, ...]:
        s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
        return s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])

    def _run(self, x: np.ndarray, mask: np.ndarray, k: int) -> tuple[np.ndarray, list]:
        """States of one direction over x (time, page, width); padding keeps the state."""
        w, u, b = self.p[k : k + 3]
        z = x.reshape(-1, x.shape[2]) @ w + b
        z = z.reshape(x.shape[0], x.shape[1], -1)
        h, c = np.zeros((2, x.shape[1], HIDDEN), np.float32)
        hs, tape = np.zeros((x.shape[0], x.shape[1], HIDDEN), np.float32), []
        for t in range(len(x)):
            i, f, o, g = self._gates(z[t] + h @ u)
            new = f * c + i * g
            th = np.tanh(new)
            m = mask[t][:, None]
            tape.append((i, f, o, g, c, th, h, m))
            c, h = np.where(m, new, c), np.where(m, o * th, h)
            hs[t] = h
        return hs, tape

    def logits(self, x: np.ndarray, mask: np.ndarray, tapes: bool = False):
        a, tape_a = self._run(x, mask, 0)
        b, tape_b = self._run(x[::-1], mask[::-1], 3)
        b = b[::-1]
        out = a @ self.p[6][:HIDDEN] + b @ self.p[6][HIDDEN:] + self.p[7][0]
        return (out, a, b, tape_a, tape_b) if tapes else out

    def _back(self, x: np.ndarray, tape: list, dh_all: np.ndarray, k: int) -> list[np.ndarray]:
        w, u, _ = self.p[k : k + 3]
        dz_all = np.zeros((len(x), x.shape[1], 4 * HIDDEN), np.float32)
        du = np.zeros_like(u)
        dh, dc = np.zeros((2, x.shape[1], HIDDEN), np.float32)
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, c, th, h, m = tape[t]
            d = dh + dh_all[t]
            dn = np.where(m, d * o * (1 - th * th) + dc, 0)
            dz = np.concatenate([dn * g * i * (1 - i), dn * c * f * (1 - f), np.where(m, d * th * o * (1 - o), 0), dn * i * (1 - g * g)], 1)
            dz_all[t] = dz
            du += h.T @ dz
            dh, dc = np.where(m, dz @ u.T, d), np.where(m, dn * f, dc)
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        return [x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(0)]

    def step(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, rate: float) -> float:
        """One Adam step on the cross-entropy of labels y; the loss."""
        out, a, b, ta, tb = self.logits(x, mask, True)
        p = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
        n = mask.sum()
        slope = (np.where(mask, p - y, 0) / n).astype(np.float32)
        grads = [*self._back(x, ta, slope[:, :, None] * self.p[6][:HIDDEN], 0), *self._back(x[::-1], tb, (slope[:, :, None] * self.p[6][HIDDEN:])[::-1], 3)]
        grads += [np.concatenate([np.einsum("tp,tph->h", slope, a), np.einsum("tp,tph->h", slope, b)]), np.array([slope.sum()])]
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        self.t += 1
        for k, g in enumerate(grads):
            g = g * min(1.0, 1.0 / (size + 1e-9)) + 1e-6 * self.p[k]
            self.m[k], self.v[k] = 0.9 * self.m[k] + 0.1 * g, 0.999 * self.v[k] + 0.001 * g * g
            self.p[k] = (self.p[k] - rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)
        return float(np.where(mask, np.logaddexp(0, out) - y * out, 0).sum() / n)

    def _read(self, z: np.ndarray, mask: np.ndarray, k: int, state: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """One direction's share of the logits over projected inputs z, and the state it ends in; nothing else is kept."""
        u, v = self.p[k + 1], self.p[6][:HIDDEN] if k == 0 else self.p[6][HIDDEN:]
        h, c = state
        out = np.zeros(mask.shape, np.float32)
        for t in range(len(z)):
            i, f, o, g = self._gates(z[t] + h @ u)
            m = mask[t][:, None]
            c = np.where(m, f * c + i * g, c)
            h = np.where(m, o * np.tanh(c), h)
            out[t] = h @ v
        return out, (h, c)

    def _together(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """logits() without tapes."""
        out = np.full(mask.shape, self.p[7][0], np.float32)
        for k, way in ((0, 1), (3, -1)):
            z = (x.reshape(-1, x.shape[2]) @ self.p[k] + self.p[k + 2]).reshape(*mask.shape, -1)
            out += self._read(z[::way], mask[::way], k, tuple(np.zeros((2, mask.shape[1], HIDDEN), np.float32)))[0][::way]
        return out

    def _long(self, page: list[tuple[tuple[str, ...], str, float]], stretch: int) -> np.ndarray:
        """Logits of one page too long to lie in memory as vectors: stretch by stretch, the state handed on."""
        out = np.full(len(page), self.p[7][0], np.float32)
        starts = list(range(0, len(page), stretch))
        for k, way in ((0, 1), (3, -1)):
            state = tuple(np.zeros((2, 1, HIDDEN), np.float32))
            for at in starts[::way]:
                x = vectors(page, at, at + stretch)
                z = (x @ self.p[k] + self.p[k + 2])[::way, None]
                own, state = self._read(z, np.ones(z.shape[:2], bool), k, state)
                out[at : at + stretch] += own[::way, 0]
        return out

    def label(self, pages: list[list[tuple[tuple[str, ...], str, float]]], together: int = 128, most: int = 12_000) -> list[np.ndarray]:
        """Main text or not, for each block of each page; pages of like length are read together, at most ``most`` blocks at once."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            own = [order[at]]
            while at + len(own) < len(order) and len(own) < together and len(pages[order[at + len(own)]]) * (len(own) + 1) <= most:
                own.append(order[at + len(own)])
            at += len(own)
            if len(pages[own[0]]) > most:
                out[own[0]] = self._long(pages[own[0]], most) > 0
                continue
            x, mask = _padded([vectors(pages[i]) for i in own])
            good = self._together(x, mask) > 0
            for j, i in enumerate(own):
                out[i] = good[: len(pages[i]), j]
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(map(len, pages)), len(pages), WIDTH), np.float32)
    mask = np.zeros(x.shape[:2], bool)
    for j, p in enumerate(pages):
        x[: len(p), j], mask[: len(p), j] = p, True
    return x, mask


# Names under which page parts go on the web, for the training grammar.
MAIN = ["article", "main", "div.content", "div#content", "div.post", "div.entry-content", "section.article-body", "div.main-text", "div.story", "div#main", "div.post-body", "div.article", "div[itemprop=articleBody]", "div"]
OTHER = {
    "menu": ["nav", "ul.menu", "div.navigation", "div#nav", "div.breadcrumbs", "ul.nav-links", "div.navbar", "div.toc"],
    "head": ["header", "div.header", "div#header", "div.site-header", "div.masthead", "div.banner"],
    "foot": ["footer", "div.footer", "div#footer", "div.site-footer", "div.copyright", "div.bottom"],
    "side": ["aside", "div.sidebar", "div#sidebar", "div.widget", "div.related", "section.related-posts", "div.recommended", "div.side", "div.popular"],
    "note": ["div.cookie", "div.cookie-notice", "div.notice", "div.consent", "div#gdpr-banner", "div.alert", "div.newsletter", "div.popup", "div.modal", "div.subscribe", "dialog"],
    "ad": ["div.ad", "div.ads", "div.advert", "div.advertisement", "div#sponsor", "div.promo", "div.sponsored", "ins.adsbygoogle", "aside.ad"],
    "form": ["form", "form.search", "form#login", "div.search-form", "fieldset"],
    "talk": ["div.comments", "section.comments", "div#comments", "ol.commentlist", "div.comment", "div.disqus", "div.replies", "section#discussion", "div.respond", "ul.comment-list"],
    "share": ["div.share", "div.social", "div.tags", "div.author-bio", "div.pagination", "ul.share-buttons", "div.meta", "div.byline"],
}


def _open(spec: str, more: str = "") -> tuple[str, str]:
    """A start and an end tag; ``more`` are class names of layout put before those of ``spec``."""
    name = re.match(r"\w+", spec)[0]
    if "[" in spec:
        key, value = re.search(r"\[(.*)=(.*)\]", spec).groups()
        return f'<{name} {key}="{value}">', f"</{name}>"
    if "." in spec:
        return f'<{name} class="{more}{spec.split(".")[1]}">', f"</{name}>"
    if "#" in spec:
        return f'<{name} id="{spec.split("#")[1]}">', f"</{name}>"
    return f"<{name}>", f"</{name}>"


# Class names of layout frameworks that say nothing about what a part is.
LAYOUT = ["col-md-12 ", "row ", "col-sm-6 ", "clearfix ", "mb-3 ", "d-flex ", "container-fluid ", "u-pad "]


class Grammar:
    """Draws pages whose main blocks carry a mark that is taken off again when blocks are read."""

    MARK = "\x02"

    def __init__(self, seed: int):
        self.r = np.random.Generator(np.random.PCG64(seed))
        self.words = ["".join(self.pick("th an er in re on at en nd st or te es is ou ing tion ment le de la sch ung ción que é ü".split()) for _ in range(self.r.integers(1, 5))) for _ in range(4000)]

    def pick(self, own):
        return own[int(self.r.integers(len(own)))]

    def text(self, low: int, high: int, mark: str = "") -> str:
        n = int(np.exp(self.r.uniform(np.log(low), np.log(high))))
        words = [self.words[i] for i in self.r.integers(0, len(self.words), n)]
        words[0] = words[0].capitalize()
        for i in np.flatnonzero(self.r.random(n) < 0.1):
            words[i] += self.pick([",", ".", ",", "&amp;", ";"])
        if self.r.random() < 0.75:
            words[-1] += "."
        if n > 3 and self.r.random() < 0.3:
            words[1] = f"<{(t := self.pick(['b', 'em', 'i', 'span', 'strong']))}>{words[1]}</{t}>"
        return mark + " ".join(words)

    def layout(self) -> str:
        return "".join(self.pick(LAYOUT) for _ in range(int(self.r.integers(1, 9)))) if self.r.random() < 0.2 else ""

    def noise(self, kind: str, depth: int = 0) -> str:
        a, z = _open(self.pick(OTHER[kind]), self.layout())
        link = lambda: f'<a href="/{self.pick(self.words)}">{self.text(1, 5)}</a>'
        n = int(self.r.integers(1, 7))
        if kind in ("menu", "share") or kind == "side" and self.r.random() < 0.4:
            inner = "".join(f"<li>{link()}</li>" for _ in range(n + 1)) if self.r.random() < 0.7 else " ".join(link() for _ in range(n + 1))
            inner = f"<ul>{inner}</ul>" if "<li>" in inner and a[:3] not in ("<ul", "<ol") else inner
        elif kind == "form":
            inner = f"<label>{self.text(1, 4)}</label><input type=text><select><option>{self.text(1, 2)}</option></select><button>{self.text(1, 3)}</button>" + (f"<p>{self.text(2, 12)}</p>" if self.r.random() < 0.4 else "")
        elif kind == "foot":
            inner = self.pick([f"&copy; {self.pick(self.words)}.example.com &middot; {self.text(2, 14)}", f"<p>&copy; 2020 {self.text(1, 8)}</p><p>{link()} | {link()}</p>", f"<ul><li>{link()}</li><li>{link()}</li></ul><p>{self.text(2, 30)}</p>", self.text(2, 40)])
        elif kind == "talk":
            inner = (f"<h3>{self.text(1, 3)}</h3>" if self.r.random() < 0.5 else "") + "".join((f'<div class="comment"><p>{self.text(3, 80)}</p></div>' if self.r.random() < 0.5 else f"<{(t := self.pick(['p', 'li', 'div']))}>{self.text(3, 80)}</{t}>") for _ in range(n))
        elif kind == "head":
            inner = f"<h1>{self.text(1, 8)}</h1>" + (f"<p>{self.text(2, 12)}</p>" if self.r.random() < 0.5 else "") + (self.noise("menu") if self.r.random() < 0.5 else "")
        elif kind in ("note", "ad"):
            inner = self.text(2, 40) if self.r.random() < 0.6 else f"<p>{self.text(2, 40)}</p>" + (f"<button>{self.text(1, 3)}</button>" if self.r.random() < 0.5 else link())
        else:
            inner = f"<h3>{self.text(1, 4)}</h3>" + "".join(f"<p>{self.text(2, 40)}</p>" for _ in range(n))
        return a + inner + z

    def main(self) -> str:
        m, out = self.MARK, []
        if self.r.random() < 0.85:
            out.append(f"<h1>{self.text(1, 14, m)}</h1>" if self.r.random() < 0.8 else f"<h2>{self.text(1, 14, m)}</h2>")
        if self.r.random() < 0.1:
            out.insert(0, f"<header>{out.pop() if out else ''}</header>".replace(m, m))
        for _ in range(int(self.r.integers(1, 14))):
            roll = self.r.random()
            if roll < 0.62:
                out.append(f"<p>{self.text(1, 220, m)}" + ("</p>" if self.r.random() < 0.9 else ""))
            elif roll < 0.7:
                out.append(f"<p><b>{self.text(1, 60, m)}<br>")
            elif roll < 0.76:
                out.append(f"<{(t := self.pick(['h2', 'h3', 'h4']))}>{self.text(1, 9, m)}</{t}>")
            elif roll < 0.82:
                out.append(f"<{(t := self.pick(['ul', 'ol']))}>" + "".join(f"<li>{self.text(1, 25, m)}</li>" for _ in range(int(self.r.integers(1, 6)))) + f"</{t}>")
            elif roll < 0.86:
                out.append(f"<blockquote>{self.text(3, 60, m)}</blockquote>")
            elif roll < 0.88:
                out.append(f"<pre>{self.text(3, 30, m)}</pre>")
            elif roll < 0.91:
                out.append("<table>" + "".join(f"<tr><td>{self.text(1, 5, m)}</td><td>{self.text(1, 5, m)}</td></tr>" for _ in range(int(self.r.integers(1, 4)))) + "</table>")
            elif roll < 0.93:
                out.append(f"<figure><img src=x><figcaption>{self.text(2, 14, m)}</figcaption></figure>")
            elif roll < 0.945:
                out.append(f"<div>{self.text(2, 60, m)}</div>")
            elif roll < 0.95:
                out.append(f"<{(t := self.pick(['video', 'svg', 'object', 'canvas']))}>{self.text(2, 12, m)}</{t}>")
            else:
                out.append(self.noise(self.pick(["ad", "side", "share", "note", "form", "menu"])))
        return "".join(out)

    def page(self) -> str:
        r = self.r.random
        kinds = [k for k, p in (("head", 0.35), ("menu", 0.75), ("note", 0.25), ("ad", 0.45), ("form", 0.15)) if r() < p]
        self.r.shuffle(kinds)
        before = "".join(self.noise(k) for k in kinds)
        after = "".join(self.noise(k) for k in ("ad", "share", "talk", "side", "note", "form") if r() < 0.22) + (self.noise("foot") if r() < 0.85 else "")
        a, z = _open(self.pick(MAIN if r() < 0.6 else ["article"]), self.layout())
        body = before + (self.noise("side") if r() < 0.15 else "") + a + self.main() + (self.noise("talk") if r() < 0.12 else "") + z + after
        if r() < 0.35:
            b, y = _open(self.pick(["div.wrapper", "div#page", "div.container", "main", "div.row", "section"]))
            body = b + body + y
        return f"<!DOCTYPE html><html><head><title>{self.text(1, 8)}</title><style>p{{}}</style></head><body>{body}" + ("</body></html>" if r() < 0.9 else "")

    def sample(self, n: int) -> tuple[list[list], list[np.ndarray]]:
        """Pages as blocks, and which of their blocks are main text."""
        xs, ys = [], []
        for _ in range(n):
            own = blocks(self.page())
            ys.append(np.array([self.MARK in t for _, t, _ in own], np.float32))
            xs.append([(p, t.replace(self.MARK, "") or "x", k) for p, t, k in own])
        return xs, ys


@cache
def trained(pages: int = 2400, epochs: int = 9, together: int = 48) -> Labeller:
    """The labeller fitted to drawn pages; the same each time."""
    xs, ys = Grammar(7).sample(pages)
    xs = [vectors(x) for x in xs]
    net, rng = Labeller(), np.random.Generator(np.random.PCG64(3))
    for epoch in range(epochs):
        order = sorted(range(pages), key=lambda i: len(xs[i]) + rng.uniform(0, 6))
        groups = [order[i : i + together] for i in range(0, pages, together)]
        for g in rng.permutation(len(groups)):
            x, mask = _padded([xs[i] for i in groups[g]])
            y = np.zeros(mask.shape, np.float32)
            for j, i in enumerate(groups[g]):
                y[: len(ys[i]), j] = ys[i]
            net.step(x, mask, y, 0.006 if epoch < epochs - 3 else 0.0015)
    net.m, net.v = [], []
    return net


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """pages without ``html``, with its main text (``text``)."""
    net = trained()
    names = [c for c in pages.columns if c not in (html, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, html, 1_500_000):
            read = [blocks(x or "") for x in part[html].to_pylist()]
            out = [" ".join(t for (_, t, _), ok in zip(x, g, strict=True) if ok) for x, g in zip(read, net.label(read), strict=True)]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in names), pa.array(out, pa.string())], [*names, text])

    return pages.select(*names, html).mapInArrow(run, StructType([*(pages.schema[c] for c in names), StructField(text, StringType())]))
