"""Main text of web pages by a recurrent block labeller.

A page is read as its sequence of text blocks. Each block becomes a vector: hashed tags,
classes and ids of its path, hashed words, and a few sizes. A bidirectional LSTM in
numpy reads the sequence both ways and labels every block as article or not, so the
label of a block depends on the whole page.

The network is trained when the operator is built, on about ``SAMPLE`` pages (chosen by
hash, of at most ``SAMPLE_CHARS`` characters): their blocks are
labelled by the markup around them (``_weak_labels``), and each page is used again in
other dresses (``_dressed``) whose blocks have known labels: other containers for the
article, with sidebars, reader comments, notices, forms and headers around it.

Null and empty pages have no text. White space inside a block, no-break spaces and separators
(U+001C to U+001F) included, becomes one space, blocks
are joined by one line break in page order; nothing else is dropped or cut. Repeated
rows give repeated rows, an empty table an empty result, further columns are ignored.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import words_of

SAMPLE, SAMPLE_CHARS = 256, 200_000
PATH_DIMS, WORD_DIMS, SIZES = 96, 64, 5
HIDDEN, EPOCHS, RATE, SEED = 16, 5, 0.02, 7
BATCH_CELLS = 1 << 14  # blocks labelled together, padding included

_QUOTE = re.compile(r"=\s*([\"'])")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_HOOK = re.compile(r"(?:\s|^)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
# Fixed values of the markup language: elements without content, with raw text up to their
# own closing tag, with content that is no text of the page, and within lines.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in "script style noscript iframe title textarea".split()}
_HIDDEN = set("template select svg canvas audio video button".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mpadded mphantom mfenced menclose semantics annotation".split())
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_P_ENDS = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())

_MAIN = re.compile(r"article|main|content|story|post|entry|body-?text")
_ASIDE = re.compile(r"\b(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|comments?|replies|sidebar|widget|related|share|social|cookie\w*|notice|consent|newsletter|subscribe|menu|nav\w*|breadcrumbs?|footer|header|masthead|toolbar|login|search|popup)\b")
_ASIDE_TAGS = {"nav", "aside", "footer", "form", "dialog"}


@lru_cache(maxsize=20_000)
def _element(tag: str) -> tuple[str, tuple[str, ...]]:
    """Name and hooks (classes, id, role) of a start tag."""
    name = _NAME.match(tag)[1].lower()
    words = " ".join(a or b or c for a, b, c in _HOOK.findall(tag)).lower()
    return name, tuple(words.split())


def _tag_end(page: str, at: int) -> int:
    """Place of the > that ends the tag at ``at``; it may stand in quoted values before. A quote
    that is not closed in front of white space, / or > is no quote: the tag ends at the next >."""
    end = page.find(">", at)
    while end >= 0 and (quote := _QUOTE.search(page, at, end)):
        close = page.find(quote[1], quote.end())
        if close < 0 or page[close + 1 : close + 2] not in (" ", "\t", "\n", "\r", "\f", "/", ">"):
            break
        at = close + 1
        if at > end:
            end = page.find(">", at)
    return end


def _tokens(page: str):
    """(start, end, kind) of texts and tags; comments and declarations are left out.
    Every search either moves on or is not repeated, so a page of n characters takes n steps."""
    at, last, cdata = 0, page.rfind(">"), page.rfind("]]>")
    while at < len(page):
        mark = page.find("<", at)
        if mark < 0:
            yield at, len(page), "text"
            return
        if mark > at:
            yield at, mark, "text"
        follows = page[mark + 1 : mark + 2]
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = end + 3 if end >= 0 else len(page)
        elif page.startswith("<![CDATA[", mark) and mark < cdata:
            end = page.find("]]>", mark)
            yield mark + 9, end, "cdata"
            at = end + 3
        elif follows in ("!", "?"):
            at = page.find(">", mark) + 1 if mark < last else len(page)
        elif follows.isascii() and follows.isalpha() or follows == "/" and page[mark + 2 : mark + 3].isascii() and page[mark + 2 : mark + 3].isalpha():
            end = _tag_end(page, mark) if mark < last else -1
            if end < 0:  # a tag that the page does not finish
                return
            at = yield mark, end + 1, "tag"
            at = at or end + 1
        else:
            yield mark, mark + 1, "text"
            at = mark + 1


class Path:
    """Elements around a block, from the root; shared with the blocks beside it."""

    __slots__ = ("parent", "element", "places", "main", "aside")

    def __init__(self, parent: Path | None, element: tuple[str, tuple[str, ...]]):
        self.parent, self.element = parent, element
        self.places = _element_places(element) | (parent.places if parent else frozenset())
        main, aside = _named(element)
        self.main, self.aside = main or bool(parent and parent.main), aside or bool(parent and parent.aside)

    def __iter__(self):
        found, node = [], self
        while node:
            found.append(node.element)
            node = node.parent
        return reversed(found)


def path_of(elements) -> Path | None:
    node = None
    for e in elements:
        node = Path(node, e)
    return node


class _Open:
    """Elements that are open, with the blocks they have given."""

    def __init__(self):
        self.out: list[tuple[Path | None, str, int]] = []
        self.stack: list[str] = []
        self.block_at: list[int] = []  # places of the stack's elements that are not within lines
        self.paths: list[Path | None] = [None]  # the path of each of those
        self.inline: list[dict[str, int]] = [{}]  # names open within lines, for each of those
        self.known: dict[str, int] = {}  # open elements that are not within lines, by name
        self.parts: list[str] = []
        self.linked = self.links = 0
        self.frames: list[tuple[int, int, list[str], int]] = []  # hidden elements: place, blocks before, text before

    def _block(self, parts: list[str], linked: int, path: Path | None):
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        return [(path, text, linked)] if text else []

    def close(self) -> None:
        if self.parts:
            self.out += self._block(self.parts, self.linked, self.paths[-1])
        self.parts, self.linked = [], 0

    def push(self, element: tuple[str, tuple[str, ...]], hidden: bool) -> None:
        name = element[0]
        if hidden:
            self.frames.append((len(self.stack), len(self.out), self.parts, self.linked, self.paths[-1]))
            self.parts, self.linked = [], 0
        if name in _INLINE:
            self.links += name == "a"
            self.inline[-1][name] = self.inline[-1].get(name, 0) + 1
        else:
            self.block_at.append(len(self.stack))
            self.paths.append(Path(self.paths[-1], element))
            self.inline.append({})
            self.known[name] = self.known.get(name, 0) + 1
        self.stack.append(name)

    def cut(self, depth: int) -> None:
        """Ends all elements from ``depth`` on. Hidden ones among them keep what they gave, but
        for one that ends by itself."""
        own = bool(self.frames) and self.frames[-1][0] == depth
        while self.frames and self.frames[-1][0] >= depth:
            place, before, parts, linked, path = self.frames.pop()
            if own and place == depth:
                self.out, self.parts, self.linked = self.out[:before], parts, linked
            else:
                self.close()
                self.out[before:before] = self._block(parts, linked, path)
        for name in reversed(self.stack[depth:]):
            if name in _INLINE:
                self.inline[-1][name] -= 1
            else:
                self.block_at.pop()
                self.paths.pop()
                self.inline.pop()
                self.known[name] -= 1
        del self.stack[depth:]

    def end(self, name: str) -> None:
        if name == "a":
            self.links = max(0, self.links - 1)
        if name in _INLINE:
            if self.inline[-1].get(name):
                self.cut(len(self.stack) - 1 - self.stack[::-1].index(name))
            return
        if not self.known.get(name):
            self.close()
            return
        depth = next(k for k in reversed(self.block_at) if self.stack[k] == name)
        if not (self.frames and self.frames[-1][0] == depth):
            self.close()
        self.cut(depth)

    def begin(self, element: tuple[str, tuple[str, ...]]) -> None:
        """Room for a new element that is not within lines."""
        self.close()
        name = element[0]
        ends = _CLOSES.get(name) or ({"p"} if name in _P_ENDS else ())
        while self.block_at and self.stack[self.block_at[-1]] in ends:
            self.cut(self.block_at[-1])


def blocks(page: str) -> list[tuple[Path | None, str, int]]:
    """(path, text, characters inside links) of the text blocks of a page, in order.

    What a hidden element such as a button holds is left out if the element is closed inside
    its parent; otherwise it is text like any other. Raw elements that are never closed
    are passed over, but for scripts and styles, which then reach to the end.
    """
    state, endless = _Open(), set()
    tokens, skip = _tokens(page), None
    while True:
        try:
            at, end, kind = tokens.send(skip) if skip is not None else next(tokens)
        except StopIteration:
            break
        skip = None
        if kind != "tag":
            text = page[at:end] if kind == "text" else html.escape(page[at:end])
            state.parts.append(text)
            if state.links:
                state.linked += len(text.strip())
            continue
        token = page[at:end]
        if token[1] == "/":
            state.end(_NAME.match(token)[1].lower())
            continue
        element = _element(token)
        name, alone = element[0], token.endswith("/>")
        if name == "br":
            state.parts.append(" ")
            continue
        if name not in _INLINE and name not in _HIDDEN:
            state.begin(element)
        if name in _RAW_END and not alone:  # no markup inside: on behind its closing tag
            found = None if name in endless else _RAW_END[name].search(page, end)
            if found:
                close = page.find(">", found.end())
                skip = close + 1 if close >= 0 else len(page)
            elif name in ("script", "style"):
                break
            else:
                endless.add(name)
        elif name not in _VOID and not alone:
            state.push(element, name in _HIDDEN)
    state.close()
    state.cut(0)
    return state.out


def _hash(word: str) -> int:
    h = 2166136261
    for c in word.encode():
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return h ^ (h >> 15)


@lru_cache(maxsize=20_000)
def _element_places(element: tuple[str, tuple[str, ...]]) -> frozenset[int]:
    """Hashed features of an element: its tag, hooks and their parts."""
    name, hooks = element
    found = {f"tag {name}"} | {f"hook {part}" for hook in hooks for part in [hook, *re.split(r"[-_\d]+", hook)] if part}
    return frozenset(_hash(f) % PATH_DIMS for f in found)


@lru_cache(maxsize=20_000)
def _named(element: tuple[str, tuple[str, ...]]) -> tuple[bool, bool]:
    """Whether an element's names speak of an article, and of something else."""
    name, hooks = element
    words = " ".join(hooks)
    main = name in ("article", "main") or bool(words and _MAIN.search(words))
    return main, name in _ASIDE_TAGS or bool(words and _ASIDE.search(words.replace("-", " ").replace("_", " ")))


def _path_places(path: Path | None) -> list[int]:
    """Hashed features of a path: those of its elements, and the last tag apart."""
    return [*path.places, _hash(f"leaf {path.element[0]}") % PATH_DIMS] if path else []


def vectors(page_blocks: list[tuple[Path | None, str, int]]) -> np.ndarray:
    """One row for each block."""
    n = len(page_blocks)
    out = np.zeros((n, PATH_DIMS + WORD_DIMS + SIZES), np.float32)
    if not n:
        return out
    texts = [t.lower().encode("utf-8") for _, t, _ in page_blocks]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words = words_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
    cell = np.repeat(np.arange(n), words.counts) * WORD_DIMS + (words.hashes() % np.uint64(WORD_DIMS)).astype(np.int64)
    counts = np.bincount(cell, minlength=n * WORD_DIMS).reshape(n, WORD_DIMS)
    out[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = 0.3 * np.log1p(counts)
    for row, (path, _, _) in zip(out, page_blocks):
        row[_path_places(path)] = 1
    size = np.array([len(t) for _, t, _ in page_blocks], np.float32)
    inside = np.array([k for _, _, k in page_blocks], np.float32)
    place = np.arange(n) / max(1, n - 1)
    out[:, -SIZES:] = np.stack([np.log1p(size) / 8, np.minimum(1, inside / size), place, words.counts / 100.0 > 0.2, np.array([t[-1:] in ".!?" for _, t, _ in page_blocks])], axis=1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with one output for each block."""

    def __init__(self, dims: int = PATH_DIMS + WORD_DIMS + SIZES, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights = {}
        for way in "fb":
            self.weights[f"x{way}"] = rng.normal(0, 0.08, (dims, 4 * hidden)).astype(np.float32)
            self.weights[f"h{way}"] = rng.normal(0, 0.1, (hidden, 4 * hidden)).astype(np.float32)
            self.weights[f"c{way}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
        self.weights["out"] = rng.normal(0, 0.1, (2 * hidden, 1)).astype(np.float32)
        self.weights["bias"] = np.zeros(1, np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool):
        """Hidden states of one direction; x is (time, page, dims), mask (time, page, 1)."""
        steps, pages, _ = x.shape
        k = self.hidden
        given = x @ self.weights[f"x{way}"] + self.weights[f"c{way}"]
        h = np.zeros((pages, k), np.float32)
        c = np.zeros((pages, k), np.float32)
        states, kept = np.zeros((steps, pages, k), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = given[t] + h @ self.weights[f"h{way}"]
            gates = _sigmoid(z[:, : 3 * k])
            i, f, o = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
            g = np.tanh(z[:, 3 * k :])
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if keep:
                kept.append((t, h, c, i, f, o, g, tanh_c))
            c = np.where(mask[t], new_c, c)
            h = np.where(mask[t], o * tanh_c, h)
            states[t] = h
        return states, kept

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._pass(x, mask, w, False)[0] for w in "fb"], axis=2)
        return _sigmoid(both @ self.weights["out"] + self.weights["bias"])[:, :, 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        ways = {w: self._pass(x, mask, w, True) for w in "fb"}
        both = np.concatenate([ways[w][0] for w in "fb"], axis=2)
        p = _sigmoid(both @ self.weights["out"] + self.weights["bias"])
        error = (p - y[:, :, None]) * mask / mask.sum()
        out = {"out": np.einsum("tpk,tpo->ko", both, error), "bias": error.sum((0, 1))}
        back = error @ self.weights["out"].T
        k = self.hidden
        for way, part in zip("fb", (back[:, :, :k], back[:, :, k:])):
            dx, dw, db = np.zeros_like(self.weights[f"x{way}"]), np.zeros_like(self.weights[f"h{way}"]), np.zeros_like(self.weights[f"c{way}"])
            dh, dc = np.zeros((x.shape[1], k), np.float32), np.zeros((x.shape[1], k), np.float32)
            for t, h, c, i, f, o, g, tanh_c in reversed(ways[way][1]):
                m = mask[t]
                own_h, own_c = (dh + part[t]) * m, dc * m
                own_c = own_c + own_h * o * (1 - tanh_c**2)
                dz = np.concatenate([own_c * g * i * (1 - i), own_c * c * f * (1 - f), own_h * tanh_c * o * (1 - o), own_c * i * (1 - g**2)], axis=1)
                dx += x[t].T @ dz
                dw += h.T @ dz
                db += dz.sum(0)
                dh = dz @ self.weights[f"h{way}"].T + (dh + part[t]) * (1 - m)
                dc = own_c * f + dc * (1 - m)
            out |= {f"x{way}": dx, f"h{way}": dw, f"c{way}": db}
        return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x = np.zeros((steps, len(rows), rows[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(rows), 1), bool)
    for k, r in enumerate(rows):
        x[: len(r), k], mask[: len(r), k] = r, True
    return x, mask


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """Adam over batches of 32 labelled pages."""
    model, rng = Labeller(seed=seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(pages))
        for at in range(0, len(order), 32):
            some = [pages[k] for k in order[at : at + 32]]
            x, mask = _padded([v for v, _ in some])
            y = np.zeros(mask.shape[:2], np.float32)
            for k, (_, labels) in enumerate(some):
                y[: len(labels), k] = labels
            step += 1
            for name, g in model.gradients(x, mask, y).items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                model.weights[name] = (model.weights[name] - RATE * first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def _weak_labels(page_blocks: list[tuple[Path | None, str, int]]) -> list[bool] | None:
    """Labels by the markup: inside an article or content container and in nothing that is
    named as something else. None if the page has no such container."""
    labels = [bool(path and path.main and not path.aside) for path, _, _ in page_blocks]
    return labels if any(labels) else None


_CONTAINERS = [("article", ()), ("main", ()), ("div", ("content",)), ("section", ("story",)), ("div", ("post-body",)), ("div", ("entry-content",)), ("div", ("article-text",))]
_AROUND = [
    (("aside", ()), ("p", ())), (("div", ("sidebar",)), ("li", ())), (("section", ("comments",)), ("div", ("comment",)), ("p", ())),
    (("div", ("comment-list",)), ("p", ())), (("div", ("cookie-notice",)), ("p", ())), (("form", ()), ("p", ())), (("header", ()), ("h2", ())),
    (("div", ("ad",)),), (("div", ("advert", "box")), ("p", ())), (("nav", ("menu",)), ("ul", ()), ("li", ())), (("footer", ("footer",)), ("p", ())),
    (("div", ("newsletter",)), ("p", ())), (("div", ("related",)), ("ul", ()), ("li", ())),
]


def _dressed(page_blocks, labels, others: list[str], rng) -> tuple[list, list[bool]]:
    """The page with another article container and other matter around and inside its article."""
    top = (("html", ()), ("body", ()))
    container = _CONTAINERS[rng.integers(len(_CONTAINERS))]
    out, kept = [], []

    def around() -> None:
        path = _AROUND[rng.integers(len(_AROUND))]
        inside = (container,) if rng.random() < 0.3 else ()
        for _ in range(rng.integers(1, 5)):
            text = others[rng.integers(len(others))]
            out.append((path_of(top + inside + path), text, len(text) if path[-1][0] == "li" else 0))
            kept.append(False)

    for _ in range(rng.integers(1, 4)):
        around()
    for (path, text, linked), label in zip(page_blocks, labels):
        if label:
            out.append((path_of(top + (container,) + ((path.element,) if path else ())), text, linked))
            kept.append(True)
            if rng.random() < 0.06:
                around()
    for _ in range(rng.integers(1, 4)):
        around()
    return out, kept


def fit(pages: list[str]) -> Labeller:
    """A labeller trained on pages as ``_weak_labels`` and ``_dressed`` label them."""
    rng = np.random.default_rng(SEED)
    parsed = [b for b in map(blocks, pages) if b]
    others = [t for b in parsed for _, t, _ in b] or ["-"]
    labelled = []
    for b in parsed:
        labels = _weak_labels(b)
        if labels is None:  # no container: the longest blocks stand for an article in the other dresses
            size = sorted(len(t) for _, t, _ in b)[len(b) // 2]
            labels = [len(t) >= size for _, t, _ in b]
        else:
            labelled.append((b, labels))
        labelled += [_dressed(b, labels, others, rng) for _ in range(2)]
    return train([(vectors(b), np.array(y, np.float32)) for b, y in labelled])


def label(model: Labeller, parsed: list[list[tuple[Path | None, str, int]]]) -> list[np.ndarray]:
    """For every page, which of its blocks are article; pages of like length are read together."""
    out: list[np.ndarray] = [np.empty(0, bool)] * len(parsed)
    order = sorted((k for k in range(len(parsed)) if parsed[k]), key=lambda k: len(parsed[k]))
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * len(parsed[order[stop]]) <= BATCH_CELLS:
            stop += 1
        x, mask = _padded([vectors(parsed[k]) for k in order[at:stop]])
        scores = model.scores(x, mask)
        for place, k in enumerate(order[at:stop]):
            out[k] = scores[: len(parsed[k]), place] > 0.5
        at = stop
    return out


def sampled(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> list[str]:
    """About ``SAMPLE`` pages, at most twice as many, chosen by the hash of id and url: pages
    below a hash that their number sets, so tasks send the driver nothing but these."""
    short = pages.where(F.length(html_col).between(1, SAMPLE_CHARS))
    n = short.count()
    if not n:
        return []
    cut = min(1.0, SAMPLE / n) * 2**63
    chosen = short.where(F.xxhash64(id_col, url_col).bitwiseAND(2**63 - 1) <= min(int(cut), 2**63 - 1))
    return [r[0] for r in chosen.select(html_col).limit(2 * SAMPLE).collect()]


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; row by row, without a shuffle."""
    model = fit(sampled(pages, id_col, url_col, html_col))

    def work(batches):
        for batch in batches:
            texts = []
            column = batch.column(2)
            for at in range(0, len(column), 256):
                parsed = [blocks(p) if p else [] for p in column.slice(at, 256).to_pylist()]
                texts += ["\n".join(t for (_, t, _), keep in zip(b, mine) if keep) for b, mine in zip(parsed, label(model, parsed))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

    kind = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    schema = f"`{id_col}` {kind[id_col]}, `{url_col}` {kind[url_col]}, text string, n_chars long"
    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(work, schema)
