"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between the tags of block-level elements, each with the
path of open elements. A block becomes a vector of hashed path and attribute names, hashed words
and a few measures. A bidirectional LSTM in numpy reads the blocks of a page in order, both ways, and
gives each the probability that it is main text, so that every decision sees the whole page.

The labeller is fitted on ``PAGES`` pages made by ``made_pages``: layouts with semantic elements, with
named divisions or with tables, in random order, around invented prose, where each block's part is
known. Fitting is fixed by ``SEED`` and takes some seconds on the driver; the weights are of one size.

Cases: a null or empty page has no text. Scripts, styles, templates, comments and the head are never
text. Broken markup is read as it comes: elements that are not closed end with their parents, an
unclosed comment or script takes the rest. Blocks without a letter or digit are kept or dropped like
others. Repeated rows are treated alike. Extra columns pass; a clashing output name is replaced.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices

PATHS, WORDS = 256, 64
MEASURES = 8
INPUT = PATHS + WORDS + MEASURES
HIDDEN = 24
PAGES, EPOCHS, BATCH, RATE, SEED = 3000, 6, 16, 0.006, 3
CHUNK_BLOCKS = 40_000

#: Comments, declarations and tags. A quote opens a value only after an equals sign; what was read of a tag is never
#: read again, so a tag that nothing closes costs one pass to the end of the page.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"\w+")
SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_ELEMENTS = frozenset("script style noscript template iframe svg object textarea head title".split())
RAW = frozenset("script style textarea title".split())
#: Elements that a head may hold; any other, or text, ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: What ends when an element starts: an open element of these names, not beyond the stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSES_PARAGRAPH = frozenset(
    "p div ul ol dl table section article aside header footer nav main form h1 h2 h3 h4 h5 h6 blockquote pre hr "
    "fieldset figure figcaption address details".split()
)

Block = tuple[str, tuple[str, ...], int, int]  # text, path, letters in links, fresh start of an element


def split_names(attributes: str) -> list[str]:
    """Parts of class, id, role and label names, in lower case."""
    found = []
    for match in NAMES.finditer(attributes):
        found += [p for p in re.split(r"[^a-zA-Z]+", next(g for g in match.groups() if g is not None).lower()) if p]
    return found


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order."""
    page = page or ""
    stack: list[tuple[str, tuple[str, ...]]] = []
    out: list[Block] = []
    held: list[str] = []
    linked = hidden = links = 0

    def close() -> None:
        nonlocal linked
        text = SPACE.sub(" ", "".join(held)).strip()
        if text:
            path = tuple(part for name, marks in stack if name not in INLINE for part in (name, *marks))
            out.append((text, path, min(linked, len(text)), len(stack)))
        held.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal hidden, links
        for name, _ in stack[to:]:
            hidden -= name in HIDDEN_ELEMENTS
            links -= name == "a"
        if any(name not in INLINE for name, _ in stack[to:]):
            close()
        del stack[to:]

    def text(part: str) -> None:
        nonlocal linked
        if stack and stack[-1][0] == "head" and part.strip():
            pop(len(stack) - 1)
        if part and not hidden:
            part = html.unescape(part)
            held.append(part)
            if links:
                linked += len(part.strip())

    at = 0
    while True:
        found = TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if found[1]:
            for place in range(len(stack) - 1, -1, -1):
                if stack[place][0] == name:
                    pop(place)
                    break
                if name in INLINE and stack[place][0] not in INLINE:
                    break
            else:
                if name == "p":
                    close()
            continue
        if stack and stack[-1][0] == "head" and name not in IN_HEAD:
            pop(len(stack) - 1)
        if name == "br":
            held.append(" ")
            continue
        if name not in INLINE:
            close()
            if name in CLOSES_PARAGRAPH:
                for place in range(len(stack) - 1, -1, -1):
                    if stack[place][0] == "p":
                        pop(place)
                        break
                    if stack[place][0] not in INLINE:
                        break
            if name in ENDS:
                ends, stops = ENDS[name]
                for place in range(len(stack) - 1, -1, -1):
                    if stack[place][0] in stops:
                        break
                    if stack[place][0] in ends:
                        pop(place)
                        if name != "tr":
                            break
        if name in VOID:
            continue
        if name == "body":
            pop(0)
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            if name in ("script", "style", "title", "textarea"):
                at = end.start() if end else len(page)
        if not found[3].rstrip().endswith("/") or name in INLINE or name in CLOSES_PARAGRAPH:
            stack.append((name, tuple(split_names(found[3]))))
            hidden += name in HIDDEN_ELEMENTS
            links += name == "a"
    pop(0)
    close()
    return out


def slot(part: str, size: int) -> int:
    """A stable hash of a name or word."""
    value = 2166136261
    for c in part.encode("utf-8", "surrogatepass"):
        value = (value ^ c) * 16777619 & 0xFFFFFFFF
    return (value ^ (value >> 15)) % size


class Slots(dict):
    """Remembered slots of names or words, up to a bound."""

    def __init__(self, size: int, most: int = 200_000):
        super().__init__()
        self.size, self.most = size, most

    def __missing__(self, part: str) -> int:
        value = slot(part, self.size)
        if len(self) < self.most:
            self[part] = value
        return value


PATH_SLOTS, WORD_SLOTS = Slots(PATHS), Slots(WORDS)


def features(blocks: list[Block]) -> np.ndarray:
    """A row per block; all values lie between -2 and 2."""
    at, values = [], []
    for i, (text, path, linked, depth) in enumerate(blocks):
        start = i * INPUT
        near = path[-4:][::-1]
        at += [start + PATH_SLOTS[p] for p in path]
        values += [0.5] * len(path)
        at += [start + PATH_SLOTS[p] for p in near]
        values += [0.5] * len(near)
        words = WORD.findall(text.lower())
        start += PATHS
        at += [start + WORD_SLOTS[w] for w in words]
        values += [1 / math.sqrt(len(words) or 1)] * len(words)
        start += WORDS
        n, last = len(text), text[-1]
        stops = text.count(". ") + text.count("? ") + text.count("! ") + (last in ".!?\"'”»")
        at += range(start, start + MEASURES)
        values += (math.log1p(n) / 8, linked / n, min(stops, 5) / 5, last in ".!?", n < 25, min(depth, 20) / 20, i / len(blocks), "©" in text)
    out = np.bincount(at, values, minlength=len(blocks) * INPUT).astype(np.float32)
    return np.clip(out, -2, 2).reshape(len(blocks), INPUT)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Direction:
    """One LSTM over (time, page, feature) arrays; gates in the order input, forget, output, cell."""

    def __init__(self, rng: np.random.Generator):
        self.inward = (rng.normal(size=(INPUT, 4 * HIDDEN)) / np.sqrt(INPUT)).astype(np.float32)
        self.around = (rng.normal(size=(HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
        self.bias = np.zeros(4 * HIDDEN, dtype=np.float32)
        self.bias[HIDDEN : 2 * HIDDEN] = 1

    def weights(self) -> list[np.ndarray]:
        return [self.inward, self.around, self.bias]

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        steps, pages, _ = x.shape
        h, c = (np.zeros((pages, HIDDEN), dtype=np.float32) for _ in range(2))
        driven = (x.reshape(-1, INPUT) @ self.inward + self.bias).reshape(steps, pages, -1)
        out, memory = np.empty((steps, pages, HIDDEN), dtype=np.float32), []
        for t in range(steps):
            z = driven[t] + h @ self.around
            gates = sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            fresh = f * c + i * g
            squashed = np.tanh(fresh)
            m = mask[t][:, None]
            if keep:
                memory.append((h, c, i, f, o, g, squashed, m))
            c = m * fresh + (1 - m) * c
            h = m * (o * squashed) + (1 - m) * h
            out[t] = h
        return out, memory

    def backward(self, x: np.ndarray, memory: list, down: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights, given those of the outputs."""
        steps, pages, _ = x.shape
        dh, dc = (np.zeros((pages, HIDDEN), dtype=np.float32) for _ in range(2))
        dz_all = np.empty((steps, pages, 4 * HIDDEN), dtype=np.float32)
        around = np.zeros_like(self.around)
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, g, squashed, m = memory[t]
            dh = dh + down[t]
            own = m * dh
            dfresh = m * dc + own * o * (1 - squashed**2)
            dz = np.concatenate(
                [dfresh * g * i * (1 - i), dfresh * c * f * (1 - f), own * squashed * o * (1 - o), dfresh * i * (1 - g**2)], axis=1
            )
            dz_all[t] = dz
            around += h.T @ dz
            dh = (1 - m) * dh + dz @ self.around.T
            dc = (1 - m) * dc + dfresh * f
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        return [x.reshape(-1, INPUT).T @ flat, around, flat.sum(axis=0)]


class Labeller:
    """Two directions and a logistic layer over both."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.ahead, self.back = Direction(rng), Direction(rng)
        self.top = (rng.normal(size=2 * HIDDEN) / np.sqrt(2 * HIDDEN)).astype(np.float32)
        self.base = np.zeros(1, dtype=np.float32)

    def weights(self) -> list[np.ndarray]:
        return [*self.ahead.weights(), *self.back.weights(), self.top, self.base]

    def chances(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probability of main text per (time, page)."""
        a, _ = self.ahead.forward(x, mask)
        b, _ = self.back.forward(x[::-1], mask[::-1])
        return sigmoid(np.concatenate([a, b[::-1]], axis=2) @ self.top + self.base)

    def gradients(self, x: np.ndarray, mask: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
        a, first = self.ahead.forward(x, mask, keep=True)
        b, second = self.back.forward(x[::-1], mask[::-1], keep=True)
        both = np.concatenate([a, b[::-1]], axis=2)
        error = (sigmoid(both @ self.top + self.base) - truth) * mask / mask.sum()
        down = error[:, :, None] * self.top
        ahead = self.ahead.backward(x, first, down[:, :, :HIDDEN])
        back = self.back.backward(x[::-1], second, down[::-1, :, HIDDEN:])
        return [*ahead, *back, np.einsum("tbh,tb->h", both, error), np.array([error.sum()])]

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> Labeller:
        """Adam over batches of pages of like length."""
        rng = np.random.default_rng(SEED)
        first, second = ([np.zeros_like(w) for w in self.weights()] for _ in range(2))
        step = 0
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for epoch in range(epochs):
            rate = RATE * (1 - 0.7 * epoch / max(1, epochs - 1))
            for k in rng.permutation(len(batches)):
                x, mask, truth = padded([pages[i] for i in batches[k]])
                step += 1
                for w, g, m, v in zip(self.weights(), self.gradients(x, mask, truth), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g**2 - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        return self


def padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(y) for _, y in pages)
    x = np.zeros((steps, len(pages), INPUT), dtype=np.float32)
    mask, truth = (np.zeros((steps, len(pages)), dtype=np.float32) for _ in range(2))
    for k, (own, y) in enumerate(pages):
        x[: len(y), k], mask[: len(y), k], truth[: len(y), k] = own, 1, y
    return x, mask, truth


def main_text(labeller: Labeller, pages: list[str | None]) -> list[str]:
    """The main text of each page: its main blocks, two line breaks between."""
    parts = [blocks_of(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, b in enumerate(parts) if b), key=lambda i: len(parts[i]))
    at = 0
    while at < len(order):
        end, shortest = at + 1, len(parts[order[at]])
        while end < len(order) and len(parts[order[end]]) <= 2 * shortest + 8 and (end - at + 1) * len(parts[order[end]]) <= CHUNK_BLOCKS:
            end += 1
        chunk = order[at:end]
        x, mask, _ = padded([(features(parts[i]), np.zeros(len(parts[i]))) for i in chunk])
        chances = labeller.chances(x, mask)
        for k, i in enumerate(chunk):
            out[i] = "\n\n".join(b[0] for b, p in zip(parts[i], chances[:, k], strict=False) if p >= 0.5)
        at = end
    return out


def extracted(frame: DataFrame, labeller: Labeller, page: str = "html") -> DataFrame:
    """The frame without ``page``, with text and n_chars."""
    kept = [c for c in frame.columns if c.lower() not in (page.lower(), "text", "n_chars")]
    base = frame.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{page}`").cast("string").alias(page))
    at = len(kept)
    shared = frame.sparkSession.sparkContext.broadcast(labeller)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            texts = main_text(shared.value, part.column(at).to_pylist())
            new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns[:at], *new], names=[*kept, "text", "n_chars"])

    types = "".join(f"`{c}` {base.schema[c].dataType.simpleString()}, " for c in kept)
    return base.mapInArrow(run, f"{types}text string, n_chars bigint")
