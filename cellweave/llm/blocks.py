"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks. Each block is a vector: hashed tags, classes and ids of the path to it,
hashed words, and its length, share of links and place. A bidirectional LSTM in numpy reads the whole sequence in
both directions, so that every block is judged in the context of the document, and labels each as main text or not.

The labeller is trained on a sample of pages of bounded size (``fit_pages``, chosen by a hash of the id). Their labels
come from elements that say what they are (article, nav, footer and the like), and their blocks are also set into
other layouts with known labels, so that pages without such elements can be judged by words and context. Training is one
task on the sample; labelling reads every whole page in place, without a shuffle.

Forms, scripts, styles and the head are left out while the page is read. Character references are decoded, white
space in a block becomes one space, and blocks are joined by line breaks in the order of the page.

Defined cases: a null or empty page has no text; text outside of any element is a block; unclosed elements end with their
parent or the page; repeated rows are labelled each; with no page to learn from, layouts of stand-in words are.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("button datalist form head noscript object select svg template".split())
RAW = "script|style|textarea|title|iframe|xmp"

MAIN = frozenset("article main content story entry".split())
ASIDE = frozenset("ad ads advert advertisement aside banner breadcrumb breadcrumbs comment comments cookie footer header menu modal nav "
                  "navbar newsletter notice popup promo related share sidebar social sponsor subscribe widget".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S | re.I)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")
_WORD = re.compile(r"\w+")

PATH, WORDS, MORE = 96, 32, 4
WIDTH = PATH + WORDS + MORE


@dataclass(frozen=True)
class Fit:
    """At most ``fit_pages`` pages are learned from."""

    fit_pages: int = 240
    hidden: int = 16
    epochs: int = 12
    batch: int = 24
    rate: float = 0.01
    seed: int = 7


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int


def read_blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in its order, without what is never text."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = linked = hidden = 0
    at = 0
    page = page or ""

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            path = tuple(dict.fromkeys(t for _, names in stack for t in names))
            found.append(Block(text, path, min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(n: int) -> None:
        nonlocal links, hidden
        while len(stack) > n:
            tag, _ = stack.pop()
            links -= tag == "a"
            hidden -= tag in LEFT_OUT

    for m in _TOKEN.finditer(page):
        if m.start() > at and not hidden:
            parts.append(page[at:m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag == "br":
            parts.append(" ")
        elif tag in INLINE:
            if tag == "a" and not hidden:
                links = max(0, links + (-1 if m["end"] else 1))
        else:
            flush()
            links = 0
            if m["end"]:
                open_ = next((n for n in range(len(stack) - 1, -1, -1) if stack[n][0] == tag), None)
                if open_ is not None:
                    close(open_)
            elif tag not in VOID and not m["attrs"].endswith("/"):
                if stack and (stack[-1][0] == "p" or stack[-1][0] == tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                    close(len(stack) - 1)
                if not (tag in ("html", "body") and stack and any(t == tag for t, _ in stack)):
                    if tag == "body":
                        close(sum(t == "html" for t, _ in stack[:1]))
                    names = (w for g in _NAMES.findall(m["attrs"]) for w in _PART.findall("".join(g).lower())) if m["attrs"] else ()
                    stack.append((tag, (tag, *(f".{w}" for w in names))))
                    hidden += tag in LEFT_OUT
    if at < len(page) and not hidden:
        parts.append(page[at:])
    flush()
    return found


_BUCKETS: dict[str, tuple[int, float]] = {}


def _bucket(name: str, size: int) -> tuple[int, float]:
    """Place and sign of a hashed name; the most frequent ones are remembered."""
    if (known := _BUCKETS.get(name)) is None:
        code = zlib.crc32(name.encode("utf-8", "replace"))
        known = code % size, 1.0 if code >> 31 else -1.0
        if len(_BUCKETS) < 200_000:
            _BUCKETS[name] = known
    return known


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block."""
    out = np.zeros((len(blocks), WIDTH), dtype=np.float32)
    paths: dict[tuple[str, ...], np.ndarray] = {}
    for n, block in enumerate(blocks):
        row = out[n]
        if block.path not in paths:
            path = np.zeros(PATH, dtype=np.float32)
            for name in block.path:
                at, sign = _bucket("<" + name, PATH)
                path[at] += sign
            paths[block.path] = path
        row[:PATH] = paths[block.path]
        counts = Counter(_WORD.findall(block.text.lower()))
        total = sum(counts.values()) or 1
        for word, k in counts.items():
            at, sign = _bucket(word, WORDS)
            row[PATH + at] += sign * k / total
        row[PATH + WORDS:] = (np.log1p(len(block.text)) / 5, block.linked / len(block.text), n / len(blocks),
                              block.text[-1] in ".!?:;…")
    return out


# The labeller.

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fresh(fit: Fit) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(fit.seed)
    h = fit.hidden
    model = {}
    for d in "fb":
        model[f"{d}_in"] = rng.normal(0, 0.1, (WIDTH, 4 * h))
        model[f"{d}_rec"] = rng.normal(0, 0.1, (h, 4 * h))
        model[f"{d}_bias"] = np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)]
    model["out"] = rng.normal(0, 0.1, 2 * h)
    model["out_bias"] = np.zeros(1)
    return model


def _direction(model: dict, d: str, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
    """States at every place (places x pages x hidden), and what the way back needs. Padding passes states on."""
    n, pages, _ = x.shape
    h = model[f"{d}_rec"].shape[0]
    state, cell = np.zeros((pages, h)), np.zeros((pages, h))
    drive = x @ model[f"{d}_in"] + model[f"{d}_bias"]
    states, kept = np.zeros((n, pages, h)), []
    for t in (range(n) if d == "f" else range(n - 1, -1, -1)):
        gates = drive[t] + state @ model[f"{d}_rec"]
        i, f, o = (_sigmoid(gates[:, k * h:(k + 1) * h]) for k in range(3))
        g = np.tanh(gates[:, 3 * h:])
        new_cell = f * cell + i * g
        squashed = np.tanh(new_cell)
        m = mask[t][:, None]
        kept.append((t, state, cell, i, f, o, g, squashed))
        state, cell = m * o * squashed + (1 - m) * state, m * new_cell + (1 - m) * cell
        states[t] = state
    return states, kept


def judge(model: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Probability of main text for each place and page."""
    both = np.concatenate([_direction(model, d, x, mask)[0] for d in "fb"], axis=2)
    return _sigmoid(both @ model["out"] + model["out_bias"])


def gradients(model: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean cross entropy over the blocks, and its gradients by backpropagation through the sequence."""
    h = model["f_rec"].shape[0]
    runs = {d: _direction(model, d, x, mask) for d in "fb"}
    both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
    p = _sigmoid(both @ model["out"] + model["out_bias"])
    n = mask.sum()
    loss = -(mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / n
    delta = mask * (p - y) / n
    grads = {"out": np.einsum("tp,tph->h", delta, both), "out_bias": np.array([delta.sum()])}
    for k, d in enumerate("fb"):
        into = delta[:, :, None] * model["out"][k * h:(k + 1) * h]
        g_drive = np.zeros((*x.shape[:2], 4 * h))
        g_rec = np.zeros_like(model[f"{d}_rec"])
        g_state, g_cell = np.zeros(into.shape[1:]), np.zeros(into.shape[1:])
        for t, state, cell, i, f, o, g, squashed in reversed(runs[d][1]):
            m = mask[t][:, None]
            g_state = g_state + into[t]
            here, g_state_on, g_cell_on = m * g_state, (1 - m) * g_state, (1 - m) * g_cell
            g_new = m * g_cell + here * o * (1 - squashed ** 2)
            gates = np.concatenate([g_new * g * i * (1 - i), g_new * cell * f * (1 - f),
                                    here * squashed * o * (1 - o), g_new * i * (1 - g ** 2)], axis=1)
            g_drive[t] = gates
            g_rec += state.T @ gates
            g_state, g_cell = gates @ model[f"{d}_rec"].T + g_state_on, g_new * f + g_cell_on
        grads[f"{d}_in"] = np.einsum("tpw,tpk->wk", x, g_drive)
        grads[f"{d}_rec"] = g_rec
        grads[f"{d}_bias"] = g_drive.sum(axis=(0, 1))
    return loss, grads


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = max(len(r) for r in rows)
    x, mask = np.zeros((n, len(rows), WIDTH)), np.zeros((n, len(rows)))
    for k, r in enumerate(rows):
        x[:len(r), k], mask[:len(r), k] = r, 1
    return x, mask


def fit_model(pages: list[tuple[list[Block], list[int]]], fit: Fit) -> dict[str, np.ndarray]:
    """Adam over batches of pages of like length."""
    model = fresh(fit)
    data = sorted(((vectors(b), np.array(y, dtype=float)) for b, y in pages if b), key=lambda p: len(p[0]))
    batches = []
    for s in range(0, len(data), fit.batch):
        x, mask = padded([v for v, _ in data[s:s + fit.batch]])
        y = np.zeros(mask.shape)
        for k, (_, labels) in enumerate(data[s:s + fit.batch]):
            y[:len(labels), k] = labels
        batches.append((x, mask, y))
    mean, square = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    step = 0
    rng = np.random.default_rng(fit.seed)
    for _ in range(fit.epochs):
        for k in rng.permutation(len(batches)):
            _, grads = gradients(model, *batches[k])
            step += 1
            for name, g in grads.items():
                g = np.clip(g, -1, 1)
                mean[name] = 0.9 * mean[name] + 0.1 * g
                square[name] = 0.99 * square[name] + 0.01 * g * g
                model[name] -= fit.rate * (mean[name] / (1 - 0.9 ** step)) / (np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-8)
    return model


# Labels for training.

def told(block: Block) -> int | None:
    """What the elements around a block say it is: 1 main text, 0 not, None nothing."""
    names = [t.removeprefix(".") for t in block.path]
    if any(t in ASIDE for t in names):
        return 0
    return 1 if any(t in MAIN for t in names) else None


_AROUND_MAIN = (("article",), ("main",), ("div", ".content"), ("div", ".post", ".body"), ("section", ".story"), ("div",), ("td",),
                ("div", ".main", ".column"), ("main", "article"), ("section",))
_AROUND_REST = {
    "top": (("nav", "ul", "li"), ("header",), ("div", ".menu", "li"), ("div", ".top", ".bar"), ("div", ".header"), ("ul", "li")),
    "side": (("aside",), ("div", ".sidebar"), ("div", ".ad"), ("div", ".advert"), ("div", ".cookie", ".notice"), ("div", ".banner"),
             ("div", ".related"), ("div", ".widget"), ("div", ".promo"), ("section", ".newsletter")),
    "end": (("footer",), ("div", ".footer"), ("section", ".comments"), ("div", ".comment"), ("div", ".share"), ("ul", ".comments", "li"),
            ("div", ".copyright")),
}


def relaid(main: list[str], rest: list[str], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The texts of a page set into another layout."""
    pick = lambda options: options[rng.integers(len(options))]
    words = " ".join(rest or main).split() or ["more"]
    short = lambda: " ".join(pick(words) for _ in range(rng.integers(1, 4)))
    line = lambda: pick(rest) if rest and rng.random() < 0.7 else " ".join(pick(words) for _ in range(rng.integers(4, 16)))
    out: list[tuple[Block, int]] = []

    def add(text: str, path: tuple[str, ...], label: int, linked: bool = False) -> None:
        out.append((Block(text, ("html", "body", *path), len(text) if linked else 0), label))

    top = pick(_AROUND_REST["top"])
    for _ in range(rng.integers(2, 8)):
        add(short(), top, 0, rng.random() < 0.8)
    around = pick(_AROUND_MAIN)
    for n, text in enumerate(main):
        if rng.random() < 0.08:
            add(line(), (*(around if rng.random() < 0.5 else ()), *pick(_AROUND_REST["side"])), 0)
        add(text, (*around, "h1" if n == 0 and rng.random() < 0.7 else "p"), 1)
    for kind in ("side", "end"):
        place = pick(_AROUND_REST[kind])
        for _ in range(rng.integers(1, 4)):
            add(line(), (*place, *(("p",) if rng.random() < 0.5 else ())), 0, rng.random() < 0.3)
    return [b for b, _ in out], [y for _, y in out]


_STAND_IN = "<nav><a href=x>Home</a></nav><article><h1>A title</h1><p>Some words of a text that has a few of them.</p></article><footer>End</footer>"


def lessons(pages: list[str], fit: Fit) -> list[tuple[list[Block], list[int]]]:
    rng = np.random.default_rng(fit.seed)
    out = []
    for page in pages or [_STAND_IN] * 20:
        blocks = read_blocks(page)
        labels = [told(b) for b in blocks]
        if 1 not in labels:
            continue
        out.append((blocks, [y or 0 for y in labels]))
        out.append(relaid([b.text for b, y in zip(blocks, labels, strict=True) if y == 1],
                          [b.text for b, y in zip(blocks, labels, strict=True) if y == 0], rng))
    return out or lessons([], fit)


def main_texts(model: dict, pages: list[str | None], batch: int = 64) -> list[str]:
    """Main text of each page; pages of like length are read together."""
    read = [read_blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if read[k]), key=lambda k: len(read[k]))
    at = 0
    while at < len(order):
        size = min(batch, max(1, 200_000 // len(read[order[min(at + batch, len(order)) - 1]])))
        some = order[at:at + size]
        x, mask = padded([vectors(read[k]) for k in some])
        share = judge(model, x, mask)
        for n, k in enumerate(some):
            out[k] = "\n".join(b.text for b, p in zip(read[k], share[:, n], strict=False) if p >= 0.5)
        at += len(some)
    return out


def trained(pages: DataFrame, key: str = "page_id", page: str = "html", fit: Fit = Fit()) -> dict[str, np.ndarray]:
    """A model fitted in one task on the sample, the pages with the smallest hash of the id."""
    place = F.pmod(F.xxhash64(f"`{key}`", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    n = pages.count()
    rows = pages.select(place.alias("place"), F.col(f"`{page}`").alias("page")).where("page is not null").where(
        F.col("place") * n < fit.fit_pages + 6 * fit.fit_pages ** 0.5 + 20).orderBy("place", "page").limit(fit.fit_pages)
    names = sorted(fresh(fit))

    def learn(batch: pd.DataFrame) -> pd.DataFrame:
        model = fit_model(lessons(sorted(batch["page"]), fit), fit)
        return pd.DataFrame({"name": names, "shape": [list(model[k].shape) for k in names], "value": [model[k].ravel().tolist() for k in names]})

    found = rows.select(F.lit(0).alias("one"), "page").groupBy("one").applyInPandas(
        lambda pdf: learn(pdf), "name string, shape array<int>, value array<double>").collect()
    return {r["name"]: np.array(r["value"]).reshape(r["shape"]) for r in found} or fit_model(lessons([], fit), fit)


def extracted(pages: DataFrame, key: str = "page_id", page: str = "html", fit: Fit = Fit()) -> DataFrame:
    """All columns of ``pages`` packed as ``page``, with ``text``."""
    shared = pages.sparkSession.sparkContext.broadcast(trained(pages, key, page, fit))

    @F.pandas_udf("string")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(main_texts(shared.value, list(batch)), dtype=object)

    return pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"), label(F.col(f"`{page}`")).alias("text"))
