"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text without a block-level tag between, each with its path of open elements. A
bidirectional LSTM in numpy reads the sequence of blocks; a block's input is its tag path (tags, and words of class, id
and role, hashed) and its words (hashed counts). It labels every block main text or not, knowing the whole page.

There are no labelled pages, so the labeller learns from weak labels on at most `PAGES` pages (those with the smallest
hashes of page_id): elements and class words that name page furniture (fixed lists below) mark blocks as such, also in
rewrapped copies of those pages, whose own blocks are put in other containers, so that furniture is known by many names.

Text: character references decoded, white space in a block one space, ends trimmed, blocks joined by one \\n. Markup that
never closes runs to the end of the page; <svg/> and <math/> are closed. A null html has no text. Every page is read whole; pages are independent, so
repeated rows get equal results; of a page_id with several pages the learner reads the first in order. Memory and time
grow with the page's length, however deep its elements nest. A null page_id or url is passed on. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
import sys
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm import folds, textcore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES, COPIES, EPOCHS = 200, 5, 8
PATH_BITS, WORD_COLUMNS, HIDDEN = 9, 32, 16
MOST = 400  # blocks of a training page after which another sequence begins

# Fixed lists: HTML's own element kinds, and usual names of page furniture.
RAW = "script style noscript template iframe svg math textarea object canvas".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCKS = "p"
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FURNITURE_TAGS = set("head title nav header footer aside form menu dialog button select fieldset figcaption".split())
MAIN_TAGS = set("article main p section div td h1 h2 h3 blockquote pre ul ol".split())
FURNITURE_WORDS = """ad ads advert advertisement adverts banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notification alert
 menu nav navbar navigation breadcrumb breadcrumbs sidebar side widget related recommended share sharing social comment comments reply replies respond
 footer foot header masthead subscribe subscription newsletter signup popup modal overlay login search copyright legal disclaimer toolbar pagination
 pager tags byline meta skip topbar bottom contentinfo complementary""".split()
MAIN_CONTAINERS = [["article"], ["main"], ["main", "article"], ["div.content"], ["div.post"], ["div.entry-content"], ["section.story"], ["div.article-body"],
                   ["div#main", "div.text"], ["div.page", "div.body"], ["section"], ["div"], ["div.wrapper", "div.container", "article.post"]]
FURNITURE_CONTAINERS = [["nav", "ul", "li", "a"], ["header"], ["footer"], ["aside"], ["form"], ["form", "label"], ["header", "nav", "ul", "li", "a"], ["aside", "ul", "li", "a"],
                        ["form", "button"], ["footer", "p"], ["aside", "p"], ["header", "h1"], ["header", "p"]]

# The rest of <svg .../> and <math .../>, which end there; a slash that ends an unquoted value belongs to the value.
SELF_CLOSED = r"(?:(?<=<svg)|(?<=<math))(?:[^>\"'=/]++|/(?!>)|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+|\"[^\"]*+\"|'[^']*+')*+/>"
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")(?=[\s/>])(?:" + SELF_CLOSED + r"|[^>]*+>.*?(?:</\1\s*+>|\Z))|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S | re.I)
NAMED = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.I)
PART = re.compile(r"[a-z]+")


def column(mark: str) -> int:
    return zlib.crc32(mark.encode()) >> (32 - PATH_BITS)


#: What a path of open elements tells: the columns of its tags and words as bits, the last tag, whether a step names
#: furniture, whether one may hold main text. Its size does not grow with the depth.
Place = tuple[int, str, bool, bool]
TOP: Place = (0, "", False, False)


def step_marks(step: str) -> Place:
    """Of one step: a tag with its class words, like `div.side.menu`."""
    tag, *words = step.split(".")
    bits = 0
    for mark in (f"tag {tag}", *(f"word {w}" for w in words)):
        bits |= 1 << column(mark)
    return bits, tag, tag in FURNITURE_TAGS or any(w in FURNITURE_WORDS for w in words), tag in MAIN_TAGS


def below(place: Place, step: Place) -> Place:
    return place[0] | step[0], step[1], place[2] or step[2], place[3] or step[3]


def place_of(steps: Iterable[str]) -> Place:
    place = TOP
    for step in steps:
        place = below(place, step_marks(step))
    return place


def blocks(page: str) -> list[tuple[Place, str]]:
    """(place, text) of the leaf blocks."""
    out: list[tuple[Place, str]] = []
    stack: list[Place] = []
    names: list[str] = []
    count: Counter[str] = Counter()  # of the open elements by name
    known: dict[str, Place] = {}
    held: list[str] = []
    place: Place | None = None

    def close() -> None:
        nonlocal held, place
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((place or TOP, text))
        held, place = [], None

    def text(piece: str) -> None:
        nonlocal place
        if place is None and not piece.isspace():
            place = stack[-1] if stack else TOP
        held.append(piece)

    def pop(name: str) -> None:
        """Leave the innermost element of that name."""
        while names:
            last = names.pop()
            stack.pop()
            count[last] -= 1
            if last == name:
                return

    at = 0
    for m in TAG.finditer(page):
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        end, name, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not name:
            if m[1]:
                held.append(" ")
            continue
        name = name.lower()
        inline = name in INLINE
        if name == "br":
            held.append(" ")
            continue
        if not inline:
            close()
        if end:
            if count[name]:
                pop(name)
            continue
        if name in VOID:
            continue
        if not inline and count[CLOSED_BY_BLOCKS]:
            pop(CLOSED_BY_BLOCKS)
        if name in SIBLINGS and any(count[x] for x in SIBLINGS[name]):
            for other in reversed(names):
                if other in SIBLINGS[name]:
                    pop(other)
                    break
                if other in ("ul", "ol", "dl", "table", "select", "tbody"):
                    break
        step = name
        if "=" in attributes:
            words = dict.fromkeys(w for a in NAMED.findall(attributes) for w in PART.findall("".join(a).lower()))
            if words:
                step = ".".join([name, *words])
        if not attributes.endswith("/") or not inline:
            if step not in known:
                known[step] = step_marks(step)
            stack.append(below(stack[-1] if stack else TOP, known[step]))
            names.append(name)
            count[name] += 1
    if at < len(page):
        text(page[at:])
    close()
    return out


def is_furniture(place: Place) -> bool:
    """The weak label: a step names furniture, or none may hold main text."""
    return place[2] or not place[3]


def rewrapped(page: list[tuple[Place, str]], rng: np.random.Generator) -> list[tuple[Place, str]]:
    """The blocks of a page in other containers, furniture before, within and after the main text."""
    main = [(p, t) for p, t in page if not is_furniture(p)]
    rest = [t for p, t in page if is_furniture(p)] or ["menu"]
    prose = [t for _, t in main] or rest

    def furniture() -> list[tuple[tuple[str, ...], str]]:
        if rng.random() < 0.5:
            path = FURNITURE_CONTAINERS[rng.integers(len(FURNITURE_CONTAINERS))]
        else:
            word = FURNITURE_WORDS[rng.integers(len(FURNITURE_WORDS))]
            path = [f"{rng.choice(['div', 'section', 'ul', 'p', 'span', 'div'])}.{word}", *([] if rng.random() < 0.5 else ["p"])]
        texts = [prose[rng.integers(len(prose))] if rng.random() < 0.5 else rest[rng.integers(len(rest))] for _ in range(rng.integers(1, 5))]
        return [(("html", "body", *path), t) for t in texts]

    box = MAIN_CONTAINERS[rng.integers(len(MAIN_CONTAINERS))]
    box = [x.replace("#", ".") for x in box]
    inner = [(("html", "body", *box, *(("h1",) if i == 0 else (str(rng.choice(["p", "p", "p", "p", "h2", "li", "blockquote"])),))), t) for i, (_, t) in enumerate(main)]
    within = int(rng.integers(len(inner) + 1))
    if rng.random() < 0.5:
        extra = [(("html", "body", *box, *p[2:]), t) for p, t in furniture()]
        inner = inner[:within] + extra + inner[within:]
    front = [x for _ in range(rng.integers(1, 4)) for x in furniture()]
    back = [x for _ in range(rng.integers(1, 4)) for x in furniture()]
    made = [(("html", "head", "title"), prose[0])] + front + inner + back
    return [(place_of(p), t) for p, t in made]


def path_columns(place: Place) -> list[int]:
    bits = place[0] | 1 << column(f"last {place[1]}" if place[1] else "none")
    return [i for i in range(1 << PATH_BITS) if bits >> i & 1]


class Encoder:
    """Input of the network. One object per task."""

    def __init__(self) -> None:
        self.words = textcore.Words()

    def word_vectors(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), WORD_COLUMNS), np.float32)
        for a, b, data, offs in textcore.pieces(pa.array(texts, pa.large_string())):
            h, at = self.words.hashes(data, offs)
            row = np.repeat(np.arange(b - a), np.diff(at))
            cell = row * WORD_COLUMNS + (h >> np.uint64(59)).astype(np.int64)
            out[a:b] = np.bincount(cell, minlength=(b - a) * WORD_COLUMNS).reshape(b - a, WORD_COLUMNS)
        return np.log1p(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Labeller:
    """Bidirectional LSTM over blocks with a logistic output."""

    SHAPES = {"path": (1 << PATH_BITS, 8 * HIDDEN), "words": (WORD_COLUMNS, 8 * HIDDEN), "bias": (8 * HIDDEN,), "forward": (HIDDEN, 4 * HIDDEN),
              "backward": (HIDDEN, 4 * HIDDEN), "out": (2 * HIDDEN,), "skip": (1 << PATH_BITS,), "shift": (1,)}

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.w = weights or {k: (rng.normal(0, 0.1, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in self.SHAPES.items()}
        if weights is None:
            self.w["bias"][HIDDEN:2 * HIDDEN] = self.w["bias"][5 * HIDDEN:6 * HIDDEN] = 1  # remember at first
            self.w["out"] = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)

    def inputs(self, paths: np.ndarray, of: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gate inputs and direct scores of blocks. paths: distinct paths as rows of 0 and 1; of: each block's row."""
        return (paths @ self.w["path"])[of] + words @ self.w["words"] + self.w["bias"], (paths @ self.w["skip"])[of]

    def run(self, gates: np.ndarray, mask: np.ndarray, name: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (steps x pages x HIDDEN) of one direction; gates and mask are in reading order."""
        steps, n, _ = gates.shape
        h, c, out = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps):
            z = gates[t] + h @ self.w[name]
            s = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            before, new = c, f * c + i * g
            th = np.tanh(new)
            if keep is not None:
                keep.append((h, before, i, f, o, g, th, m))
            c, h = np.where(m, new, c), np.where(m, o * th, h)
            out[t] = h
        return out

    def scores(self, gates: np.ndarray, direct: np.ndarray, mask: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        f = self.run(gates[:, :, :4 * HIDDEN], mask, "forward", keep and keep[0])
        b = self.run(gates[::-1, :, 4 * HIDDEN:], mask[::-1], "backward", keep and keep[1])[::-1]
        both = np.concatenate([f, b], axis=2)
        return both @ self.w["out"] + direct + self.w["shift"], both

    def gradients(self, paths, of, words, mask, y) -> dict[str, np.ndarray]:
        """of, y: steps x pages; words: steps x pages x WORD_COLUMNS."""
        gates, direct = self.inputs(paths, of, words)
        keep: tuple[list, list] = ([], [])
        score, both = self.scores(gates, direct, mask, keep)
        off = np.where(mask, _sigmoid(score) - y, 0).astype(np.float32) / mask.sum()
        g = {"out": np.einsum("tn,tnh->h", off, both), "shift": np.array([off.sum()], np.float32)}
        d_gates = np.zeros_like(gates)
        d_both = off[:, :, None] * self.w["out"]
        for name, cache, d_h, part in (("forward", keep[0], d_both[:, :, :HIDDEN], slice(0, 4 * HIDDEN)),
                                       ("backward", keep[1], d_both[::-1, :, HIDDEN:], slice(4 * HIDDEN, None))):
            dw = np.zeros_like(self.w[name])
            dh_next = dc_next = np.zeros(d_h.shape[1:], np.float32)
            target = d_gates[:, :, part] if name == "forward" else d_gates[::-1, :, part]
            for t in range(len(cache) - 1, -1, -1):
                h, c, i, f, o, gg, th, m = cache[t]
                dh = d_h[t] + dh_next
                dc = dc_next + dh * o * (1 - th * th)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - gg * gg)], axis=1) * m
                target[t] = dz
                dw += h.T @ dz
                dh_next = np.where(m, dz @ self.w[name].T, dh)
                dc_next = np.where(m, dc * f, dc_next)
            g[name] = dw
        flat, rows = d_gates.reshape(-1, d_gates.shape[2]), of.ravel()
        per_path = np.zeros((len(paths), flat.shape[1]), np.float32)
        np.add.at(per_path, rows, flat)
        g["path"], g["words"], g["bias"] = paths.T @ per_path, words.reshape(-1, WORD_COLUMNS).T @ flat, flat.sum(axis=0)
        g["skip"] = paths.T @ np.bincount(rows, off.ravel(), len(paths)).astype(np.float32)
        return g


class Batch:
    """Pages of similar length as padded arrays."""

    def __init__(self, pages: list[list[tuple[Place, str]]], encoder: Encoder) -> None:
        index: dict[Place, int] = {TOP: 0}
        steps, n = max(map(len, pages)), len(pages)
        self.of, self.mask = np.zeros((steps, n), np.int64), np.zeros((steps, n), bool)
        self.words = np.zeros((steps, n, WORD_COLUMNS), np.float32)
        vectors = encoder.word_vectors([t for page in pages for _, t in page])
        at = 0
        for j, page in enumerate(pages):
            self.of[:len(page), j] = [index.setdefault(p, len(index)) for p, _ in page]
            self.mask[:len(page), j] = True
            self.words[:len(page), j] = vectors[at:at + len(page)]
            at += len(page)
        self.paths = np.zeros((len(index), 1 << PATH_BITS), np.float32)
        for p, i in index.items():
            self.paths[i, path_columns(p)] = 1


def train(pages: list[str]) -> dict[str, np.ndarray]:
    """Weights from weak labels on the pages and on rewrapped copies."""
    rng, encoder, net = np.random.default_rng(11), Encoder(), Labeller()
    real = [b for b in map(blocks, pages) if b]
    made = real + [rewrapped(b, rng) for b in real for _ in range(COPIES)]
    parts = sorted((b[i:i + MOST] for b in made for i in range(0, len(b), MOST)), key=len)
    groups = [parts[i:i + 48] for i in range(0, len(parts), 48)]
    batches = [(Batch(g, encoder), np.zeros(0)) for g in groups]
    labels = []
    for (batch, _), group in zip(batches, groups):
        y = np.zeros(batch.mask.shape, np.float32)
        for j, page in enumerate(group):
            y[:len(page), j] = [not is_furniture(p) for p, _ in page]
        labels.append(y)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v = {k: np.zeros_like(x) for k, x in net.w.items()}
    t = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(batches)):
            b, t = batches[i][0], t + 1
            for k, g in net.gradients(b.paths, b.of, b.words, b.mask, labels[i]).items():
                g = np.clip(g, -1, 1)
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                net.w[k] -= (0.03 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return net.w


def label(pages: list[list[tuple[Place, str]]], net: Labeller, encoder: Encoder) -> list[np.ndarray]:
    """For each page, which of its blocks are main text."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
    at = 0
    while at < len(order):
        size = max(1, min(128, 20_000 // len(pages[order[min(at + 127, len(order) - 1)]])))
        some = order[at:at + size]
        b = Batch([pages[i] for i in some], encoder)
        score, _ = net.scores(*net.inputs(b.paths, b.of, b.words), b.mask)
        for j, i in enumerate(some):
            out[i] = score[:len(pages[i]), j] > 0
        at += size
    return out


def extractor(sent) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, encoder = Labeller(sent.value), Encoder()
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.slice(i, 512)
                cut = [blocks(x or "") for x in part.column(2).to_pylist()]
                texts = ["\n".join(t for (_, t), on in zip(page, keep) if on) for page, keep in zip(cut, label(cut, net, encoder))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return task


def learn(pages: DataFrame) -> dict[str, np.ndarray]:
    known = pages.where("html IS NOT NULL AND page_id IS NOT NULL")
    ids = folds.sample(known.select("page_id").distinct(), PAGES, "page_id")
    rows = known.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).collect()  # at most PAGES pages
    return train([r["html"] for r in sorted(rows, key=lambda r: r["page_id"])]) if rows else Labeller().w


def extract(pages: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(weights)
    return pages.select("page_id", "url", "html").mapInArrow(extractor(sent), "page_id long, url string, text string, n_chars long")
