"""Main text of web pages by a recurrent block labeller.

A page is read into leaf blocks, the runs of text between block-level tags.
Each block has a vector of its tag path (tags, classes and ids of its
ancestors, hashed), of its words (hashed) and of a few measures. A bidirectional
LSTM reads a page's blocks in order and back, so a block is judged in the
context of the whole page, and says for every block whether it is main text.

The pages carry no labels. The network learns from a bounded sample of them
(``max_pages``) whose blocks are labelled by the names of their ancestors, and
into which blocks of further kinds (notices, forms, sidebars, reader comments)
are set at random places, built from the sample's own words. It is trained on
the driver in a fixed order, so equal inputs give equal networks; every page is
read whole.

Defined results: null and empty html has no block and the text is empty. Null
ids and urls are kept. Equal pages get equal texts; an empty table no rows.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Cache

#: Pages to learn from at most, and blocks and words of each that training looks at.
MAX_PAGES, MAX_BLOCKS, MAX_WORDS = 300, 64, 60
PATH_CELLS, WORD_CELLS, MEASURES, HIDDEN = 192, 32, 5, 12
ROUNDS, RATE = 60, 0.03
#: Cells (pages times blocks) that are labelled at a time.
CELLS = 1 << 15

# HTML's elements by how they are read.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre section select summary table tbody td tfoot th thead title tr ul xmp".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup and not shown; without an end tag they reach to the end of the page.
RAW_TAGS = frozenset("script style iframe textarea noembed noframes".split())
#: Elements of other languages, in which '/>' ends an element; a drawing's elements that are not shown.
FOREIGN_TAGS, UNSEEN_TAGS = frozenset(("svg", "math")), frozenset(("title", "desc", "metadata"))
#: Elements that only hold others; in a block's path they count by their names alone.
HOLDING_TAGS = frozenset("object noscript svg math".split())
#: Elements that part words without ending a block.
PARTING_TAGS = frozenset("br svg text mtr mtd".split())
#: Elements that end an open element of the same kind, and what keeps them from reaching further out.
CLOSES = {
    "p": ("p",), "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
LIMITS = {"li": ("ul", "ol", "menu", "dir"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("table",),
          "th": ("table",), "option": ("select",)}

# Names that tell what is not main text.
SIDE_TAGS = frozenset("nav footer aside form button select menu dialog head title header".split())
SIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus feedback footer gdpr header login masthead menu nav navbar navigation newsletter notice "
    "pager pagination popup promo promoted related replies reply search share sharing sidebar signup social sponsor "
    "sponsored subscribe tags toolbar topbar widget".split()
)

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|>|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_NAME = re.compile(r"[a-zA-Z]+")


#: What has been found out about attributes and paths, at most so many of each.
_names, _cells, REMEMBERED = Cache(), Cache(), 4096


def names(attributes: str) -> tuple[str, ...]:
    """The words in an element's class, id and role."""
    if attributes in _names:
        return _names[attributes]
    if len(_names) >= REMEMBERED:
        _names.clear()
    found = [x for m in _NAMED.finditer(attributes) for x in m.groups() if x]
    _names[attributes] = tuple(sorted({w.lower() for x in found for w in _NAME.findall(x)}))
    return _names[attributes]


def read_blocks(page: str) -> list[tuple[tuple, str, int]]:
    """Leaf blocks of a page: path of (tag, names), text, characters inside links."""
    out: list[tuple[tuple, str, int]] = []
    stack: list[tuple[str, tuple]] = []
    parts: list[str] = []
    linked = at = 0
    inside, ends = {"a": 0, "svg": 0, "math": 0}, {}

    def close():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                path = (("div", own) if tag in HOLDING_TAGS else (tag, own) for tag, own in stack if own or tag not in HOLDING_TAGS)
                out.append((tuple(path), text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def take(raw: str):
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if inside["a"]:
            linked += len(text.strip())

    def push(tag: str, attributes: str):
        if tag in inside:
            inside[tag] += 1
        stack.append((tag, names(attributes) if "=" in attributes else ()))

    def pop_to(k: int):
        if any(tag in BLOCK_TAGS for tag, _ in stack[k:]):
            close()
        for tag, _ in stack[k:]:
            if tag in inside:
                inside[tag] -= 1
        del stack[k:]

    def end_of(tag: str, start: int) -> tuple[int, int] | None:
        """Where the end tag of an element stands; the tags of each kind are looked for once."""
        if tag not in ends:
            tags = list(re.compile(rf"<(/?){re.escape(tag)}(?![\w:-])[^>]*>", re.I).finditer(page))
            if tag == "template":  # may hold others
                ends[tag], begun = {}, []
                for m in tags:
                    if not m.group(1):
                        begun.append(m.start())
                    elif begun:
                        ends[tag][begun.pop()] = m.span()
            else:
                ends[tag] = [m.span() for m in tags if m.group(1)]
        if tag == "template":
            return ends[tag].get(start)
        k = bisect_left(ends[tag], (at, 0))
        return ends[tag][k] if k < len(ends[tag]) else None

    size = len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            take(page[at:])
            break
        if m.start() > at:
            take(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
            else:
                if tag in BLOCK_TAGS:
                    close()
            if tag in PARTING_TAGS:
                parts.append(" ")
            continue
        ended = m.group(3).endswith("/")
        foreign = tag in FOREIGN_TAGS or inside["svg"] or inside["math"]
        if tag in RAW_TAGS:
            if not (ended and foreign):
                end = end_of(tag, m.start())
                at = end[1] if end else at if ended else size
            parts.append(" ")
            continue
        if tag in PARTING_TAGS:
            parts.append(" ")
        if tag in VOID_TAGS:
            if tag in BLOCK_TAGS:
                close()
            continue
        if ended and foreign:
            continue
        if tag == "template" and "shadowroot" not in m.group(3).lower() or inside["svg"] and tag in UNSEEN_TAGS:
            end = end_of(tag, m.start())
            if end:
                at = end[1]
                parts.append(" ")
                continue
        if tag == "xmp" and (end := end_of(tag, m.start())):  # its content is text, whatever it looks like
            close()
            push(tag, m.group(3))
            parts.append(page[at : end[0]])
            pop_to(len(stack) - 1)
            at = end[1]
            continue
        if tag in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES[tag]:
                    pop_to(k)
                    break
                if stack[k][0] in LIMITS.get(tag, ()) or tag == "p" and stack[k][0] in BLOCK_TAGS:
                    break
        elif tag in BLOCK_TAGS:  # a block ends an open paragraph
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] in BLOCK_TAGS:
                    break
        if tag in BLOCK_TAGS:
            close()
        push(tag, m.group(3))
    close()
    return out


def is_main(path: tuple) -> bool:
    """What the names of a block's ancestors say; the teacher's label."""
    inside = False
    for tag, own in path:
        if not SIDE_NAMES.isdisjoint(own):
            return False
        if tag in SIDE_TAGS and not (tag == "header" and inside):
            return False
        inside = inside or tag in ("article", "main")
    return True


def path_cells(path: tuple) -> tuple[int, ...]:
    """Hashed features of a tag path."""
    if path in _cells:
        return _cells[path]
    if len(_cells) >= REMEMBERED:
        _cells.clear()
    said = {f"in {tag}" for tag, _ in path} | {f"name {w}" for _, own in path for w in own}
    said |= {f"leaf {tag}" for tag, _ in path[-1:]} | {f"under {a}>{b}" for (a, _), (b, _) in zip(path, path[1:], strict=False)}
    _cells[path] = tuple(sorted({crc32(x.encode()) % PATH_CELLS for x in said}))
    return _cells[path]


def block_vectors(found: list[tuple[tuple, str, int]], words: int | None = None) -> np.ndarray:
    """One row per block of a page: tag path, words, measures."""
    x = np.zeros((len(found), PATH_CELLS + WORD_CELLS + MEASURES), np.float32)
    for k, (path, text, linked) in enumerate(found):
        x[k, list(path_cells(path))] = 1
        own = text.lower().split(maxsplit=-1 if words is None else words)[:words]
        cells = np.bincount([crc32(w.encode()) % WORD_CELLS for w in own], minlength=WORD_CELLS)
        x[k, PATH_CELLS : PATH_CELLS + WORD_CELLS] = 0.3 * cells / np.sqrt(max(len(own), 1))
        x[k, PATH_CELLS + WORD_CELLS :] = (
            np.log1p(len(text)) / 5, linked / len(text), text[-1] in ".!?", k / len(found), 1 / (1 + k),
        )
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        size, h = PATH_CELLS + WORD_CELLS + MEASURES, HIDDEN
        normal = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.w = {}
        for side in "fb":
            bias = np.zeros(4 * h, np.float32)
            bias[h : 2 * h] = 1  # remember at first
            self.w |= {f"x{side}": normal(size, 4 * h), f"h{side}": normal(h, 4 * h), f"c{side}": bias}
        self.w |= {"o": normal(2 * h, 1)[:, 0], "b": np.zeros(1, np.float32)}

    def scan(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool = False):
        """States after each block; ``x`` is pages by blocks by features, in reading direction."""
        pages, steps = mask.shape
        h = HIDDEN
        drive = (x.reshape(-1, x.shape[2]) @ self.w[f"x{side}"] + self.w[f"c{side}"]).reshape(pages, steps, 4 * h)
        state, cell = np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32)
        states, trace = np.zeros((pages, steps, h), np.float32), []
        for t in range(steps):
            z = drive[:, t] + state @ self.w[f"h{side}"]
            gates, fresh = sigmoid(z[:, : 3 * h]), np.tanh(z[:, 3 * h :])
            let, hold, show = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            now = hold * cell + let * fresh
            out = show * np.tanh(now)
            on = mask[:, t, None]
            if keep:
                trace.append((state, cell, let, hold, show, fresh, now))
            state, cell = np.where(on, out, state), np.where(on, now, cell)
            states[:, t] = state
        return states, trace

    def flip(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Blocks of each page in reverse, its padding left at the end."""
        steps = np.arange(x.shape[1])
        at = np.where(steps < lengths[:, None], lengths[:, None] - 1 - steps, steps)
        return np.take_along_axis(x, at.reshape(at.shape + (1,) * (x.ndim - 2)), axis=1)

    def probabilities(self, vectors: list[np.ndarray]) -> list[np.ndarray]:
        """For every page, the probability of each block to be main text."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(vectors)
        order = sorted((k for k in range(len(vectors)) if len(vectors[k])), key=lambda k: len(vectors[k]))
        while order:
            longest = len(vectors[order[-1]])
            some = order[-max(1, CELLS // longest) :]
            del order[-len(some) :]
            x, mask, lengths = padded([vectors[k] for k in some])
            ahead, _ = self.scan(x, mask, "f")
            back, _ = self.scan(self.flip(x, lengths), mask, "b")
            p = sigmoid(np.concatenate((ahead, self.flip(back, lengths)), 2) @ self.w["o"] + self.w["b"])
            for k, row, n in zip(some, p, lengths, strict=True):
                out[k] = row[:n]
        return out

    def slopes(self, x, mask, lengths, y) -> tuple[float, dict]:
        """Mean loss and its slopes, by backpropagation through time."""
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        turned = self.flip(x, lengths)
        ahead, trace_f = self.scan(x, mask, "f", True)
        back, trace_b = self.scan(turned, mask, "b", True)
        both = np.concatenate((ahead, self.flip(back, lengths)), 2)
        p = sigmoid(both @ self.w["o"] + self.w["b"])
        n = mask.sum()
        loss = -(np.log(np.where(y, p, 1 - p) + 1e-9) * mask).sum() / n
        error = (p - y) * mask / n
        grads["o"] = np.einsum("pt,pth->h", error, both).astype(np.float32)
        grads["b"] = np.array([error.sum()], np.float32)
        down = error[:, :, None] * self.w["o"]
        h = HIDDEN
        for side, own, trace, top in (("f", x, trace_f, down[:, :, :h]), ("b", turned, trace_b, self.flip(down[:, :, h:], lengths))):
            d_state, d_cell = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
            d_drive = np.zeros((*mask.shape, 4 * h), np.float32)
            for t in range(mask.shape[1] - 1, -1, -1):
                state, cell, let, hold, show, fresh, now = trace[t]
                on = mask[:, t, None]
                total = d_state + top[:, t]
                bent = np.tanh(now)
                d_now = d_cell + total * show * (1 - bent**2)
                z = np.concatenate((d_now * fresh * let * (1 - let), d_now * cell * hold * (1 - hold),
                                    total * bent * show * (1 - show), d_now * let * (1 - fresh**2)), 1) * on
                d_drive[:, t] = z
                grads[f"h{side}"] += state.T @ z
                d_state = np.where(on, z @ self.w[f"h{side}"].T, total)
                d_cell = np.where(on, d_now * hold, d_cell)
            flat = d_drive.reshape(-1, 4 * h)
            grads[f"x{side}"] = own.reshape(-1, own.shape[2]).T @ flat
            grads[f"c{side}"] = flat.sum(0)
        return float(loss), grads

    def fit(self, vectors: list[np.ndarray], labels: list[np.ndarray], rounds: int = ROUNDS) -> float:
        """Adam over all pages at once; gives the last loss."""
        x, mask, lengths = padded(vectors)
        y, _, _ = padded([v[:, None].astype(np.float32) for v in labels])
        first, second, loss = {}, {}, 0.0
        for step in range(1, rounds + 1):
            loss, grads = self.slopes(x, mask, lengths, y[:, :, 0] > 0.5)
            for k, g in grads.items():
                first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                second[k] = 0.99 * second.get(k, 0) + 0.01 * g * g
                rate = RATE * min(1, 2 * (1 - step / (rounds + 1)))
                self.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return loss


def padded(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(v) for v in vectors])
    x = np.zeros((len(vectors), lengths.max(initial=0), vectors[0].shape[1]), np.float32)
    for k, v in enumerate(vectors):
        x[k, : len(v)] = v
    return x, np.arange(x.shape[1]) < lengths[:, None], lengths


def lesson(found: list[tuple[tuple, str, int]], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A page's blocks with some more of other kinds set in, and their labels."""
    told = list(found)
    words = [w for _, text, _ in found for w in text.split()] or ["text"]
    sides = sorted(SIDE_NAMES)
    plain = sorted({"content", "post", "entry", "story", "text", "page", "body", "wrap", "main"})
    if rng.random() < 0.5:  # the same page in other clothes
        coat = ("div", (plain[rng.integers(len(plain))],))
        told = [((*(coat if p[0] == "article" else p for p in path),), t, n) for path, t, n in told]
    for _ in range(rng.integers(0, 6)):
        at = int(rng.integers(0, len(told) + 1))
        around = told[min(at, len(told) - 1)][0] if told else ()
        base = tuple(p for p in around[: rng.integers(0, 4)] if p[0] in ("html", "body", "article", "main", "div"))
        kind = rng.integers(3)
        if kind == 0:
            own = (sorted(SIDE_TAGS)[rng.integers(len(SIDE_TAGS))], ())
        elif kind == 1:
            own = (("div", "section", "p", "ul")[rng.integers(4)], (sides[rng.integers(len(sides))],))
        else:
            own = (("div", "section", "p", "blockquote")[rng.integers(4)], (plain[rng.integers(len(plain))],))
        path = (*base, own, *((("p", ()),) if rng.random() < 0.6 else ()))
        size = int(rng.integers(1, 30))
        text = " ".join(words[int(rng.integers(len(words)))] for _ in range(size))
        told.insert(at, (path, text, 0))
    told = told[:MAX_BLOCKS]
    return block_vectors(told, MAX_WORDS), np.array([is_main(path) for path, _, _ in told], bool)


def train(pages: DataFrame, max_pages: int = MAX_PAGES, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """Learn from the pages with the smallest hashed ids."""
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(html_col).cast("string").alias("page"))
    rows = rows.where(F.length("page") > 0).select("id", F.xxhash64("id", "page").alias("turn"), "page")
    wanted = F.broadcast(rows.select("turn").distinct().orderBy("turn").limit(max_pages))  # max_pages bounds it

    def run(batches):
        for batch in batches:
            paths, texts, links, turns = [], [], [], []
            for turn, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = read_blocks(page.as_py())[:MAX_BLOCKS]
                turns.append(turn)
                paths.append([";".join(f"{t} {' '.join(n)}" for t, n in path) for path, _, _ in found])
                texts.append([" ".join(t.split(" ", MAX_WORDS)[:MAX_WORDS]) for _, t, _ in found])
                links.append([n for _, _, n in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(turns, pa.int64()), pa.array(paths, pa.list_(pa.string())),
                 pa.array(texts, pa.list_(pa.string())), pa.array(links, pa.list_(pa.int64()))],
                names=["turn", "paths", "texts", "links"],
            )

    found = rows.join(wanted, "turn").select("turn", "page").dropDuplicates(["turn"])
    found = found.mapInArrow(run, "turn long, paths array<string>, texts array<string>, links array<long>")
    rng, labeller = np.random.default_rng(3), Labeller()
    vectors, labels = [], []
    for row in sorted(found.collect(), key=lambda r: r.turn):
        own = []
        for path, text, linked in zip(row.paths, row.texts, row.links, strict=True):
            pairs = [p.split(" ") for p in path.split(";") if p]
            own.append((tuple((p[0], tuple(n for n in p[1:] if n)) for p in pairs), text, min(linked, len(text))))
        if own:
            for _ in range(2):
                x, y = lesson(own, rng)
                vectors.append(x)
                labels.append(y)
    if vectors:
        labeller.fit(vectors, labels)
    return labeller


def main_texts(
    pages: DataFrame, labeller: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, url, text, n_chars, n_blocks, n_main."""

    def run(batches):
        for batch in batches:
            step = 256
            for first in range(0, len(batch), step):
                own = batch.slice(first, step)
                found = [read_blocks(page.as_py() or "") for page in own.column(2)]
                chances = labeller.probabilities([block_vectors(f) for f in found])
                kept = [[t for (_, t, _), p in zip(f, c, strict=True) if p >= 0.5] for f, c in zip(found, chances, strict=True)]
                texts = ["\n\n".join(k) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([len(f) for f in found], pa.int64()), pa.array([len(k) for k in kept], pa.int64())],
                    names=["id", "url", "text", "n_chars", "n_blocks", "n_main"],
                )

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("page"))
    out = rows.mapInArrow(
        run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long, n_blocks long, n_main long"
    )
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
