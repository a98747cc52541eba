"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text's form falls into one of a few bins. Boosting visits
the features in turn, again and again; each visit fits a tree of at most four
leaves on that feature's bins to the current residuals and adds a small part of
it to the feature's lookup table. Then the pairs of features that explain most
of what is left get tables of their own. A score is the sum of the looked-up
values, so scoring is a vectorised addition of bins.

Labels come from a bounded sample of labelled rows (``max_rows``, the rows with
the smallest hashed ids); everything else covers all documents.

Defined results: a null or empty text has all features zero and is scored like
any other. A null id is kept and never learnt from; repeated documents get
equal scores, and a repeated label counts once, 0 before 1. Without labels of
both kinds all scores equal the share of ones.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import NAMES, features
from .words import Block, blocks, keep_rows, map_blocks

#: Labelled rows to learn from at most.
MAX_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAST_ROWS, RIDGE = 120, 40, 0.15, 8, 2.0


def gain(g, h):
    return g * g / (h + RIDGE)


def split(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[float, int]:
    """Best gain and place to cut a range of bins into two (0: none)."""
    gs, hs, cs = np.cumsum(g), np.cumsum(h), np.cumsum(c)
    left, right = cs[:-1], cs[-1] - cs[:-1]
    value = gain(gs[:-1], hs[:-1]) + gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1]) - gain(gs[-1], hs[-1])
    value = np.where((left >= LEAST_ROWS) & (right >= LEAST_ROWS), value, 0)
    if not len(value) or value.max() <= 1e-9:
        return 0.0, 0
    return float(value.max()), int(value.argmax()) + 1


def stump(g, h, c, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree of that depth."""
    _, cut = split(g, h, c) if depth else (0, 0)
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate((stump(g[:cut], h[:cut], c[:cut], depth - 1), stump(g[cut:], h[cut:], c[cut:], depth - 1)))


def crossed(g, h, c) -> tuple[float, np.ndarray]:
    """Gain and values of a tree over two features: a cut of one, then one of the other on each side."""
    best = 0.0, np.zeros(g.shape)
    for turned in (False, True):
        a, b, d = (x.T if turned else x for x in (g, h, c))
        total, cut = split(a.sum(1), b.sum(1), d.sum(1))
        if not cut:
            continue
        values = np.zeros(a.shape)
        for side in (slice(0, cut), slice(cut, None)):
            more, _ = split(a[side].sum(0), b[side].sum(0), d[side].sum(0))
            values[side] = stump(a[side].sum(0), b[side].sum(0), d[side].sum(0), 1)
            total += more
        if total > best[0]:
            best = total, values.T if turned else values
    return best


@dataclass
class Additive:
    """Lookup tables per feature and per pair of features."""

    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    @staticmethod
    def bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        own = self.bins(x, self.edges)
        for i, table in enumerate(self.tables):
            out += table[own[:, i]]
        own = self.bins(x, self.pair_edges)
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[own[:, a], own[:, b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30))) if len(x) else np.zeros(0)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Additive:
        cut = lambda n: [np.unique(np.quantile(x[:, i], np.arange(1, n) / n)) for i in range(x.shape[1])]
        share = (y.sum() + 1) / (len(y) + 2)
        model = cls([np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1], [np.zeros(0)] * x.shape[1], base=float(np.log(share / (1 - share))))
        if len(np.unique(y)) < 2:
            return model
        model.edges, model.pair_edges = cut(BINS), cut(PAIR_BINS)
        own = cls.bins(x, model.edges)
        raw = np.full(len(y), model.base)
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]

        def slopes():
            p = 1 / (1 + np.exp(-raw))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for i, table in enumerate(model.tables):
                if len(table) < 2:
                    continue
                g, h = slopes()
                at, n = own[:, i], len(table)
                step = RATE * stump(np.bincount(at, g, n), np.bincount(at, h, n), np.bincount(at, minlength=n))
                table += step
                raw += step[at]
        own = cls.bins(x, model.pair_edges)
        sizes = [len(e) + 1 for e in model.pair_edges]

        def cells(a, b, weights=None):
            return np.bincount(own[:, a] * sizes[b] + own[:, b], weights, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

        g, h = slopes()
        found = sorted(((-crossed(cells(a, b, g), cells(a, b, h), cells(a, b))[0], a, b) for a, b in combinations(range(x.shape[1]), 2)))
        model.pairs = [(a, b) for value, a, b in found[:PAIRS] if value < 0]
        model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
        for _ in range(PAIR_ROUNDS):
            for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
                g, h = slopes()
                step = RATE * crossed(cells(a, b, g), cells(a, b, h), cells(a, b))[1]
                table += step
                raw += step[own[:, a], own[:, b]]
        return model


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def sample(labels: DataFrame, label: str, folds: int, held_out: int, max_rows: int, id_col: str) -> DataFrame:
    """(id, y) of at most ``max_rows`` labelled ids outside the held-out fold."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (fold(id_col, folds) != held_out))
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(label).cast("double")).alias("y"))
    return rows.orderBy(F.xxhash64("id"), "id").limit(max_rows)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 4,
    held_out: int = 2,
    max_rows: int = MAX_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Additive:
    """Fit the model on the labelled sample; its features are computed by the executors."""
    wanted = F.broadcast(sample(labels, label, folds, held_out, max_rows, id_col))  # max_rows bounds it
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(wanted, "id")

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                own = batch.slice(block.first, len(block))
                x = features(block)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(2), *(pa.array(c.copy()) for c in x.T)], names=["id", "y", *NAMES]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.select("id", "text", "y").mapInArrow(run, f"id {kind}, y double, " + ", ".join(f"{c} double" for c in NAMES))
    # of an id's texts one teaches, whatever their order: at most max_rows rows get to the driver
    found = found.groupBy("id").agg(F.min(F.struct("y", *NAMES)).alias("x")).select("id", "x.*")
    found = found.toPandas().sort_values("id")
    return Additive.fit(found[list(NAMES)].to_numpy(float), found["y"].to_numpy(float))


def quality_scores(
    docs: DataFrame, model: Additive, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, predicted) of every document."""

    def make():
        def work(block: Block) -> dict:
            score = model.score(features(block))
            return {"score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))}

        return work

    return map_blocks(docs, "score double, predicted int", make, id_col, text_col)


def keep_good(docs: DataFrame, model: Additive, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that the model does not reject."""
    return keep_rows(docs, lambda: lambda block: model.score(features(block)) >= threshold, text_col)
