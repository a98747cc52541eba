"""Toxic passages by maximum-scoring segments.

A word's tokens are itself and its stems, the first few bytes of it at several
lengths, so that inflected words that were never seen whole are known by their
stem. Every token has a score: the log-odds of toxic against clean texts that hold it,
with its frequency in all documents as Dirichlet prior, less some standard errors and a
small drift, so that chance scores below zero. A word scores as its best stem
if that is above zero, else as itself. A linear-time scan finds all maximal
scoring segments of a document. Extreme-value statistics say how often
chance makes a segment of that score in a text of that length (its E-value);
segments below a limit are significant. The surprise of the best segment and of
the best ones together give the document's score through a logistic curve.

Labels come from a bounded sample of labelled rows (``max_rows``); the prior
counts the tokens of all documents. Tokens are hashed into ``BUCKETS`` cells, so
the tables have one size whatever the vocabulary.

Defined results: a null or empty text has no segment and the score of a text of
one chance word. A null id is kept and never learnt from; a repeated label
counts once, 0 before 1; repeated documents get equal scores. Without labels of
both kinds all words score below zero and all documents get the share of ones.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import MAX_ROWS, sample
from .tables import saved
from .words import ALNUM, LOWER, Block, Words, blocks, map_blocks, map_rows, span_hash

BUCKETS = 1 << 18
#: Bytes of a word's stems.
STEMS = (4, 5, 6, 7, 8)
#: What the prior counts for, as a share of the smaller class's tokens; standard errors and drift taken off;
#: range of a word's score.
PRIOR, ERRORS, DRIFT, LOW, HIGH = 0.3, 2.0, 1.0, -1.0, 12.0
#: E-value below which a segment is significant.
SIGNIFICANT = 0.05


def cells(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word of a block (itself, then its stems; -1: too short for that
    stem), and where each document's words begin."""
    words = Words(block, LOWER[block.data], ALNUM)
    out = np.full((len(words), 1 + len(STEMS)), -1)
    out[:, 0] = (words.hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    for k, size in enumerate(STEMS, 1):
        own = words.ends - words.starts >= size
        stem = span_hash(words.sums, words.starts[own], words.starts[own] + size)
        out[own, k] = ((stem >> np.uint64(32)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return out, words.of


def log_odds(toxic: np.ndarray, clean: np.ndarray, background: np.ndarray) -> np.ndarray:
    """A score per bucket from the documents of both classes, and of the whole corpus, that hold it."""
    prior = PRIOR * min(toxic.sum(), clean.sum()) * (background + 1) / (background + 1).sum()
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    return np.clip(odds - ERRORS * np.sqrt(1 / a + 1 / b) - DRIFT, LOW, HIGH).astype(np.float32)


def word_scores(scores: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """The score of each word: its best token if above zero, else its own."""
    found = np.where(cell >= 0, scores[cell], np.float32(LOW))
    best = found.max(axis=1, initial=LOW)
    return np.where(best > 0, best, found[:, 0])


def decay(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(weights * exp(decay * scores)) = 1."""
    weights = weights / weights.sum()
    if scores.max() <= 0 or scores @ weights >= 0:
        return 1.0
    low, high = 0.0, 1.0
    value = lambda x: weights @ np.exp(x * scores) - 1
    while value(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: start, end, score.

    Only runs of positive scores can begin or end one, so the scan goes over those.
    """
    up = scores > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([False], up, [False])).astype(np.int8)))
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[list] = []  # start, end, total before, total after
    for start, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        now = [start, end, sums[start], sums[end]]
        while True:
            # the nearest segment to the left that begins lower
            at = len(found) - 1
            while at >= 0 and found[at][2] >= now[2]:
                at = found[at][4]
            if at < 0 or found[at][3] >= now[3]:
                found.append([*now, at])
                break
            now = [found[at][0], now[1], found[at][2], now[3]]
            del found[at:]
    return [(s, e, float(high - low)) for s, e, low, high, _ in found]


def poisson_surprise(means: np.ndarray) -> np.ndarray:
    """-log of the probability of at least r events at the r-th of ascending means."""
    rank = np.arange(1, len(means) + 1)
    rare = means < rank
    r, e = rank[rare], np.maximum(means[rare], 1e-30)
    tail, term, k = np.ones(len(e)), np.ones(len(e)), 0
    while (term > 1e-9 * tail).any():  # shrinks by less than e / r at each step
        k += 1
        term *= e / (r + k)
        tail += term
    out = np.zeros(len(means))
    out[rare] = e - r * np.log(e) + np.cumsum(np.log(rank))[rare] - np.log(tail)
    return out


@dataclass
class Model:
    """Word scores by bucket, the extreme-value parameters, and the logistic curve."""

    scores: np.ndarray
    decay: float = 1.0
    scale: float = 1.0
    curve: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def e_value(self, score, n):
        return self.scale * np.maximum(n, 1) * np.exp(-self.decay * np.asarray(score, float))

    def passages(self, block: Block) -> list[list[tuple[int, int, float, float]]]:
        """Per document, its maximal segments: first word, end, score, E-value."""
        cell, of = cells(block)
        values = word_scores(self.scores, cell)
        hit = np.concatenate(([0], np.cumsum(values > 0)))
        out: list[list] = [[] for _ in range(len(block))]
        for d in np.flatnonzero(hit[of[1:]] > hit[of[:-1]]):
            n = int(of[d + 1] - of[d])
            for start, end, score in segments(values[of[d] : of[d + 1]]):
                out[d].append((start, end, score, float(self.e_value(score, n))))
        return out

    def evidence(self, scores: list[list[float]], sizes: np.ndarray) -> np.ndarray:
        """Columns: 1, the surprise of the best segment, that of the best ones together, of any number.

        In a chance text the segments of at most an E-value e are Poisson distributed with
        mean e, so r of them have the probability of r or more Poisson events.
        """
        out = np.ones((len(scores), 3))
        for d, own in enumerate(scores):
            e = self.e_value(np.sort(own)[::-1] if len(own) else [0.0], sizes[d])
            surprise = poisson_surprise(e)
            out[d, 1:] = -np.log(max(e[0], 1e-30)), surprise.max()
        out[:, 1:] = np.clip(out[:, 1:], -15, 60) / 10
        return out

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.curve, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic curve, by Newton's method with a small penalty."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def document_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, bucket, n): documents that hold a token of the bucket; the id column is a class or a constant."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        def work(block: Block, ids):
            cell, of = cells(block)
            labels, label = np.unique(np.array(ids.to_pylist()), return_inverse=True)
            # a token counts once in a document, however often that repeats it
            held = np.unique((np.repeat(np.arange(len(block)), np.diff(of))[:, None] * BUCKETS + cell)[cell >= 0])
            key, n = np.unique(label[held // BUCKETS] * BUCKETS + held % BUCKETS, return_counts=True)
            yield {"id": pa.array(labels[key // BUCKETS], ids.type), "bucket": key % BUCKETS, "n": n}

        return work

    return map_rows(docs, f"id {kind}, bucket long, n long", make, id_col, text_col)


def table_of(counts: DataFrame) -> np.ndarray:
    """Sums per bucket; at most one row for each of the buckets gets to the driver."""
    out = np.zeros(BUCKETS)
    rows = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out[rows["bucket"].to_numpy(int)] = rows["n"].to_numpy(float)
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 5,
    held_out: int = 0,
    max_rows: int = MAX_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Learn from the labelled sample, with the words of all documents as prior."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.lit(0).alias("all"))
    background = table_of(document_counts(texts, "all", "text"))
    wanted = F.broadcast(sample(labels, label, folds, held_out, max_rows, id_col))  # max_rows bounds it
    half = F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("half")
    # of an id's texts one teaches, whatever their order; copies of a text teach as one
    known = texts.join(wanted, "id").groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("x"))
    known = known.select("id", "y", "x.text").groupBy("text").agg(F.min(F.struct("id", "y")).alias("x")).select("x.*", "text")
    known = saved(known.select("id", "text", "y", half), "labelled-texts")
    group = (F.col("y") * 2 + F.col("half")).cast("int").alias("group")
    by_group = saved(document_counts(known.select(group, "text"), "group", "text"), "class-tokens")
    # rows: clean, toxic; columns: halves of the sample
    counts = np.stack([table_of(by_group.where(F.col("id") == g)) for g in range(4)]).reshape(2, 2, BUCKETS)
    whole = counts.sum(axis=1)
    if not whole.any(axis=1).all():
        share = known.agg(F.avg("y")).first()[0]
        share = 0.5 if share is None else min(max(share, 0.01), 0.99)
        return Model(np.full(BUCKETS, LOW, np.float32), curve=np.array([np.log(share / (1 - share)), 0, 0]))
    model = Model(log_odds(whole[1], whole[0], background))
    # each half is measured by what the other taught, so its own words don't flatter it
    halves = [Model(log_odds(counts[1, 1 - k], counts[0, 1 - k], background)) for k in (0, 1)]

    def measure(batches):
        for batch in batches:
            for block in blocks(batch.column(0)):
                own = batch.slice(block.first, len(block))
                side = np.array(own.column(2).to_pylist(), int)
                several, levels, times = [], [], []
                cell, of = cells(block)
                values = [word_scores(h.scores, cell) for h in halves]
                for d in range(len(block)):
                    mine = values[side[d]][of[d] : of[d + 1]]
                    several.append(sorted((x[2] for x in segments(mine)), reverse=True))
                    level, many = np.unique(np.round(mine, 1).astype(float), return_counts=True)
                    levels.append(level.tolist())
                    times.append(many.tolist())
                yield pa.RecordBatch.from_arrays(
                    [own.column(1), pa.array(np.diff(of)), pa.array(several, pa.list_(pa.float64())),
                     pa.array(levels, pa.list_(pa.float64())), pa.array(times, pa.list_(pa.int64()))],
                    names=["y", "n", "several", "level", "times"],
                )

    schema = "y double, n long, several array<double>, level array<double>, times array<long>"
    measured = saved(known.select("text", "y", "half").mapInArrow(measure, schema), "measured-texts")
    # how word scores are distributed in clean texts: a row for each tenth
    own = measured.where("y = 0")
    levels = own.select(F.explode(F.arrays_zip("level", "times")).alias("x")).select("x.*")
    levels = levels.groupBy("level").agg(F.sum("times").alias("times")).orderBy("level").toPandas()
    # the highest score counts as met once more, so that texts without any give a decay too
    values, times = levels["level"].to_numpy(float), levels["times"].to_numpy(float)
    model.decay = decay(np.append(values, max(float(model.scores.max()), 0.1)), np.append(times, 1.0))
    # of exponentially distributed n * exp(-decay * best) in clean texts
    best = F.coalesce(F.try_element_at("several", F.lit(1)), F.lit(0.0))
    chance = own.agg(F.avg(F.greatest("n", F.lit(1)) * F.exp(-model.decay * best))).first()[0]
    model.scale = 1 / chance

    def judge(batches):
        for batch in batches:
            found = model.evidence([x.as_py() for x in batch.column(2)], batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c.copy()) for c in found.T)], names=["y", "a", "b", "c"])

    rows = measured.select("y", "n", "several").mapInArrow(judge, "y double, a double, b double, c double")
    rows = rows.toPandas().sort_values(["y", "a", "b", "c"])  # at most max_rows, in one order for equal sums
    model.curve = logistic(rows[["a", "b", "c"]].to_numpy(float), rows["y"].to_numpy(float))
    return model


def toxicity_scores(
    docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, predicted, passages): passages are the significant segments, by words."""

    def make():
        def work(block: Block) -> dict:
            found = model.passages(block)
            evidence = model.evidence([[x[2] for x in f] for f in found], np.diff(cells(block)[1]))
            score = model.probability(evidence)
            kept = [[{"first": s, "end": e, "score": v, "e_value": p} for s, e, v, p in f if p <= SIGNIFICANT] for f in found]
            kind = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])
            return {
                "score": pa.array(score),
                "predicted": pa.array((score >= threshold).astype(np.int32)),
                "passages": pa.array(kept, pa.list_(kind)),
            }

        return work

    return map_blocks(
        docs,
        "score double, predicted int, passages array<struct<first:bigint,end:bigint,score:double,e_value:double>>",
        make, id_col, text_col,
    )
