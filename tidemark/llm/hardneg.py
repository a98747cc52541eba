"""Hard negatives by a vertical scan of columnar vectors.

Vectors lie in blocks, one array per dimension, with the smallest and largest value of
each. An anchor reads a block's dimensions in the order of its own components'
magnitude. What the unread dimensions can still add lies between the sums of their
smallest and largest contributions, so every candidate has a lower and an upper
bound. A bitmap of candidates shrinks after each few dimensions: first those go
that cannot be among the nearest of the anchor's label, and in a second scan those
whose bounds meet no window of scores, or only windows whose places are taken by surely
better ones. What remains when all dimensions are read has exact scores.

Anchors are dealt into blocks too, and each pair of blocks is one row of a join:
the work is the stated query set against all rows, in pieces of bounded size, and
what a piece returns is at most a list per anchor and window. Nothing but the numbers of blocks
reaches the driver.

Scores are integer products of components ``floor(scale * x)``, held within
``LARGEST`` so that they fit. Defined results: rows with a null id, label or
vector, or any null or non-finite component, take no part. Missing
components of shorter vectors count as zero. Ties go to the smaller id. Rows equal
in id, label and score count once; an anchor's own id is never its positive. An anchor
without positives or windows without a row give no rows, as do empty tables. Vectors may be long;
a block holds fewer of them then. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import salted_join, saved
from .words import give_back

#: Components lie within this after scaling.
LARGEST = 1 << 28
#: Bytes of a block of vectors, most rows of it, and anchors of a block.
BLOCK_BYTES, BLOCK_ROWS, BLOCK_ANCHORS = 1 << 23, 1 << 15, 256
#: Dimensions read between two looks at the bitmap.
STEP = 8


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id``, ``label`` as a number, ``vector`` of scaled whole components; rows that take part."""
    kind = rows.schema[label_col].dataType.simpleString()
    label = F.col(label_col).cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(label_col)
    parts = F.col(vector_col).cast("array<double>")
    odd = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(parts, lambda x: F.greatest(F.least(F.floor(x * F.lit(float(scale))), F.lit(LARGEST)), F.lit(-LARGEST)))
    there = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & parts.isNotNull() & ~odd
    return rows.where(there).select(F.col(id_col).cast("bigint").alias("id"), label.alias("label"), whole.alias("vector"))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows of one array, shorter ones filled with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if len(values) == len(sizes) * width:
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def column_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of vectors: ids, labels, and one array of components per dimension."""

    def pack(ids, labels, vectors, block):
        m = np.ascontiguousarray(matrix(vectors).T, np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()), pa.array([m.shape[0]], pa.int32()),
                *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (ids.to_numpy(), labels.to_numpy(), m)),
            ],
            names=["block", "width", "ids", "labels", "columns"],
        )

    def run(batches):
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            return pack(*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns), block)

        for batch in batches:
            width = max(1, int(np.diff(batch.column(2).offsets.to_numpy()).max(initial=1)))
            room = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (4 * width)))
            for at in range(0, batch.num_rows, room):
                part = batch.slice(at, room)
                if held and size + part.num_rows > room:
                    yield flush()
                    block, held, size = block + 1, [], 0
                held.append(pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([c]) if i < 2 else c.take(pa.array(range(len(c)))) for i, c in enumerate(part.columns)],
                    names=["id", "label", "vector"],
                ))
                size += part.num_rows
        if held:
            yield flush()
            give_back()

    return rows.select("id", "label", "vector").mapInArrow(run, "block long, width int, ids binary, labels binary, columns binary")


class Columns:
    """A block's vectors by dimension."""

    def __init__(self, width: int, ids: bytes, labels: bytes, columns: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        whole = np.frombuffer(columns, np.int32).reshape(width, len(self.ids))
        self.low, self.high = whole.min(axis=1).astype(np.int64), whole.max(axis=1).astype(np.int64)
        self.largest = int(np.abs(whole.astype(np.int64)).max(initial=0))
        self.columns = whole

    def scan(self, query: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Rows that ``keep`` leaves of the given ones, and their exact scores.

        ``keep`` gets lower and upper bounds of the scores and says which rows stay.
        """
        width = min(len(query), len(self.columns))
        order = np.argsort(-np.abs(query[:width]), kind="stable")
        q = query[order]
        ends = np.stack([q * self.low[order], q * self.high[order]])
        # what the dimensions from the n-th on can add
        least, most = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (ends.min(axis=0), ends.max(axis=0)))
        # floating point products are exact, and fast, while no sum can pass 2**53
        exact = width * self.largest * int(np.abs(q).max(initial=0)) < 1 << 53
        kind = np.float64 if exact else np.int64
        q, score = q.astype(kind), np.zeros(len(alive), np.int64)
        for at in range(0, width, STEP):
            dims = order[at : at + STEP]
            part = self.columns[dims][:, alive] if len(alive) < len(self.ids) else self.columns[dims]
            score += (q[at : at + STEP] @ part.astype(kind)).astype(np.int64)
            stays = keep(score + least[at + len(dims)], score + most[at + len(dims)])
            if not stays.all():
                alive, score = alive[stays], score[stays]
                if not len(alive):
                    break
        return alive, score


def best(ids: np.ndarray, score: np.ndarray, count: int) -> np.ndarray:
    """Places of the highest scores, ties by id; rows alike in both once."""
    order = np.lexsort((ids, -score))
    i, s = ids[order], score[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (i[1:] != i[:-1]) | (s[1:] != s[:-1])
    return order[fresh][:count]


def rank_from(values: np.ndarray, count: int) -> int:
    """The value at that rank from the top."""
    return int(np.partition(values, len(values) - count)[len(values) - count])


def nearest_in(block: Columns, query: np.ndarray, own: int, label: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of a block's best rows of one label, but for the own id."""

    def keep(low, high):
        # copies count once in the result, so bounds are taken over one row of each id
        if len(low) <= count:
            return np.ones(len(low), bool)
        return high >= rank_from(low, min(len(low), slack))

    candidates = np.flatnonzero((block.labels == label) & (block.ids != own))
    repeats = len(candidates) - len(np.unique(block.ids[candidates]))
    slack = count + repeats
    alive, score = block.scan(query, candidates, keep)
    top = best(block.ids[alive], score, count)
    return block.ids[alive][top], score[top]


def negatives_in(block: Columns, query: np.ndarray, label: int, windows: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every window of scores, lowest and highest, ids and scores of a block's best rows of other labels."""
    candidates = np.flatnonzero(block.labels != label)
    slack = count + len(candidates) - len(np.unique(block.ids[candidates]))

    def keep(low, high):
        out = np.zeros(len(low), bool)
        for floor, roof in windows:
            if floor > roof:
                continue
            sure = low[(low >= floor) & (high <= roof)]
            least = max(floor, rank_from(sure, slack)) if len(sure) >= slack else floor
            out |= (low <= roof) & (high >= least)
        return out

    alive, score = block.scan(query, candidates, keep)
    found = []
    for floor, roof in windows:
        inside = np.flatnonzero((score >= floor) & (score <= roof))
        top = inside[best(block.ids[alive][inside], score[inside], count)]
        found.append((block.ids[alive][top], score[top]))
    return found


def _answers(pairs: DataFrame, schema: str, answer) -> DataFrame:
    """Rows that ``answer(block, anchor number, id, label, vector, windows)`` yields for each anchor of a pair of blocks."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                width, ids, labels, columns, anchors = (c[row] for c in batch.columns)
                block = Columns(width.as_py(), ids.as_py(), labels.as_py(), columns.as_py())
                out = [answer(block, *anchor.values()) for anchor in anchors.as_py()]
                arrays = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
            give_back()

    return pairs.select("width", "ids", "labels", "columns", "anchors").mapInArrow(run, schema)


def _paired(blocks: DataFrame, anchors: DataFrame, groups: int) -> DataFrame:
    """Every block of vectors with every block of anchors."""
    listed = anchors.groupBy("part").agg(F.collect_list(F.struct(*anchors.drop("part").columns)).alias("anchors"))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint")))
    return salted_join(blocks.withColumn("part", parts), listed, "part", "block")


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    shares: tuple[int, int] = (80, 100),
) -> DataFrame:
    """Per anchor and positive, the best rows of other labels whose score is within ``shares`` percent of the positive's.

    ``anchors`` is a condition on ``id``. Columns: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.
    """
    clean = usable(rows, id_col, vector_col, label_col, scale)
    # a written copy: block numbers must not change between the two scans
    blocks = saved(column_blocks(clean), "vector-blocks")
    queries = saved(
        clean.where(anchors).dropDuplicates(["id", "label", "vector"])
        .select(F.monotonically_increasing_id().alias("anchor"), "id", "label", "vector"), "anchors"
    )
    groups = max(1, -(-queries.count() // BLOCK_ANCHORS))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(groups).cast("bigint")))

    def near(block, number, own, label, vector):
        found, score = nearest_in(block, np.array(vector, np.int64), own, label, positives)
        return np.full(len(found), number), found, score

    schema = "anchor long, positive_id long, positive_score long"
    close = _answers(_paired(blocks, queries, groups), schema, near)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    close = close.dropDuplicates().withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    close = saved(close, "positives")

    wanted = F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("windows")
    asked = queries.join(close.groupBy("anchor").agg(wanted), "anchor")
    low, high = shares

    def far(block, number, own, label, vector, windows):
        scores = [w["positive_score"] for w in windows]
        limits = np.array([(-(-low * s // 100), high * s // 100) for s in scores], np.int64)
        found = negatives_in(block, np.array(vector, np.int64), label, limits, negatives)
        sizes = [len(ids) for ids, _ in found]
        places = np.repeat([w["place"] for w in windows], sizes)
        return np.full(len(places), number), places, np.concatenate([i for i, _ in found]), np.concatenate([s for _, s in found])

    schema = "anchor long, place long, negative_id long, negative_score long"
    distant = _answers(_paired(blocks, asked.select("anchor", "id", "label", "vector", "windows", "part"), groups), schema, far)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    distant = distant.dropDuplicates().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = close.join(queries.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return distant.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


#: The operator in SQL.
ORACLE = """
WITH clean AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM clean a JOIN clean b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""
