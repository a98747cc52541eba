"""Fill-in-the-middle documents by rotating blocks in place.

A text is cut at two line ends into prefix, middle and suffix. A byte buffer gets
the text with a sentinel before each segment, and segments change places by
three reversals: each of two neighbours is reversed, then both together. No segment is
copied out. Restoring looks the sentinels up, applies the inverse rotations and
removes them; sentinels occur nowhere else, as texts that hold one stay plain.

A line is all up to and with a line feed, or what is left at the end. Where the cuts
fall and which form is taken follows from the first four 8-digit groups of the
hex SHA-256 of ``<seed>:<id>``, so a document's form never depends on its batch.

Defined results: null and empty texts are plain, without lines and with an empty
output. A null id counts as an empty one. Equal rows get equal results. An empty
table gives none. A text of any length is worked on whole, alone in its buffer; a
task holds about a quarter of a megabyte of texts at a time, or one longer text.
Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .words import LEADS, arrow_schema, blocks

SENTINELS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draws(seed: int, key: str) -> list[int]:
    """Four numbers below 2**32 that belong to a document."""
    digits = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def line_ends(text: np.ndarray) -> np.ndarray:
    """The ends of all lines, in bytes."""
    ends = np.flatnonzero(text == 0x0A) + 1
    return ends if not len(text) or (len(ends) and ends[-1] == len(text)) else np.append(ends, len(text))


def rotate(buffer: np.ndarray, start: int, cut: int, end: int) -> None:
    """Exchange buffer[start:cut] and buffer[cut:end] in place."""
    for low, high in ((start, cut), (cut, end), (start, end)):
        half = (high - low) // 2
        head, tail = buffer[low : low + half], buffer[high - half : high][::-1]
        kept = head.copy()
        head[:] = tail
        tail[:] = kept


class Infill:
    """The transformation with its sentinels: ``apply`` to a text, ``restore`` from an output."""

    def __init__(self, seed: int = 7, share: int = 100, spm_share: int = 50, sentinels=SENTINELS):
        self.seed, self.share, self.spm_share = seed, share, spm_share
        self.prefix, self.suffix, self.middle = (s.encode() for s in sentinels)

    def apply(self, key: str, text: bytes) -> tuple[int, str, int, int, bytes]:
        """Lines, form, code points of prefix and middle (-1 if plain), output."""
        data = np.frombuffer(text, np.uint8)
        ends = line_ends(data)
        n = len(ends)
        h = draws(self.seed, key)
        if not n or any(s in text for s in (self.prefix, self.suffix, self.middle)) or h[2] % 100 >= self.share:
            return n, PLAIN, -1, -1, text
        low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        cuts = [int(ends[k - 1]) if k else 0 for k in (low, high)]
        # prefix, middle, suffix, each after its sentinel
        buffer = bytearray(text)
        for at, sentinel in ((cuts[1], self.suffix), (cuts[0], self.middle), (0, self.prefix)):
            buffer[at:at] = sentinel
        middle = cuts[0] + len(self.prefix)
        suffix = middle + len(self.middle) + cuts[1] - cuts[0]
        view = np.frombuffer(buffer, np.uint8)
        rotate(view, middle, suffix, len(view))  # prefix, suffix, middle
        form = SPM if h[3] % 100 < self.spm_share else PSM
        if form == SPM:
            rotate(view, 0, middle, middle + len(view) - suffix)  # suffix, prefix, middle
        points = [int(np.count_nonzero(LEADS[data[a:b]])) for a, b in ((0, cuts[0]), cuts)]
        return n, form, *points, view.tobytes()

    def restore(self, form: str, output: bytes) -> bytes:
        """The text that an output was made of."""
        if form == PLAIN:
            return output
        buffer = bytearray(output)
        view = np.frombuffer(buffer, np.uint8)
        middle = output.index(self.middle)
        second = output.index(self.prefix if form == SPM else self.suffix)
        if form == SPM:
            rotate(view, 0, second, middle)  # prefix, suffix, middle
            second = middle - second
        rotate(view, second, middle, len(view))  # prefix, middle, suffix
        del view
        suffix = second + len(output) - middle
        for at, sentinel in ((suffix, self.suffix), (second, self.middle), (0, self.prefix)):
            del buffer[at : at + len(sentinel)]
        return bytes(buffer)


def fill_in_middle(docs: DataFrame, method: Infill | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars``, ``output``."""
    method = method or Infill()
    schema = "n long, form string, prefix_chars long, middle_chars long, output string"
    types = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(2)):
                keys = batch.column(1)[block.rows].to_pylist()
                columns = list(zip(*(method.apply(key or "", block.text(i)) for i, key in enumerate(keys)), strict=True))
                arrays = [pa.array([None if v == -1 else v for v in c], kind) for c, kind in zip(columns[:4], types.types, strict=False)]
                output = pa.array(columns[4], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.rows], *arrays, output], names=["id", *types.names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def with_restored(made: DataFrame, method: Infill | None = None, name: str = "restored") -> DataFrame:
    """The rows of ``fill_in_middle`` (or others with ``form`` and ``output``) and the texts rebuilt from them."""
    method = method or Infill()
    form, output = made.columns.index("form"), made.columns.index("output")

    def run(batches):
        for batch in batches:
            there = batch.column(output).is_valid().to_pylist()
            for block in blocks(batch.column(output)):
                part = batch.slice(block.first, len(block))
                texts = [
                    method.restore(f, block.text(i)) if there[block.first + i] else None
                    for i, f in enumerate(part.column(form).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, name]
                )

    return made.mapInArrow(run, StructType([*made.schema.fields, StructField(name, StringType())]))


#: The operator in SQL.
ORACLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines
  FROM documents),
drawn AS (
  SELECT doc_id, text, lines, len(lines) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(lines) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(lines) + 1) AS b,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS d
  FROM cut),
parts AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
              THEN 'plain' WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(lines[1:least(a, b)], '') AS prefix,
         array_to_string(lines[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(lines[greatest(a, b) + 1:], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
         WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""
