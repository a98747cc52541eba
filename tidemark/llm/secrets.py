"""Secret scan: fixed patterns, and random strings by their token efficiency.

A byte-pair vocabulary writes ordinary words and names with few tokens. Random
strings fall apart into short ones, so few characters per token expose them.
Candidates are unbroken runs of key characters; digests and identifiers, which
are as random or as long but no secrets, are excluded before the test.

Defined results: a null or empty text has no spans. A null id is kept as null.
Equal texts get equal spans; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import LEADS, Block, blocks, byte_class, map_blocks

# The three base kinds, in the order in which they are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
LEAST_ASSIGN, LEAST_HEX = 8, 32

#: The method's own kind.
RANDOM = "random"
HEX = byte_class((0x30, 0x39), (0x61, 0x66))
KEY_CHARS = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), *((ord(c),) * 2 for c in "+/_=-"))
#: A candidate's least length, and the most characters per token of a random one.
LEAST_RANDOM, MOST_RATIO = 20, 2.4

DIGEST = re.compile(rb"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.I)
UUID = re.compile(rb"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", re.I)
#: Words of letters or of digits, joined by separators or by a capital: names, paths, dates.
IDENTIFIER = re.compile(rb"[+/_=-]*(?:(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]+|[A-Za-z])(?:[+/_=-]+|$))+")
#: Words of two letters at least, which capitals may begin, then few digits. Possessive: nothing is tried twice.
CAMEL = re.compile(rb"(?=[A-Za-z])(?:[A-Z]*+[a-z]{2,}+)*+(?:[A-Z]{2,}+)?+[0-9]{0,4}+")
VOCABULARY = "byte_bpe_50k.tiktoken"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def load_encoding(path: str):
    """The tiktoken encoding of a file of base64 tokens and ranks."""
    import public_tokenizers
    import tiktoken

    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        token, _, rank = line.partition(b" ")
        if rank:
            ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding(
        Path(path).stem, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def is_known(run: bytes) -> bool:
    """Digests, identifiers and runs without both letters and digits or both cases."""
    if DIGEST.fullmatch(run) or UUID.fullmatch(run):
        return True
    if len(set(run)) < 8 or IDENTIFIER.fullmatch(run) or CAMEL.fullmatch(run):
        return True
    digits = sum(48 <= c <= 57 for c in run)
    return digits == 0 and (run.islower() or run.isupper()) or digits >= len(run) - 2


def spans_of(block: Block, encoding=None) -> list[list[tuple[str, int, int]]]:
    """Per document of a block, all spans as kind, start and end in bytes."""
    data, offsets, n = block.data, block.offsets, len(block)
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(n)]
    raw = data.tobytes()
    low = raw.lower()
    for d in range(n):
        begin, end = int(offsets[d]), int(offsets[d + 1])
        for m in ASSIGN.finditer(low, begin, end):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                out[d].append(("assign", m.start() - begin, m.end() - begin))
    owner = lambda at: int(np.searchsorted(offsets, at, "right")) - 1
    at = raw.find(b"AKIA")
    while at >= 0:
        d = owner(at)
        m = ACCESS.match(raw, at, int(offsets[d + 1]))
        if m:
            out[d].append(("access", at - int(offsets[d]), m.end() - int(offsets[d])))
        at = raw.find(b"AKIA", m.end() if m else at + 1)
    starts, ends, _ = block.spans(HEX[data])
    for k in np.flatnonzero(ends - starts >= LEAST_HEX):
        d = owner(starts[k])
        out[d].append(("hex", int(starts[k] - offsets[d]), int(ends[k] - offsets[d])))
    if encoding is not None:
        starts, ends, _ = block.spans(KEY_CHARS[data])
        for k in np.flatnonzero(ends - starts >= LEAST_RANDOM):
            run = raw[starts[k] : ends[k]]
            if is_known(run):
                continue
            tokens = len(encoding.encode_ordinary(run.decode("ascii")))
            if len(run) < MOST_RATIO * tokens:
                d = owner(starts[k])
                out[d].append((RANDOM, int(starts[k] - offsets[d]), int(ends[k] - offsets[d])))
    return out


def secret_scan(
    docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``found`` has kind, start, end (code points, end exclusive) of each
    span by start, then kind; counts and digest of the base kinds; ``spans`` as text."""
    rank = {k: i for i, k in enumerate((*KINDS, RANDOM))}

    def make():
        encoding = load_encoding(vocabulary or default_vocabulary())

        def work(block: Block) -> dict:
            found = spans_of(block, encoding)
            counts = {k: np.zeros(len(block), np.int64) for k in rank}
            digests, texts, lists = [], [], []
            for d, spans in enumerate(found):
                if spans:
                    begin, end = block.offsets[d], block.offsets[d + 1]
                    points = np.concatenate(([0], np.cumsum(LEADS[block.data[begin:end]])))
                    spans = sorted((int(points[s]), rank[k], int(points[e]), k) for k, s, e in spans)
                for *_, kind in spans:
                    counts[kind][d] += 1
                said = [(k, f"{k}:{s}:{e}") for s, _, e, k in spans]
                base = ",".join(x for k, x in said if k != RANDOM)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                texts.append(",".join(x for _, x in said))
                lists.append([{"kind": k, "start": s, "end": e} for s, _, e, k in spans])
            return {
                **{f"n_{k}": pa.array(v) for k, v in counts.items()},
                "base_sha256": pa.array(digests, pa.string()),
                "spans": pa.array(texts, pa.string()),
                "found": pa.array(lists, pa.list_(pa.struct(
                    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
            }

        return work

    counts = "".join(f"n_{k} long, " for k in rank)
    return map_blocks(
        docs,
        f"{counts}base_sha256 string, spans string, found array<struct<kind:string,start:bigint,end:bigint>>",
        make, id_col, text_col,
    )


def redact(
    docs: DataFrame, mark: str = "[secret]", vocabulary: str | None = None, text_col: str = "text", size_col: str | None = "n_chars"
) -> DataFrame:
    """The documents with every run of found spans replaced by a mark.

    ``size_col``, where the table has it as a whole number, gets the new length of a changed text.
    Texts without a span, nulls included, stay as they are.
    """
    at = docs.columns.index(text_col)
    whole = ("bigint", "int", "smallint")
    sized = size_col in docs.columns and docs.schema[size_col].dataType.simpleString() in whole
    size_at = docs.columns.index(size_col) if sized else None

    def run(batches):
        encoding = load_encoding(vocabulary or default_vocabulary())
        for batch in batches:
            texts = batch.column(at).to_pylist()
            sizes = batch.column(size_at).to_pylist() if size_at is not None else None
            for block in blocks(batch.column(at)):
                for d, spans in enumerate(spans_of(block, encoding)):
                    if not spans:
                        continue
                    row, raw, parts, end = block.first + d, block.text(d), [], 0
                    for _, s, e in sorted(spans, key=lambda x: x[1:]):
                        if s >= end:
                            parts += [raw[end:s], mark.encode()]
                        end = max(end, e)
                    texts[row] = b"".join([*parts, raw[end:]]).decode("utf-8", "replace")
                    if sizes is not None:
                        sizes[row] = len(texts[row])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            if sizes is not None:
                columns[size_at] = pa.array(sizes, columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
