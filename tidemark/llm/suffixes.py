"""Exact removal of repeated substrings by sharded suffix arrays.

Every byte is removed that a substring of ``least`` bytes covers which also
starts earlier: in a document of a smaller id, or earlier in the same one.

1. Anchors. The smallest hash among the substrings of ``SEED`` bytes inside a
   window of ``least`` bytes depends on the window's content only, so equal
   windows have equal anchors. Successive windows with one anchor form a
   fragment. Fragments that a task has seen are copies and stop there.
2. Fragments meet by anchor. All but the first of equal fragments are covered
   whole. Fragments of one anchor that differ have to be compared, as have those
   that hold their anchor's seed twice; other fragments, most of the text, are done.
3. The texts of fragments to compare are dealt into shards by anchor, those of
   an anchor with very many into several shards. A shard's suffix array comes
   from Larsson-Sadakane refinement, its common prefixes from Kasai's scan, run
   over all fragments at once. Neighbours that share ``least`` bytes are equal
   windows, and all but the first of them are repeated.
4. Where one anchor has several shards, their sorted first windows are merged
   by binary search, and the later of two equal ones is repeated.
5. The repeated spans are merged per document and cut out.

Defined results: null texts are empty; null ids come after all others. Rows
equal in id and text are one document and get equal results; different texts of
one id are ordered by their hash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import numbered, saved
from .words import U64, Block, blocks, buffers, byte_prefix, mix, powers, ragged, span_hash

#: Bytes of a seed; windows in a fragment at most.
SEED, RUN = 32, 120
#: Fragments of one anchor in a shard at most; bytes of a shard.
SHARD_ROWS, SHARD_BYTES = 1_000, 1 << 19


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` successive values."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(U64).max, U64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def fragments(block: Block, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte in the block, windows, anchor and content hash of every fragment.

    A fragment in which the anchor's seed comes more than once may repeat itself;
    128 is added to its number of windows.
    """
    data, seed = block.data, min(SEED, least)
    room = np.maximum(np.diff(block.offsets) - least + 1, 0)
    if not room.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none.copy()
    sums = byte_prefix(data)
    count = len(data) - seed + 1
    hashes = mix((sums[seed:] - sums[:count]) * powers(len(sums), inverse=True)[:count])
    lowest = sliding_min(hashes, least - seed + 1)
    start = ragged(block.offsets[:-1], room)
    anchor = lowest[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    # long runs, of periodic text, are cut
    sizes = np.diff(np.append(first, len(start)))
    pieces = -(-sizes // RUN)
    cut = np.repeat(first, pieces) + RUN * ragged(np.zeros(len(first), np.int64), pieces)
    sizes = np.diff(np.append(cut, len(start)))
    low = start[cut]
    content = span_hash(sums, low, low + sizes + least - 1)
    seeds = sizes + least - seed
    met = hashes[ragged(low, seeds)] == np.repeat(anchor[cut], seeds)
    several = np.add.reduceat(met, np.cumsum(seeds) - seeds, dtype=np.int64) > 1
    return low, sizes + 128 * several, (anchor[cut] >> U64(9)).astype(np.int64), content.view(np.int64)


def suffix_array(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and rank of all suffixes; suffix i ends at ``ends[i]``.

    Larsson and Sadakane: suffixes are grouped by their first bytes; a group that
    is not yet sorted is refined by the ranks of the suffixes that many bytes on,
    which doubles the length. Equal suffixes keep the order of their positions.
    """
    n = len(text)
    position = np.arange(n)
    key = np.zeros(n, U64)
    wide = np.concatenate((text.astype(U64) + U64(1), np.zeros(7, U64)))
    for k in range(7):
        key = (key << U64(9)) | np.where(position + k < ends, wide[k : k + n], U64(0))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    change = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    rank = np.empty(n, np.int64)
    group = np.flatnonzero(change)[np.cumsum(change) - 1]
    rank[order] = group
    reach, longest = 7, int((ends - position).max(initial=0))
    active = np.flatnonzero(~(change & np.append(change[1:], True)))
    while len(active) and reach < longest:
        own = order[active]
        beyond = own + reach
        inside = beyond < ends[own]
        further = np.where(inside, rank[np.where(inside, beyond, 0)] + 1, 0)
        both = (rank[own].astype(U64) << U64(32)) | further.astype(U64)
        by = np.argsort(both, kind="stable")
        own, both = own[by], both[by]
        # groups fill the same places as before, in a finer order
        order[active] = own
        fresh = np.concatenate(([True], both[1:] != both[:-1]))
        rank[own] = active[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        active = active[~(fresh & np.append(fresh[1:], True))]
        reach *= 2
    rank[order] = position
    return order, rank


def common_prefixes(text: np.ndarray, begins: np.ndarray, ends: np.ndarray, order, rank, limit: int) -> np.ndarray:
    """For each position in the order, the bytes (at most ``limit``) shared with the one before.

    Kasai: the suffix one byte on shares at least one byte less with its
    predecessor, so a scan goes on where it stopped. All fragments are scanned
    side by side, one byte at a time.
    """
    out = np.zeros(len(text), np.int64)
    stop = np.repeat(ends, ends - begins)
    shared = np.zeros(len(begins), np.int64)
    live = np.arange(len(begins))
    for step in range(int((ends - begins).max(initial=0))):
        live = live[begins[live] + step < ends[live]]
        at = begins[live] + step
        place = rank[at]
        before = order[np.maximum(place - 1, 0)]
        most = np.minimum(np.minimum(ends[live] - at, stop[before] - before), limit)
        most[place == 0] = 0
        h = np.minimum(np.maximum(shared[live] - 1, 0), most)
        open_ = np.flatnonzero(h < most)
        while len(open_):
            equal = text[at[open_] + h[open_]] == text[before[open_] + h[open_]]
            open_ = open_[equal]
            h[open_] += 1
            open_ = open_[h[open_] < most[open_]]
        shared[live] = h
        out[place] = h
    return out


def equal_windows(text: np.ndarray, begins: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``least`` bytes inside the fragments, in sorted order, and for each the first equal one."""
    order, rank = suffix_array(text, np.repeat(ends, ends - begins))
    shared = common_prefixes(text, begins, ends, order, rank, least)
    whole = np.repeat(ends, ends - begins)[order] - order >= least
    order, new = order[whole], shared[whole] < least
    if not len(order):
        return order, order
    new[0] = True
    runs = np.flatnonzero(new)
    return order, np.minimum.reduceat(order, runs)[np.cumsum(new) - 1]


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], names=list(columns))


def sliced(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of so many rows, so that neither side holds all of it at once."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


def fragment_rows(least: int):
    """Map task: documents (d, text) to fragments; those the task has seen are marked as copies."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            parts = []
            for block in blocks(batch.column(1)):
                low, size, anchor, content = fragments(block, least)
                doc = np.searchsorted(block.offsets, low, "right") - 1
                parts.append((anchor << 8 | size, content, ids[block.first + doc], low - block.offsets[doc]))
            key, content, d, low = (np.concatenate(c) for c in zip(*parts, strict=True))
            by = np.lexsort((low, d, content, key))
            key, content, d, low = key[by], content[by], d[by], low[by]
            copy = np.zeros(len(key), bool)
            copy[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
            same = np.zeros(len(key), bool)  # the same row of the table again
            same[1:] = copy[1:] & (d[1:] == d[:-1]) & (low[1:] == low[:-1])
            for some in (~copy, copy & ~same):
                # copies are dealt by content and place, as they need no company
                spread = key[some] if not copy[some].any() else mix(d[some].view(U64) + low[some].astype(U64)).view(np.int64)
                found = batch_of(key=key[some], content=content[some], d=d[some], low=low[some],
                                 copy=copy[some], spread=spread >> 8)
                yield from sliced(found, 50_000)

    return run


def matched_rows(batches):
    """Reduce task: fragments sorted by key and content to copies and those to compare.

    Of the group that may go on in the next batch, only its last fragment and
    whether it had company is kept.
    """
    last = None  # key, content, d, low of the newest run's first row; whether it was already passed on
    for batch in batches:
        key, content, d, low = (batch.column(k).to_numpy() for k in range(4))
        copy = batch.column(4).to_numpy(zero_copy_only=False).copy()
        free = copy  # known copies pass
        if free.any():
            yield batch_of(copy=np.ones(free.sum(), bool), anchor=key[free] >> 8, d=d[free], low=low[free], size=key[free] & 127)
            key, content, d, low = key[~free], content[~free], d[~free], low[~free]
        if not len(key):
            continue
        passed = False
        if last is not None:
            key, content, d, low = (np.concatenate(([a], b)) for a, b in zip(last[:4], (key, content, d, low), strict=True))
            passed = last[4]
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
        if again.any():
            # the same row of the table again is no copy
            first = np.maximum.accumulate(np.where(again, 0, np.arange(len(key))))
            other = again & ((d != d[first]) | (low != low[first]))
            yield batch_of(copy=np.ones(other.sum(), bool), anchor=key[other] >> 8, d=d[other], low=low[other], size=key[other] & 127)
        key, content, d, low = key[~again], content[~again], d[~again], low[~again]
        anchor = key >> 8
        company = np.zeros(len(key), bool)
        company[1:] |= anchor[1:] == anchor[:-1]
        company[:-1] |= anchor[:-1] == anchor[1:]
        known = company | (key >> 7 & 1).astype(bool)  # or it may repeat itself
        out = known.copy()
        if passed:
            known[0], out[0] = True, False
        some = np.flatnonzero(out)
        if len(some):
            yield batch_of(copy=np.zeros(len(some), bool), anchor=anchor[some], d=d[some], low=low[some], size=key[some] & 127)
        last = key[-1], content[-1], d[-1], low[-1], bool(known[-1])


def spans_of(d, start, end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted and merged spans."""
    by = np.lexsort((end, start, d))
    d, start, end = d[by], start[by], end[by]
    if not len(d):
        return d, start, end
    # the furthest end so far within a document
    shift = np.cumsum(np.concatenate(([0], d[1:] != d[:-1]))) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate(([True], (start + shift)[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(d)) - 1
    return d[first], start[first], reach[last] - shift[last]


def compare_rows(least: int):
    """Reduce task: fragments (anchor, shard, d, low, split, text), sorted, to repeated spans.

    Of anchors dealt to several shards it also gives the first windows, for the merge.
    """

    def shard(parts):
        number, d, low, split, data, sizes = (np.concatenate(c) for c in zip(*parts, strict=True))
        # earlier fragments first, whatever their group
        by = np.lexsort((low, d))
        data = data[ragged((np.cumsum(sizes) - sizes)[by], sizes[by])]
        number, d, low, split, sizes = (c[by] for c in (number, d, low, split, sizes))
        ends = np.cumsum(sizes)
        begins = ends - sizes
        order, first = equal_windows(data, begins, ends, least)
        of = np.repeat(np.arange(len(sizes)), sizes)
        again = order[order != first]
        at = low[of[again]] + again - begins[of[again]]
        dd, start, end = spans_of(d[of[again]], at, at + least)
        if len(dd):
            none = pa.nulls(len(dd), pa.binary())
            yield batch_of(shard=np.zeros(len(dd), np.int64), d=dd, start=start, end=end, window=none)
        lone = order[(order == first) & split[of[order]]]
        if len(lone):
            text = data[lone[:, None] + np.arange(least)]
            at = low[of[lone]] + lone - begins[of[lone]]
            window = pa.array(list(map(bytes, text)), pa.binary())
            yield batch_of(shard=number[of[lone]], d=d[of[lone]], start=at, end=at + least, window=window)

    def run(batches):
        held, size, group = [], 0, None
        for batch in batches:
            anchor, number = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = buffers(batch.column(5))
            columns = number, *(batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4))
            # groups stay together; a shard takes groups until it is full
            edges = np.flatnonzero((anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1])) + 1
            for begin, end in zip(np.concatenate(([0], edges)), np.append(edges, len(anchor)), strict=True):
                now = anchor[begin], number[begin]
                if now != group and size >= SHARD_BYTES:
                    yield from shard(held)
                    held, size = [], 0
                group = now
                own = offsets[begin : end + 1]
                held.append((*(c[begin:end] for c in columns), data[own[0] : own[-1]], np.diff(own)))
                size += int(own[-1] - own[0])
        if held:
            yield from shard(held)

    return run


def merge_rows(least: int):
    """Reduce task: first windows (shard, window, d, start), sorted by shard and window, to repeated spans.

    A shard's windows are looked up among those held by binary search. Of two
    equal ones the earlier is held and the later is repeated.
    """
    place_type = np.dtype([("d", np.int64), ("start", np.int64)])

    def run(batches):
        held, held_at = np.zeros(0, f"S{2 * least}"), np.zeros(0, place_type)
        for batch in batches:
            shard = batch.column(0).to_numpy()
            data, offsets = buffers(batch.column(1))
            # hexadecimal digits keep the order, and numpy strips zero bytes from strings
            keys = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes().hex().encode(), held.dtype)
            at = np.zeros(len(keys), place_type)
            at["d"], at["start"] = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for part in np.split(np.arange(len(keys)), np.flatnonzero(shard[1:] != shard[:-1]) + 1):
                place = np.searchsorted(held, keys[part])
                found = np.zeros(len(part), bool)
                inner = place < len(held)
                found[inner] = held[place[inner]] == keys[part][inner]
                old, new = held_at[place[found]], at[part][found]
                newer = (new["d"] > old["d"]) | ((new["d"] == old["d"]) & (new["start"] > old["start"]))
                late = np.where(newer, new, old)[old != new]
                if len(late):
                    d, start, end = spans_of(late["d"], late["start"], late["start"] + least)
                    yield batch_of(d=d, start=start, end=end)
                held_at[place[found]] = np.where(newer, old, new)
                held_at = np.insert(held_at, place[~found], at[part][~found])
                held = np.insert(held, place[~found], keys[part][~found])

    return run


def packed(batches):
    """Map task: texts compressed, for the way through a shuffle."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    for batch in (part for whole in batches for part in sliced(whole, 2_000)):
        data, offsets = buffers(batch.column(2))
        zipped = [press.compress(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:], strict=False)]
        yield batch_of(id=batch.column(0), d=batch.column(1), packed=pa.array(zipped, pa.binary()))


def cut_rows(least: int):
    """Join task: documents with the places of their fragments to the fragments' texts."""

    def run(batches):
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        for batch in (part for whole in batches for part in sliced(whole, 500)):
            wanted = batch.column(2)
            size = wanted.value_lengths().to_numpy()
            flat = wanted.flatten()
            low, windows, anchor, shard = (flat.field(k).to_numpy() for k in range(4))
            split = flat.field(4)
            texts, at = [], 0
            for d, raw in enumerate(batch.column(1)):
                text = unpress.decompress(raw.as_py())
                for k in range(at, at + size[d]):
                    texts.append(text[low[k] : low[k] + windows[k] + least - 1])
                at += size[d]
            yield batch_of(anchor=anchor, shard=shard, d=np.repeat(batch.column(0).to_numpy(), size), low=low,
                           split=split, text=pa.array(texts, pa.binary()))

    return run


def removed_rows(batches):
    """Join task: documents with their repeated spans to what is left of them."""
    import zstandard

    unpress = zstandard.ZstdDecompressor()
    for batch in (part for whole in batches for part in sliced(whole, 1_000)):
        sizes, removed, runs, kept, digests = [], [], [], [], []
        for raw, spans in zip(batch.column(1), batch.column(2), strict=True):
            text = unpress.decompress(raw.as_py())
            own = spans.values
            parts, at, n = [], 0, 0
            if own is not None and len(own):
                start, end = own.field(0).to_numpy(), own.field(1).to_numpy()
                _, start, end = spans_of(np.zeros(len(start), np.int64), start, end)
                n = len(start)
                for s, e in zip(start.tolist(), end.tolist(), strict=True):
                    parts.append(text[at:s])
                    at = e
            left = b"".join([*parts, text[at:]])
            sizes.append(len(text))
            removed.append(len(text) - len(left))
            runs.append(n)
            kept.append(left)
            digests.append(hashlib.sha256(left).hexdigest())
        yield batch_of(id=batch.column(0), n_bytes=pa.array(sizes, pa.int64()), n_removed=pa.array(removed, pa.int64()),
                       n_spans=pa.array(runs, pa.int64()), kept=pa.array(kept, pa.binary()),
                       kept_sha256=pa.array(digests, pa.string()))


def repeated_spans(rows: DataFrame, packed_rows: DataFrame, least: int) -> DataFrame:
    """(d, start, end): spans that together cover all repeated bytes of numbered documents."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.select("d", "text").mapInArrow(
        fragment_rows(least), "key long, content long, d long, low long, copy boolean, spread long"
    )
    found = found.repartition(parts, "spread").select("key", "content", "d", "low", "copy")
    found = found.sortWithinPartitions("key", "content", "d", "low")
    schema = "copy boolean, anchor long, d long, low long, size long"
    matched = saved(found.mapInArrow(matched_rows, schema), "matched-fragments")
    copies = matched.where("copy").select("d", F.col("low").alias("start"), (F.col("low") + F.col("size") + (least - 1)).alias("end"))

    wanted = matched.where("NOT copy")
    hot = wanted.groupBy("anchor").count().where(F.col("count") > SHARD_ROWS)
    hot = saved(hot.select("anchor", F.ceil(F.col("count") / SHARD_ROWS).alias("shards")), "hot-anchors")
    if hot.isEmpty():
        wanted = wanted.withColumns({"shard": F.lit(0).cast("bigint"), "split": F.lit(False)})
    else:
        wanted = wanted.join(hot, "anchor", "left")
        shard = F.when(F.col("shards").isNull(), 0).otherwise(F.pmod(F.xxhash64("d", "low"), "shards")).cast("bigint")
        wanted = wanted.withColumns({"shard": shard, "split": F.col("shards").isNotNull()})
    wanted = wanted.groupBy("d").agg(F.collect_list(F.struct("low", "size", "anchor", "shard", "split")).alias("wanted"))
    texts = packed_rows.join(wanted, "d").select("d", "packed", "wanted")
    texts = texts.mapInArrow(cut_rows(least), "anchor long, shard long, d long, low long, split boolean, text binary")
    texts = texts.repartition(parts, "anchor", "shard").sortWithinPartitions("anchor", "shard", "d", "low")
    schema = "shard long, d long, start long, end long, window binary"
    compared = saved(texts.mapInArrow(compare_rows(least), schema), "compared-fragments")

    lone = compared.where("window IS NOT NULL").select("shard", "window", "d", "start")
    lone = lone.repartition(parts, "window").sortWithinPartitions("shard", "window")
    merged = lone.mapInArrow(merge_rows(least), "d long, start long, end long")
    return copies.unionAll(compared.where("window IS NULL").select("d", "start", "end")).unionAll(merged)


def remove_repeats(docs: DataFrame, least: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, ``kept`` (bytes), kept_sha256."""
    rows, number, _ = numbered(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = rows.select(F.col(id_col).alias("id"), F.col(number).alias("d"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    packed_rows = rows.mapInArrow(packed, f"id {kind}, d long, packed binary")
    spans = repeated_spans(rows, packed_rows, least)
    per_doc = spans.groupBy("d").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = packed_rows.join(per_doc, "d", "left").select("id", "packed", "spans")
    out = joined.mapInArrow(
        removed_rows, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )
    return out.withColumnRenamed("id", id_col)
