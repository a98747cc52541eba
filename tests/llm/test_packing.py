"""Packing by an exact round trip, and the curve's properties."""

import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing


@pytest.mark.parametrize("name", ["nasty", "real"])
@pytest.mark.parametrize("length", [2048, 64])
def test_round_trip(request, name, length):
    docs = request.getfixturevalue(name)
    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    rows = docs.select("doc_id", "text").collect()
    whole = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in rows}
    copies = Counter(r.doc_id for r in rows)
    pieces = packing.pack(docs, length).collect()
    sequences, of_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = whole[p.doc_id][p.start : p.start + p.length]
        assert p.length == len(ids) > 0
        assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert p.doc_tokens == len(whole[p.doc_id])
        sequences[p.sequence_id].append((p.offset, p.length))
        of_doc[p.doc_id].append((p.start, p.length))
    for doc, ids in whole.items():
        covered = Counter(i for start, n in of_doc[doc] for i in range(start, start + n))
        assert covered == {i: copies[doc] for i in range(len(ids))}
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0  # a power of two: no padding


def test_neighbours_on_the_curve_are_neighbours_in_the_grid():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.array(list(product(range(1 << bits), repeat=n)))
        key = packing.hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_similar_documents_lie_together(real):
    """Documents of one language are nearer on the curve than chance would have it."""
    order = packing.pack(real).where("start = 0").join(real.select("doc_id", "lang"), "doc_id")
    langs = [r.lang for r in order.orderBy("sequence_id", "offset").collect()]
    same = sum(a == b for a, b in zip(langs, langs[1:], strict=False))
    chance = sum(v * v for v in Counter(langs).values()) / len(langs)
    assert same > 1.2 * chance


def test_pieces_have_the_ids_of_the_text():
    """Punctuation, apostrophes, combining marks, digits, other scripts and white space."""
    import random

    import pyarrow as pa

    from tidemark.llm.words import blocks

    rng = random.Random(3)
    parts = ["don't", "'s", "\"'ll", "A", "İ", "e\u0301", "\u0301", "=\u0338", ",", "(", "x9", "12", "\u00a0", "\x1f", " ", "\n",
             "学校", "Straße", "Σας", "ﬁ", "_", "l'eau", "!?", "'", "\u2028", "🙂", "<|endoftext|>", "<|ENDofText|>", "\x00", "K"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    tokens = packing.Encoder(packing.default_vocabulary())
    want = [x.ids + [1] for x in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = []
    for block in blocks(pa.array(texts), 500):
        ids, ends = tokens.encode(block, tokens.words(block))
        got += [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]
    assert got == want


def test_ranges_hold_about_equally_many_tokens(spark):
    """Long documents, one of them a third of all tokens, and a third of the rows being copies."""
    texts = [(i, f"word{i % 7} some text") for i in range(600)] + [(1000 + i, "same words again") for i in range(600)]
    texts += [(5000 + i, "a long text of many words " * 400) for i in range(40)] + [(9000, "one very long text " * 15000)]
    tokens = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"))
    by_task = [r.n for r in tokens.selectExpr("sequence_id >> 33 AS task", "length").groupBy("task").agg({"length": "sum"}).toDF("task", "n").collect()]
    assert len(by_task) > 1
    assert max(by_task) < 2 * sum(by_task) / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_parts_of_a_document_join_into_one_piece(spark):
    docs = spark.createDataFrame([(1, "word " * 1800)], "doc_id long, text string")
    (total,) = {r.doc_tokens for r in packing.pack(docs.repartition(1), 4096).collect()}
    packer = packing.Packer(2048, 0)
    ids = np.arange(total)
    for at in range(0, total, packing.PART):
        packer.add(7, 1, at, ids[at : at + packing.PART], total)
    packer.finish()
    starts = [(p[1], p[2]) for p in packer.out]
    assert [a + n for a, n in starts] == [b for b, _ in starts[1:]] + [total]
    assert len({p[5] for p in packer.out}) == len(packer.out)  # one piece a sequence
    for _, start, n, crc, *_ in packer.out:
        assert crc == zlib.crc32(ids[start : start + n].astype("<u4").tobytes())


def test_empty_table(nasty):
    assert packing.pack(nasty.limit(0)).count() == 0
