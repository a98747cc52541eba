"""Containment search against comparing every document with every item."""

import random
import re

import pytest

from tidemark.llm import contamination
from tidemark.llm.contamination import contaminated, decontaminate

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def grams(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(docs, items, n=5):
    out = []
    for doc, text in docs:
        for item, asked in set(items):
            w = words(asked)
            size = min(n, len(w))
            want = grams(w, size) if size else set()
            shared = len(want & grams(words(text), size)) if want else 0
            if want and 10 * shared >= 8 * len(want):
                out.append((doc, item, shared, len(want), shared / len(want)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def planted(spark):
    """Items whole, shortened, changed and scattered in documents around the threshold."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["école", "Straße", "the"]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice([1, 3, 5, 7, 14, 30, 64, 200])))) for i in range(40)]
    items += [items[0], (None, items[9][1]), (50, None), (51, ""), (52, "?!")]
    docs = []
    for i in range(160):
        w = prose(rng.choice([0, 20, 300]))
        item = (rng.choice(items[:40])[1]).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            item[rng.randrange(len(item))] = "changed"
        if rng.random() < 0.3:
            item = item[: -(len(item) // 6) or None]
        cut = rng.randrange(len(item) + 1) if rng.random() < 0.2 else 0
        docs.append((i, ", ".join([*w, *(x.upper() if x.isascii() else x for x in item[cut:]), "--", *prose(8), *item[:cut]])))
    docs += [(None, docs[3][1]), (161, None), (162, ""), docs[5]]
    return docs, items


@pytest.mark.parametrize("pass_bytes", [contamination.PASS_BYTES, 2000])
def test_planted(spark, planted, pass_bytes):
    docs, items = planted
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item", "2 as n_shared", "3 as words")
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as item", "1 as doc_id")
    got = contaminated(left, right, pass_bytes=pass_bytes)
    want = brute(docs, items)
    assert len(want) > 40
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_decontaminate_drops_what_is_found(spark, planted):
    docs, items = planted
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'en' as lang")
    right = spark.createDataFrame(items, "item_id long, text string")
    hit = {d for d, *_ in brute(docs, items)}
    want = sorted((d for d, _ in docs if d not in hit and d is not None))
    kept = decontaminate(left, right)
    assert kept.columns == left.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want


def test_empty_tables(spark, planted):
    docs, items = planted
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    assert contaminated(left.limit(0), right).count() == 0
    assert contaminated(left, right.limit(0)).count() == 0
    assert decontaminate(left, right.limit(0)).count() == len(docs)
