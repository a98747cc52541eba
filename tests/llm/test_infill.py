"""Fill-in-the-middle against a plain version, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import infill
from tidemark.llm.infill import Infill


def brute(key, text, seed=7, share=100, spm_share=50):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in infill.SENTINELS) or h[2] % 100 >= share:
        return len(lines), "plain", None, None, text
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < spm_share:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def lined_texts():
    rng = random.Random(11)
    pieces = ["a", "é", "学𝄞", "\n", "\n\n", "\r\n", "<", "<P", "P>", "S>", "<M", ">", " ", " ", "x" * 500]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.choice([1, 2, 5, 30, 200]))) for _ in range(300)]
    return [*texts, "<P>", "a<S>b\n", "\n<M>", "\n", "no line end", "a\n" * 100_000]


def test_apply_and_restore_match_the_plain_version():
    for share, spm_share in ((100, 50), (60, 50), (100, 0), (100, 100)):
        method = Infill(share=share, spm_share=spm_share)
        for key, text in enumerate(lined_texts()):
            n, form, p, m, out = method.apply(str(key), text.encode())
            want = brute(key, text, share=share, spm_share=spm_share)
            assert (n, form, None if p < 0 else p, None if m < 0 else m, out.decode()) == want
            assert method.restore(form, out).decode() == text


def test_rotation_exchanges_any_two_neighbours():
    for size in range(9):
        for start in range(size + 1):
            for end in range(start, size + 1):
                for cut in range(start, end + 1):
                    data = np.arange(size, dtype=np.uint8)
                    want = [*data[:start], *data[cut:end], *data[start:cut], *data[end:]]
                    infill.rotate(data, start, cut, end)
                    assert data.tolist() == want


@pytest.mark.parametrize("name", ["nasty", "real", "lined"])
def test_documents(spark, request, name):
    docs = (
        spark.createDataFrame(list(enumerate(lined_texts())), "doc_id long, text string")
        if name == "lined" else request.getfixturevalue(name)
    )
    made = infill.with_restored(infill.fill_in_middle(docs)).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=repr)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert got == sorted(((i, *brute("" if i is None else i, t)) for i, t in rows), key=repr)
    assert sorted(r.restored for r in made) == sorted(t for _, t in rows)


def test_other_columns_and_text_ids(spark):
    docs = spark.createDataFrame([("a", "x\ny\n", 1, "f", "o"), ("a", "x\ny\n", 1, "f", "o")], "n string, text string, id int, form string, output string")
    made = infill.fill_in_middle(docs.withColumnRenamed("n", "key"), id_col="key").collect()
    assert len(made) == 2 and made[0] == made[1] and made[0].output == brute("a", "x\ny\n")[4]
    assert infill.fill_in_middle(docs.withColumnRenamed("n", "key").limit(0), id_col="key").count() == 0
    alike = docs.select(F.lit(1).alias("id"), "text")
    assert infill.with_restored(infill.fill_in_middle(alike, id_col="id")).first().restored == "x\ny\n"
