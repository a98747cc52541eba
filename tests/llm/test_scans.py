"""Licence scan, secret scan and repetition rules against brute force."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, repetition, secrets

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(params=["nasty", "real"])
def docs(request):
    return request.getfixturevalue(request.param)


def check(df, docs, brute, names):
    """Same rows as the brute-force function gives, repeated rows and null ids included."""
    want = Counter((r.doc_id, *brute(r.text or "")) for r in docs.select("doc_id", "text").collect())
    got = Counter((r.doc_id, *(r[n] for n in names)) for r in df.collect())
    assert got == want


def license_brute(text):
    words = WORD.findall(text.translate(AZ))
    places = []
    for label, phrase in (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")):
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in places})),
    )


def test_license_base(docs):
    check(licenses.license_scan(docs), docs, license_brute,
          ["n_words", "n_base", "first_word", "last_word", "base_labels"])


def test_license_labels(spark):
    gap = "permission is hereby granted free of charge to any human obtaining a copy of this software and associated files"
    texts = {
        "Licensed under the Apache License, Version 2.0": "apache",
        "see: Apache License": "apache",
        "MIT License": "mit",
        "Mozilla Public License 2.0": "mpl",
        "released into the public domain": "unlicense",
        "GNU General Public License v3": "gnu-gpl,gpl",
        "Released under the MIT License.": "mit",
        gap: "mit",
        gap.replace("hereby", "maybe"): "",
        "hereby granted to any person": "",
        "This work is licensed under the GNU General Public License, version 3": "gnu-gpl,gpl",
        "CC BY-NC 4.0": "cc-by,cc-by-nc",
        "license the under version": "",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.text: r for r in df.join(licenses.license_scan(df), "doc_id").collect()}
    assert {t: r.labels for t, r in got.items()} == texts
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got.values())
    assert got[gap].score < 1 and got[gap].places[0].first == 0


def test_every_planted_notice_is_found(spark):
    """Key phrases at any place of long texts full of the templates' words."""
    rng = random.Random(3)
    words = sorted({w for t in licenses.TEMPLATES for w in t.text.split()}) + ["zebra", "plain"]
    texts, planted = [], []
    for t in licenses.TEMPLATES * 3:
        filler = [rng.choice(words) for _ in range(rng.choice([0, 5, 300]))]
        at = rng.randrange(len(filler) + 1)
        texts.append(" ".join(filler[:at] + [(t.keys or (t.text,))[0].upper()] + filler[at:]))
        planted.append(t.label)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in licenses.license_scan(df).collect()}
    assert all(label in got[i] for i, label in enumerate(planted))


def test_blocks_without_a_word_of_the_index(spark):
    """Neither such blocks nor odd other columns stop a scan."""
    df = spark.createDataFrame([(1, "zzz"), (2, None), (3, "")], "doc_id long, text string").coalesce(1)
    odd = df.select(F.struct("doc_id").alias("meta"), F.lit(1).alias("meta.x"), F.expr("interval 1 day").alias("i"), "doc_id", "text")
    for rows in (df, odd):
        got = {r.doc_id: (r.n_words, r.labels, r.first_word) for r in licenses.license_scan(rows).collect()}
        assert got == {1: (1, "", None), 2: (0, "", None), 3: (0, "", None)}
        assert {r.spans for r in secrets.secret_scan(rows).collect()} == {""}
        assert {r.n_words for r in repetition.repetition_rules(rows).collect()} == {0, 1}


def secret_brute(text):
    spans = []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    kinds = Counter(k for _, k, _ in spans)
    said = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return kinds[0], kinds[1], kinds[2], hashlib.sha256(said.encode()).hexdigest()


def test_secret_base(docs):
    check(secrets.secret_scan(docs), docs, secret_brute, ["n_assign", "n_access", "n_hex", "base_sha256"])


def test_random_strings(spark):
    key = "kZ8w+Q3xJ/7bT1mVpR5yLd0HsGfUeXaC"
    texts = {
        f"é use {key} now": [("random", 6, 6 + len(key))],
        "5d41402abc4b2a76b9719d911017c592": [("hex", 0, 32)],
        "5D41402ABC4B2A76B9719D911017C592": [],
        "123e4567-e89b-12d3-a456-426614174000": [],
        "some_long_identifier_with_words_2024": [],
        "getUserAccountInformationFromDatabase": [],
        "path/to/some/module/file_name/readme": [],
        "internationalizationandlocalization": [],
        "2024-01-02-2024-01-03-2024": [],
        "=" * 40: [],
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = df.join(secrets.secret_scan(df), "doc_id").collect()
    assert {r.text: [tuple(x) for x in r.found] for r in rows} == texts


def test_names_are_told_in_linear_time():
    slow = re.compile(rb"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,})+[0-9]{0,4}")
    for size in range(9):
        for run in itertools.product(b"aB1", repeat=size):
            assert bool(secrets.CAMEL.fullmatch(bytes(run))) == bool(slow.fullmatch(bytes(run))), bytes(run)
    letters = b"abcdefghijklmnopqrstuvwxyz"
    begun = time.process_time()
    for run, known in ((letters.upper() + letters + b"0123456789+/", False), (letters * 400 + b"9x", False),
                       (b"aBcD" * 2500 + b"+/9x", False), (letters * 400 + b"2024", True), ((letters + b"HTTP") * 400, True)):
        assert secrets.is_known(run) == known
    assert time.process_time() - begun < 1


def test_long_runs_are_scanned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    runs = [letters.upper() + letters + "0123456789+/", letters * 400 + "9x", "kZ8w+Q3xJ/7bT1mVpR5yLd0HsGfUeXaC"]
    df = spark.createDataFrame([(0, " ".join(runs))], "doc_id long, text string")
    assert secrets.secret_scan(df).first().spans.endswith(f"random:{len(runs[0]) + len(runs[1]) + 2}:{sum(map(len, runs)) + 2}")


def test_spans_are_sorted_and_joined(nasty):
    for r in secrets.secret_scan(nasty).collect():
        order = {"assign": 0, "access": 1, "hex": 2, "random": 3}
        assert r.found == sorted(r.found, key=lambda x: (x.start, order[x.kind]))
        assert r.spans == ",".join(f"{x.kind}:{x.start}:{x.end}" for x in r.found)


def coverage(words, n):
    seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return {j for i in range(len(words) - n + 1) if seen[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}


def repetition_brute(text):
    words = SOLID.findall(text)
    seen, dup, line_chars = set(), 0, 0
    for line in text.split("\n"):
        if SOLID.search(line):
            if line in seen:
                dup += 1
                line_chars += sum(map(len, SOLID.findall(line)))
            seen.add(line)
    n_repeat, total = len(coverage(words, 8)), sum(map(len, words))
    failed = len(words) < 20 or 100 * n_repeat > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    chars = {n: sum(len(words[j]) for j in coverage(words, n)) for n in repetition.LIMITS}
    bad = failed or 100 * line_chars > 30 * total or 100 * symbols > 10 * total
    bad = bad or any(100 * chars[n] > limit * total for n, limit in repetition.LIMITS.items())
    return len(words), total, symbols, dup, n_repeat, failed, not bad, line_chars, *chars.values()


def test_repetition(docs):
    check(repetition.repetition_rules(docs), docs, repetition_brute,
          ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
           "line_chars", *(f"chars_{n}" for n in repetition.LIMITS)])


def test_blocks_do_not_change_results(spark, nasty, monkeypatch):
    """Texts longer than a block, and many blocks to a batch."""
    from tidemark.llm.words import blocks

    import pyarrow as pa

    texts = pa.array([t for t, in nasty.select("text").collect()], pa.string())
    for size in (1, 50, 1 << 21):
        got = [(b.first, b.text(i)) for b in blocks(texts.slice(2, 30), size) for i in range(len(b))]
        assert [t for _, t in got] == [(t or "").encode() for t in texts.slice(2, 30).to_pylist()]
    small = [repetition.measures(b)["n_repeat_words"].tolist() for b in blocks(texts, 100)]
    whole = [repetition.measures(b)["n_repeat_words"].tolist() for b in blocks(texts)]
    assert sum(small, []) == sum(whole, [])


@pytest.mark.parametrize("run", [licenses.license_scan, secrets.secret_scan, repetition.repetition_rules])
def test_empty_table(spark, nasty, run):
    assert run(nasty.limit(0)).count() == 0
