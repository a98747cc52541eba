"""The pipeline's stages against brute force, each on its own input, and the registration."""

import os
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow as pa
import pytest
from test_contamination import brute as brute_contaminated
from test_scans import secret_brute
from test_simhash import brute_components, brute_print

import corpus_pipeline
from tidemark.llm import quality, secrets
from tidemark.llm.features import features
from tidemark.llm.words import blocks

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's result, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF_DIR).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


def rows(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == COLUMNS


def test_quality_drops_what_the_model_rejects(spark, stages):
    model = quality.train(stages[0], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    want = Counter()
    for r in stages[0].collect():
        if model.score(features(next(blocks(pa.array([r.text])))))[0] >= 0.7:
            want[tuple(r)] += 1
    assert rows(stages[1]) == want and 0 < want.total() < stages[0].count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert all(i in kept for i, y in labels.items() if y == 1)


def test_one_document_of_each_group_stays(stages):
    docs = stages[1].collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in docs]
    own = brute_components(prints)
    assert rows(stages[2]) == Counter(tuple(r) for r, c in zip(docs, own, strict=True) if r.doc_id == c)
    assert stages[2].count() < len(docs)


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hit = {d for d, *_ in brute_contaminated([(r.doc_id, r.text) for r in stages[2].collect()], items)}
    assert rows(stages[3]) == Counter(tuple(r) for r in stages[2].collect() if r.doc_id not in hit)


def test_secrets_are_masked(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    after = {r.doc_id: r for r in stages[4].collect()}
    assert before.keys() == after.keys()
    for i, old in before.items():
        new = after[i]
        assert secret_brute(new.text or "")[:3] == (0, 0, 0)
        if not any(secret_brute(old.text or "")[:3]):
            assert new == old
        else:
            assert "[secret]" in new.text and new.n_chars == len(new.text)


def test_all_that_is_left_is_packed(spark, stages):
    from tidemark.llm.packing import default_vocabulary
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_vocabulary())
    want = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in stages[4].collect()}
    got = defaultdict(int)
    for r in stages[5].collect():
        got[r.doc_id] += r.length
    assert got == want


def test_run_applies_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_DIR)
    key = lambda df: Counter((r.doc_id, r.doc_tokens) for r in df.where("start = 0").collect())
    assert key(got) == key(stages[5])


def test_redaction_joins_overlapping_spans(spark):
    text = 'é token = "0123456789abcdef0123456789abcdef" end'
    df = spark.createDataFrame([(1, text, 5, None), (2, None, None, 1), (3, "", 0, 2)], "doc_id long, text string, n_chars long, found int")
    got = sorted(tuple(r) for r in secrets.redact(df).collect())
    assert got == [(1, 'é [secret]" end', 15, None), (2, None, None, 1), (3, "", 0, 2)]


@pytest.mark.parametrize("name", ["nasty", "empty"])
def test_stages_take_odd_tables(spark, nasty, name):
    docs = nasty.selectExpr("doc_id", "text", "lang", "source", "n_words as n_chars")
    docs = docs.limit(0) if name == "empty" else docs
    for _, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns or "sequence_id" in out.columns
        assert (out.count() == 0) == (name == "empty")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
    assert Counter(kept).most_common(1)[0][1] == 1 if name == "nasty" else not kept


def test_registration():
    import __spark_entry__ as entry

    queries = entry.queries()
    assert "pipeline" in queries
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in queries) == 1


def test_no_column_of_the_documents_is_touched(spark):
    """Columns named like what the stages use inside, of other types, come out as they went in."""
    texts = ["one two three four five"] * 3 + ['token = "0123456789abcdef0123456789abcdef" six seven', None, "", "eight nine ten eleven"]
    names = ["_d", "_id", "_h", "d", "id", "h", "fp", "number", "none", "component_id", "fingerprint", "score", "found", "n_chars", "key"]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((r for r in rows if r[0] in (0, 3, 4, 6)), key=repr)
    twice = corpus_pipeline.near_duplicates(spark, docs.unionAll(docs), SF_DIR)
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(map(tuple, kept.collect()), key=repr)
    masked = corpus_pipeline.secrets(spark, docs, SF_DIR).collect()
    assert [tuple(r)[2:] for r in sorted(masked)] == [r[2:] for r in rows] and "[secret]" in sorted(masked)[3].text
    clean = corpus_pipeline.decontamination(spark, docs, SF_DIR).collect()
    assert sorted(map(tuple, clean), key=repr) == sorted(rows, key=repr)


def test_workers_without_the_package(tmp_path):
    """Started from another folder, the operators' functions travel with the job."""
    script = tmp_path / "run.py"
    root = Path(corpus_pipeline.__file__).resolve().parent
    script.write_text(f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import functions as F
from tidemark.session import build_session
spark = build_session("away", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
from tidemark.llm import hardneg, infill, licenses, ngrams, pages, simhash
docs = spark.createDataFrame([(i, f"some words of text {{i % 3}}") for i in range(6)], "doc_id long, text string")
assert simhash.drop_near_duplicates(docs).count() == 3
assert licenses.license_scan(docs).count() == 6
assert infill.with_restored(infill.fill_in_middle(docs)).where("restored = output").count() < 6
assert ngrams.ngram_scores(docs, F.lit(True)).count() == 6
rows = spark.createDataFrame([(i, [1.0, i / 100], i % 2) for i in range(100, 130)], "vec_id long, embedding array<double>, label int")
assert hardneg.hard_negatives(rows, F.col("id") % 100 == 0).count() > 0
html = spark.createDataFrame([(i, "u", "<html><body><nav class=menu><a>m</a></nav><article><p>Text here.</p></article></body></html>") for i in range(4)],
                             "page_id long, url string, html string")
assert pages.main_texts(html, pages.train(html)).count() == 4
print("done")
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600, check=False)
    assert done.stdout.strip().endswith("done"), done.stderr[-3000:]
