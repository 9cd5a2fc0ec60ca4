"""The pipeline's stages on small documents, and that the rest stands without this subpackage."""

import hashlib
import os
import shutil
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(i):
    return " ".join(f"word{(i * 7 + j * j) % 977}" for j in range(60))


def documents(spark):
    texts = [plain(i) + "\nshared footer line" for i in range(30)]
    texts += [None, "", "12 34 !?", plain(3) + "\nshared footer line", plain(4).upper() + "\nShared footer line ", "shared footer line"]
    rows = [(i if i != 7 else None, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, len(t or ""), i) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5]], SCHEMA)


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, written and read again."""
    docs, out = documents(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""))
        out[name] = docs
    return out


def test_language_lets_documents_with_letters_pass(spark, stages):
    got = stages["language"].collect()
    assert stages["language"].columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted(r.extra for r in got) == sorted([r.extra for r in documents(spark).collect() if r.extra not in (30, 31, 32)])
    assert {r.lang for r in got} == {"en"}


def test_shared_lines_go(stages):
    got = stages["line_dedup"].collect()
    assert len(got) == stages["language"].count() and not any("footer" in r.text.lower() for r in got)
    assert all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.extra == 35] == [""]


def test_one_document_of_each_group_stays(stages):
    kept = stages["near_dedup"].collect()
    # 33 repeats 3, 34 is 4 in capitals, row 5 comes twice, 35 has no words left and stays.
    assert Counter(r.extra for r in kept) == Counter([*range(30), 35])


def test_mix_takes_one_and_a_half_times_the_words(stages):
    before, mixed = stages["near_dedup"].collect(), stages["source_mix"].collect()
    words = sum(len(r.text.split()) for r in before)
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * words) <= 2
    texts = {r.extra: r.text for r in before}
    assert all(texts[r.extra].startswith(r.text) for r in mixed)
    assert max(Counter(r.extra for r in mixed).values()) <= 2


def test_tokens_decode_to_the_texts(stages):
    texts = Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in stages["source_mix"].collect())
    got = stages["byte_bpe"].collect()
    assert Counter(r.decoded_sha256 for r in got) == texts
    assert all(r.n_tokens == len(r.ids) for r in got)


#: Names that operators use inside, or for what they find.
INNER = ["_letter", "_digest", "_row", "target", "copies", "lang_pred", "score", "n_lines", "n_dropped", "size",
         "position", "_bucket", "_order", "Held_Out", "label", "_one", "c0"]


def test_columns_of_any_name_are_carried_along(spark):
    docs = documents(spark)
    for i, name in enumerate(INNER):
        docs = docs.withColumn(name, F.col("extra") * 100 + i)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""))
        rows = docs.collect()
        assert docs.columns[-len(INNER) :] == INNER and rows
        assert all(r[name] == r.extra * 100 + i for r in rows for i, name in enumerate(INNER))


def test_empty_table(spark):
    docs = documents(spark).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""))
        assert docs.count() == 0


def test_the_rest_stands_without_this_subpackage(tmp_path):
    for name in ("reviewlake", "catalog"):
        shutil.copytree(os.path.join(ROOT, name), tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    run = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n[:2] == 'op' or n == 'pipeline'])"
    found = subprocess.run([sys.executable, "-B", "-c", run], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert found.returncode == 0, found.stderr[-500:]
    assert int(found.stdout.split()[0]) > 90 and found.stdout.strip().endswith("[]")
