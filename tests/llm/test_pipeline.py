"""The corpus pipeline on planted cases, stage by stage and as a whole, and the entry point with and without it."""

import subprocess
import sys
import tempfile
import zlib
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def tables(spark, prose):
    folder = tempfile.mkdtemp(prefix="indicarium-pipeline-")
    docs, labels = [], []
    for i in range(400):
        bad = i % 8 == 0
        docs.append((i, prose(1000 + i, 80, 3) + (" vileworm grimtoad" if bad else "")))
        if i % 5 < 3:
            labels.append((i, int(bad)))
    question = prose(7, 40, 1)
    docs += [(500, prose(2001, 90) + " " + question), (501, None), (502, ""), (503, prose(1001, 80, 3)), (503, prose(1001, 80, 3))]
    near = prose(2002, 600, 6).split(" ")
    docs += [(510 + i, " ".join(near[: 90 * i] + ["stone"] + near[90 * i + 1 :])) for i in range(5)]
    docs += [(530 + i, prose(3000 + i, 60, 2) + f"\nentry {i} of 300 printed on page {i} by the office") for i in range(12)]
    rows = [(i, t, "en", None, None if t is None else len(t), "x") for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, fp string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs


def test_stages(spark, tables):
    folder, docs = tables
    source = now = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = f"{tempfile.mkdtemp(prefix='indicarium-stage-')}/out"
        stage(spark, now, folder).write.parquet(out)
        now = spark.read.parquet(out)
        assert now.columns == source.columns
        seen[name] = {r.doc_id: r.text for r in now.collect()}
    toxic = {i for i, _ in docs if i < 400 and i % 8 == 0}
    assert len(toxic - set(seen["toxicity"])) >= 0.9 * len(toxic)
    clean = {i for i, _ in docs} - toxic
    assert len(clean - set(seen["toxicity"])) <= 0.02 * len(clean)
    assert set(seen["line_dedup"]) == set(seen["toxicity"])
    assert sum("printed on page" in (seen["line_dedup"][530 + i] or "") for i in range(12) if 530 + i in seen["line_dedup"]) == 1
    kept = set(seen["simhash_near_dedup"])
    assert {i for i in kept if 510 <= i < 515} == {510}
    assert 503 not in kept and 1 in kept, seen["line_dedup"].get(1) == seen["line_dedup"].get(503)
    empty = {i for i, t in seen["line_dedup"].items() if not (t or "").strip()}
    assert len(empty & kept) == 1, (empty, empty & kept)
    assert set(seen["simhash_near_dedup"]) - set(seen["benchmark_decontamination"]) == {500}


def test_run_equals_its_stages(spark, tables):
    from tokenizers import Tokenizer

    folder, _ = tables
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = f"{tempfile.mkdtemp(prefix='indicarium-stage-')}/out"
        stage(spark, now, folder).write.parquet(out)
        now = spark.read.parquet(out)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in now.collect():
        ids = np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want += [(r.doc_id, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for a in range(0, len(ids), 4096)]
    got = [(r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(want)


def test_empty_tables(spark, tables):
    folder = tempfile.mkdtemp(prefix="indicarium-empty-")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables[0]}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_entry_without_the_subpackage():
    """The entry point imports and keeps the other queries when the folders are gone."""
    code = ("import sys; sys.path.insert(0, '.')\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith(('indicarium.llm', 'corpus_pipeline')): raise ModuleNotFoundError(name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) > 70 and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n")
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0
