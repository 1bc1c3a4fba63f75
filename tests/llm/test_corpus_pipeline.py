import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from llm_fixtures import edges, empty  # noqa: F401
from test_near_and_substring import brute

ROOT = Path(__file__).resolve().parents[2]


def test_stages_follow_each_other(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = docs.collect()
    texts = ["".join(r.text.translate(dict.fromkeys([0x20, *range(9, 14)]))) for r in kept["exact_dedup"]]
    assert len(set(texts)) == len(texts)
    assert {r.doc_id for r in kept["quality"]} >= {r.doc_id for r in kept["exact_dedup"]}
    groups = brute([(r.doc_id, r.text) for r in kept["exact_dedup"]], corpus_pipeline.near_dedup.Near())
    assert {r.doc_id for r in kept["near_dedup"]} == set(groups.values())
    assert {r.doc_id for r in kept["mixing"]} <= set(groups.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert sum(r.start == 0 for r in pieces) == len(kept["mixing"])


@pytest.mark.parametrize("folder", ["edges", "empty"])
def test_stages_take_odd_documents(spark, small, folder, request):
    docs = request.getfixturevalue(folder)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert set(corpus_pipeline_columns) <= set(docs.columns)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() >= 0


corpus_pipeline_columns = ["doc_id", "text", "lang", "source", "n_chars"]


def test_entry_without_the_subpackage(tmp_path):
    """With the subpackage and the pipeline taken out, the entry still offers the other queries."""
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("quarterline.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
assert "d1_keep_latest" in e.queries() and "pipeline" not in e.queries() and not any(k.startswith("op") for k in e.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
