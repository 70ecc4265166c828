import json
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from llm_fixtures import documents, prose  # noqa: F401
from varloom.llm import queries as q

SMALL = "/root/testdata/sf0.001"
#: Queries that SQL cannot express: learned models, packing, search and propagation; compared with brute force in these tests.
WITHOUT_SQL = {"op3_language_id", "op4_quality_classifier", "op5_best_fit_packing", "op8_nearest_neighbours", "op9_sharding", "op11_personal_data", "op12_embedding_whitening"}


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in q.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(q.QUERIES) - set(q.ORACLE) == WITHOUT_SQL and set(q.ORACLE) <= set(q.QUERIES)


def test_native_main_paths_have_no_python(spark):
    for name in ("op1_line_dedup", "op7_secret_scans", "op9_sharding", "op10_chat_formatting"):
        plan = q.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin")), name


def test_pipeline_stages_keep_the_columns_and_take_effect(spark, documents, prose):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    left = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = docs.count()
        assert 0.7 * left < now <= left
        left = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == left


def test_stages_take_odd_rows(spark, documents):
    docs = documents([(1, None), (1, None), (None, "some text here"), (2, ""), (3, "word"), (3, "word")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for some in (docs, docs.limit(0)):
            got = stage(spark, some, SMALL)
            assert got.columns == docs.columns and got.count() <= some.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 6


def test_rest_imports_without_this_part():
    root = str(Path(corpus_pipeline.__file__).parent)
    code = """
import json, sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "varloom.llm"):
            raise ModuleNotFoundError(name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(json.dumps(sorted(e.queries())))
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    names = json.loads(out.splitlines()[-1])
    assert len(names) > 80 and not any(n.startswith("op") or n == "pipeline" for n in names)
