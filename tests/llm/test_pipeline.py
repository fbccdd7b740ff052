import shutil

import pytest

import __spark_entry__
import corpus_pipeline
from martloom.llm import queries
from tests.llm.common import odd_documents

SF = "/root/testdata/sf0.001"


@pytest.fixture
def odd_folder(spark, tmp_path):
    odd_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    return str(tmp_path)


def test_stages_keep_the_columns(spark, odd_folder):
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, odd_folder)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}, name
    assert corpus_pipeline.run(spark, odd_folder).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_pipeline_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_classifier(spark, docs, SF)
    kept = corpus_pipeline.simhash_near_dedup(spark, kept, SF)
    kept = {r.doc_id for r in corpus_pipeline.benchmark_decontamination(spark, kept, SF).collect()}
    assert kept and {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == kept


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
