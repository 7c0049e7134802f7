"""The pipeline's stages one by one, and the registration of the queries."""

import corpus_pipeline
import __spark_entry__
from tests.conftest import SMALL
from threatloom.llm.queries import QUERIES


def test_registration():
    names = set(__spark_entry__.queries())
    assert {*QUERIES, "pipeline"} <= names and len(QUERIES) == 13


def test_stages_keep_clean_documents(spark, tmp_path):
    draw = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars > 300").limit(60)
    rows = [tuple(r) for r in draw.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    passage = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("item_id = 1").first().text
    rows += [(100_001, rows[0][1], "en", "s", 1), (100_002, "12 ?! 34", "en", "s", 8), (100_003, passage, "en", "s", 1), (100_004, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    ids = {r[0] for r in rows}
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        step(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids
        if i == 0:
            assert ids - left == {100_002, 100_004}
        elif i == 2:
            assert (100_001 in left) == (rows[0][0] not in left) or 100_001 not in left
        elif i == 3:
            assert 100_003 not in left
        if i < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        ids = left
    assert len(ids) > 40 and docs.where("n_tokens = 0").count() == 0
