import os

import pytest

import corpus_pipeline
from tallyloom.llm.queries import queries, table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
    kept = docs.count()
    assert 0 < kept < before
    assert docs.where("n_chars <> char_length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == kept


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries())
    assert numbers == list(range(1, 14))


def test_stages_on_an_empty_table(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
