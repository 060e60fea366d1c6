import os

import corpus_pipeline
import pytest

from yieldlens.llm import bpe, packing  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near duplicates", "substrings", "packing"]


def test_each_stage_hands_on_documents(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if name == "packing":
            assert made.agg({"length": "sum"}).first()[0] > 0
            break
        made = corpus_pipeline.stored(made)
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        assert made.where("n_chars <> length(text)").count() == 0
        assert 0.9 * docs.count() <= made.count() <= docs.count()
        docs = made


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, "123 ...", "en", "s", 7), (None, "the and of", "en", "s", 10),
        (5, "the and of", "en", "s", 10), (5, "the and of", "en", "s", 10), (6, "der und die", None, "s", 11), (7, "der die das", "de", "s", 11),
    ]
    docs = spark.createDataFrame(rows, TABLE)
    named = dict(corpus_pipeline.STAGES)
    kept = named["language"](spark, docs, "")
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "5", "6", "7", "None"]
    assert kept.where("lang IS NULL").count() == 0
    assert sorted(str(r["doc_id"]) for r in named["near duplicates"](spark, docs, "").collect()) == ["1", "2", "3", "5", "6", "7", "None"]
    assert named["lines"](spark, docs, "").count() == len(rows)
    assert named["substrings"](spark, docs, "").count() == len(rows)


def test_rows_of_one_id_keep_their_texts(spark):
    rows = [(5, "one text of its own", "en", "s", 19), (5, "quite another one", "en", "s", 17), (5, "quite another one", "en", "s", 17)]
    found = dict(corpus_pipeline.STAGES)["near duplicates"](spark, spark.createDataFrame(rows, TABLE), "")
    assert sorted(r["text"] for r in found.collect()) == ["one text of its own", "quite another one"]


def test_empty_documents(spark):
    docs = spark.createDataFrame([], TABLE)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, "")
        assert made.count() == 0
