import pytest

import corpus_pipeline
from obslake.llm import queries
from obslake.llm.common import staged
from obslake.llm.neardup import near_classes

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, DATA), name)
        tables.append(docs)
    return tables


def test_stages_filter_and_pack(stages):
    documents, good, known, unique, packed = stages
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language_id", "near_dedup", "packing"]
    for table in (good, known, unique):
        assert table.columns == documents.columns and table.dtypes == documents.dtypes
    for before, after in zip(stages[:3], stages[1:4], strict=True):
        assert after.exceptAll(before).count() == 0
    classes = near_classes(known).toPandas()
    assert sorted(r["doc_id"] for r in unique.select("doc_id").collect()) == sorted(classes.class_id.unique())
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(classes.class_id)


def test_clean_documents_stay(stages, spark):
    documents, good, known = stages[:3]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    fine = labels.where("quality = 1").join(documents, "doc_id")
    assert fine.join(known, "doc_id", "left_semi").count() >= 0.97 * fine.count()
    junk = labels.where("quality = 0").join(documents, "doc_id")
    assert junk.join(good, "doc_id", "left_anti").count() >= 0.8 * junk.count()


def test_run_equals_the_stages(stages, spark):
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, DATA).select(*pieces).collect())) == sorted(map(tuple, stages[-1].select(*pieces).collect()))


def test_extra_columns_and_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("*", "'x' AS class", "1 AS id", "0 AS score").limit(60)
    for table in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = staged(stage(spark, table, DATA), "odd")
            assert table.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, table, DATA).count()


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)
