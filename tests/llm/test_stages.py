"""Every pipeline stage on odd rows, on an empty table and on tables with more columns."""

import corpus_pipeline
import pytest
from llm import edge
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels of the quality tests, some with NULLs, and documents to learn from."""
    place = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, i % 2, 0) for i in range(10, 200)] + [(None, 1, 0), (1, None, None), (2, 1, 0), (2, 0, 0)]
    spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    _documents(spark).write.parquet(f"{place}/documents.parquet")
    return place


def _documents(spark):
    odd = edge.documents(spark).select(*corpus_pipeline.COLUMNS, "size", "_text", "kept", "score")
    good = "The quick brown fox walks over the lazy dog and sees the wide river"
    bad = "BUY## NOW!!! $$$ | CLICK && HERE ###"
    more = spark.range(10, 200).select(
        F.col("id").alias("doc_id"),
        F.concat(
            F.when(F.col("id") % 2 == 1, good).otherwise(bad),
            F.concat(F.lit(" "), F.sha2(F.col("id").cast("string"), 256)),
            F.when(F.col("id") % 2 == 1, ", and so on it goes for one more line here.").otherwise(bad),
        ).alias("text"),
        F.lit("en").alias("lang"),
        (F.col("id") % 3).cast("string").alias("source"),
        F.lit(None).cast("bigint").alias("n_chars"),
    )
    return odd.unionByName(more, allowMissingColumns=True)


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stage(spark, folder, place):
    _, stage = corpus_pipeline.STAGES[place]
    docs = _documents(spark)
    found = stage(spark, docs, folder)
    rows = found.collect()
    last = place == len(corpus_pipeline.STAGES) - 1
    if last:
        assert len(rows) == docs.count()
    else:
        assert found.columns == corpus_pipeline.COLUMNS
        given = {str(tuple(r)) for r in docs.select(*corpus_pipeline.COLUMNS).collect()}
        assert {str(tuple(r)) for r in rows} <= given
        assert rows
    assert stage(spark, docs.filter("false"), folder).collect() == []


def test_near_duplicates_keep_one_of_repeated_rows(spark, folder):
    docs = _documents(spark)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect()
    ids = [r.doc_id for r in kept]
    assert ids.count(6) == 1 and ids.count(None) == 1
    assert {2, 3, 4} & set(ids) == {2}  # texts without words are one group


def test_near_duplicates_without_ids_and_under_one_id(spark, folder):
    docs = _documents(spark).select(*corpus_pipeline.COLUMNS)
    more = [(6, "other words under an id that is taken already", "en", "a", 1)]
    more += [(None, "No id here, but words all the same and more of them.", "en", "b", 3)] * 2
    more += [(None, more[0][1], "en", "a", 1), (None, None, None, None, None)]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect()
    found = [(r.doc_id, r.text) for r in kept]
    assert sorted(t for k, t in found if k == 6) == sorted([edge.ROWS[6][1], more[0][1]])
    assert [t for k, t in found if k is None] == [more[1][1]]
    assert len([k for k, t in found if not (t or "").strip()]) == 1


def test_filters_drop_the_bad_and_keep_the_good(spark, folder):
    docs = _documents(spark).filter("doc_id >= 10")
    for stage in (corpus_pipeline.filter_quality, corpus_pipeline.filter_rules):
        kept = {r.doc_id for r in stage(spark, docs, folder).collect()}
        assert kept == set(range(11, 200, 2))


def test_mix_repeats_rows(spark, folder):
    docs = _documents(spark).filter("doc_id >= 10")
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    counts = [r["count"] for r in mixed.groupBy("doc_id").count().collect()]
    assert max(counts) == 2 and mixed.count() > docs.count()
