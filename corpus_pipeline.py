"""A pipeline over ``documents``: filter, deduplicate, mix and encode.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; it is written as
Parquet, and what is read back is the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import bpe, mixing, quality, rules, simhash
from tallywork.plans import adapt_to_skew, durable

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects.

    NULL and empty texts are scored like any other; repeated rows and rows without an id are judged
    one by one. An empty table gives an empty result.
    """
    model = quality.fit_quality(docs, _labels(spark, sf_dir))
    scored = quality.score_quality(docs, model, keep=COLUMNS)
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def filter_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the trees reject.

    The trees learn from the original documents, as the stage before leaves hardly any of label 0.
    """
    model = rules.fit_rules(_originals(spark, sf_dir), _labels(spark, sf_dir))
    return rules.apply_rules(docs, model, keep=COLUMNS).filter("kept").select(*COLUMNS)


def _identity() -> Column:
    """Tells rows apart that differ in any column; those without an id come last."""
    others = F.xxhash64(*(c for c in COLUMNS if c not in ("doc_id", "text")))
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.col("text").isNull().alias("no_text"),
        digest.alias("digest"),
        others.alias("others"),
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash near-duplicates.

    The one with the smallest id, then text digest; rows without an id come last in their group, and
    rows of one id with other texts are told apart. Of repeated rows one stays. NULL, empty and blank
    texts form one group. An empty table gives an empty result.
    """
    adapt_to_skew(spark)
    rows = docs.select(*COLUMNS).withColumn("_row", _identity())
    found = simhash.near_duplicates(rows, key="_row")
    first = found.filter(F.col("_row") == F.col("component_id"))
    counts = durable(first.groupBy("_row").agg(F.count(F.lit(1)).alias("_rows")), "kept")
    # the kept rows grow with the corpus: never a broadcast, the same join at every size
    kept = rows.join(counts.hint("merge"), "_row")
    result = kept.filter("_rows = 1").select(*COLUMNS)
    if not counts.filter("_rows > 1").isEmpty():
        repeated = kept.filter("_rows > 1").dropDuplicates(["_row"])
        result = result.union(repeated.select(*COLUMNS))
    return result


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that every source comes to its target.

    Rows without a source are a source of their own; repeated rows are taken one by one. An empty table
    gives an empty result.
    """
    return mixing.repeat_rows(docs.select(*COLUMNS), mixing.plan_mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every row.

    NULL and empty texts have no ids; an empty table gives an empty result.
    """
    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", filter_quality),
    ("quality rules", filter_rules),
    ("near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder."""
    docs = _originals(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# the classifier, the trees and the fingerprints are beyond SQL; the tests hold it against brute force
ORACLE_SQL = None
