"""The registered queries of this subpackage and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import (
    bpe,
    centroids,
    chat,
    html_text,
    licences,
    mixing,
    periodic_runs,
    quality,
    rules,
    simhash,
    sql,
    token_counts,
    topk,
    warc,
)

CRAWL_DATE = "2024-01-01T00:00:00Z"
TOKEN_LIMIT = 512

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes from every document."""
    docs = _read(spark, folder, "documents")
    mixed = mixing.mix(docs, mixing.plan_mix(docs), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest rows to every hundredth vector."""
    return topk.top_k(_read(spark, folder, "embeddings"), k=10, every=100)


def op3_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and texts in every document."""
    found = licences.scan_licences(_read(spark, folder, "documents"), keep=["doc_id"])
    return found.drop("places", "spans")


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the token ids of every document and of the text that they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.encode_decode(_read(spark, folder, "documents"), path))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every formatted conversation, and of one whose texts hold control strings."""
    turns = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = F.inline(
        F.array(
            *(
                F.struct(
                    F.lit(-7).cast("bigint").alias("conv_id"),
                    F.lit(n).cast("bigint").alias("turn"),
                    F.lit(role).alias("role"),
                    F.lit(said).alias("text"),
                )
                for n, role in enumerate(("user", "assistant"))
            )
        )
    )
    template = chat.ChatTemplate()
    chats = chat.format_chats(turns.union(spark.range(1).select(more)), template)
    return chat.digests(chats, template)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = _read(spark, folder, "documents")
    model = quality.fit_quality(docs, _read(spark, folder, "labels"))
    scored = quality.score_quality(docs, model, keep=["doc_id"])
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = simhash.near_duplicates(_read(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract_text(_read(spark, folder, "pages"), keep=["page_id", "url"])
    n = F.char_length("text").cast("bigint")
    return found.select("page_id", "url", "text", n.alias("n_chars"), "covered")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata and conversion records of every page, taken as a response of a crawl."""
    responses = warc.page_responses(_read(spark, folder, "pages"), date=CRAWL_DATE)
    found = warc.derive_records(responses, keep=["page_id"])
    headers = F.array_join(
        F.transform(
            F.array_sort(F.map_entries("source_headers")),
            lambda e: F.concat(e["key"], F.lit(": "), e["value"]),
        ),
        "\n",
    )
    return found.withColumn("source_headers", headers).drop("error")


def op10_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict for every document."""
    docs = _read(spark, folder, "documents")
    model = rules.fit_rules(docs, _read(spark, folder, "labels"))
    return rules.apply_rules(docs, model, keep=["doc_id"]).drop("rule_score")


def _planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in a tenth of the documents the words repeat from some place on.

    Of n words those from a on become a repetition of the p words there, where a and p come from the id.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    chosen = docs.select(
        "doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.expr("crc32(string(doc_id)) div 10").alias("g")
    )
    n = F.nullif(F.size("words"), F.lit(0))
    placed = chosen.withColumn("n", n).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    period = 1 + F.expr("(n - a) div (3 + g % 8)").cast("int")
    rest = F.col("n") - F.col("a")
    placed = placed.withColumn("root", F.slice("words", F.col("a") + 1, period)).withColumn(
        "times", F.ceil(rest / F.size("root")).cast("int")
    )
    repeated = F.slice(F.flatten(F.array_repeat("root", F.col("times"))), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, the one with most periods, and digests of all and of what is left without them."""
    docs = _planted_periods(_read(spark, folder, "documents"))
    found = periodic_runs.detect_runs(docs, keep=["doc_id"])
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ends = F.transform(line, lambda x: F.concat(x, F.lit("\n")))
    none = F.lit(None).cast(found.schema["runs"].dataType.elementType)

    def longer(best, run):  # runs come by start and period, so ties stay with the first
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.reduce("runs", none, longer).alias("best"),
        F.sha2(F.array_join(ends, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and how many of its characters fit into the limit."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    docs = _read(spark, folder, "documents").select("doc_id", size, "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    fitting = {"fitting_chars": TOKEN_LIMIT}
    counted = token_counts.prefix_counts(docs, path, keep=["doc_id", "n_bytes"], budgets=fitting)
    n = token_counts.whole_count().cast("bigint")
    return counted.select(
        "doc_id",
        "n_bytes",
        n.alias("n_tokens"),
        (n > TOKEN_LIMIT).alias("over_limit"),
        "fitting_chars",
    )


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every vector after three rounds."""
    found = centroids.cluster(_read(spark, folder, "embeddings"), k=16, rounds=3, dims=64)
    return found.with_inertia().withColumn("centroid_sha256", found.centroid_digest())


_QUERIES = (
    op1_mix_sources,
    op2_top_k,
    op3_licences,
    op4_bpe,
    op5_chat,
    op6_quality,
    op7_simhash,
    op8_html,
    op9_warc,
    op10_rules,
    op11_periodic_runs,
    op12_token_counts,
    op13_centroids,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": sql.MIX,
        "op2_top_k": sql.TOP_K,
        "op5_chat": sql.CHAT,
        "op13_centroids": sql.CENTROIDS,
    }
