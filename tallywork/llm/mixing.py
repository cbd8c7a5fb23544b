"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the wanted words by its weight, but at most ``epochs`` times its own
size. What the capped sources can't take goes to the others by weight, until no source is above its
cap. A source whose target is, say, 1.4 times its size is taken once in whole, and for the other 0.4
its documents are taken in the order of a seeded hash until the words come nearest to the target.

Nothing is sorted or gathered: the cut in the hash order is found with histograms. Sums per source
and leading bits of the hash locate the one bin that holds the cut, sums over the next bits locate it
inside the bin, and only what is left there, a 16 millionth of a source, is put in order.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.plans import durable, join_null_safe, row_numbers

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 17
_HEX_DIGITS = 15  # 60 bits of the hash, a positive bigint
_BIN_BITS = 12
_REST_BITS = 4 * _HEX_DIGITS - 2 * _BIN_BITS


def n_words(text: str) -> Column:
    """Number of words in a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded_place(key: str, seed: int) -> Column:
    """Place of a document in the seeded order, from 0 to 2**60 - 1."""
    named = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def _level(sources: DataFrame, share: float, epochs: float) -> float:
    """Words per unit of weight that sources below their cap get.

    Raises the level until it no longer changes. Each round is one small aggregate over the sources;
    the sources below their cap get fewer with every round.
    """
    cap, weight = F.col("source_size") * epochs, F.col("weight")
    level = 0.0
    while True:
        full = cap <= weight * level
        got = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~full, weight)), F.lit(0.0)).alias("open"),
        ).first()
        if not got["open"]:
            return level
        higher = (share * got["total"] - got["full"]) / got["open"]
        if higher <= level:
            return level
        level = higher


def _undecided(rows: DataFrame, cuts: DataFrame, shift: int, name: str) -> DataFrame:
    """One step towards the cut: the bin of each source that holds it.

    ``rows`` are (no, place, size) inside the bins found before; ``cuts`` has ``need``, the words still
    to take from them. Bins before the cut's bin are taken in whole.
    """
    part = F.shiftright("place", shift).alias(name)
    bins = rows.groupBy("no", part).agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("no").orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0)))
    holds = (F.col("before") <= F.col("need")) & (F.col("need") < F.col("before") + F.col("words"))
    found = bins.join(cuts, "no").filter(holds)
    return found.select("no", name, (F.col("need") - F.col("before")).alias("need"))


def plan_mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``whole`` and ``last_place``.

    Sources in code point order, NULL last, get the weights in turn. Of a source, every document is
    taken ``whole`` times, and those up to ``last_place`` in the seeded order once more.
    """
    sizes = durable(
        docs.select(
            F.col(source).alias("source"),
            seeded_place(key, seed).alias("place"),
            n_words(text).alias("size"),
        ),
        "sizes",
    )
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = row_numbers(totals, [], [F.col("source").asc_nulls_last()], "no")
    turn = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.pmod(F.col("no") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    sources = durable(numbered.withColumn("weight", turn), "sources")
    cap, wanted = F.col("source_size") * float(epochs), F.col("weight") * _level(sources, share, epochs)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    sources = sources.withColumn("target", F.least(cap, wanted)).withColumn("whole", whole)
    need = F.col("target") - F.col("whole") * F.col("source_size")
    cuts = sources.select("no", need.alias("need"))

    rows = join_null_safe(sizes, sources.select("source", "no"), ["source"]).drop("source")
    first = _undecided(rows, cuts, _REST_BITS + _BIN_BITS, "first")
    rows = rows.join(first.select("no", "first"), "no")
    rows = rows.filter(F.shiftright("place", _REST_BITS + _BIN_BITS) == F.col("first"))
    second = durable(_undecided(rows, first, _REST_BITS, "second"), "cuts")
    rows = rows.join(second, "no").filter(F.shiftright("place", _REST_BITS) == F.col("second"))
    # documents at one place are taken together; a place is taken if that comes nearer to the target
    places = rows.groupBy("no", "second", "need", "place").agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("no").orderBy("place")
    before = F.sum("words").over(in_order) - F.col("words")
    taken = F.when(2 * before + F.col("words") <= 2 * F.col("need"), F.col("place"))
    start = F.shiftleft("second", _REST_BITS)
    last = (
        places.withColumn("taken", taken)
        .groupBy("no", "second")
        .agg(F.max("taken").alias("taken"))
        .select("no", F.coalesce("taken", start - 1).alias("last_place"))
    )
    # without a cut, or with all of the target in whole repetitions, nothing more is taken
    more = F.when(need > 0, F.coalesce("last_place", F.lit(-1))).otherwise(F.lit(-1))
    found = sources.join(last, "no", "left").withColumn("last_place", more)
    return durable(found.select("source", "source_size", "target", "whole", "last_place"), "mix")


def mix(
    docs: DataFrame,
    plan: DataFrame,
    *,
    keep: list[str],
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """Columns ``keep`` with ``size``, ``source_size``, ``target``, ``times`` and ``taken`` (words).

    One row per row of ``docs``, also for documents that the mix takes zero times. Rows with one key
    (repeated rows, NULL keys) share a place and are taken alike. NULL and empty texts have size 0
    and take nothing; a source of such texts has target 0. An empty table gives an empty result.
    Columns of ``docs`` may be named like the added ones as long as they are not in ``keep``.
    """
    rows = docs.select(
        F.struct(*keep).alias("_kept"),
        F.col(source).alias("source"),
        seeded_place(key, seed).alias("_place"),
        n_words(text).alias("size"),
    )
    again = (F.col("_place") <= F.col("last_place")).cast("bigint")
    joined = join_null_safe(rows, plan, ["source"]).withColumn("times", F.col("whole") + again)
    return joined.select(
        "_kept.*",
        "size",
        "source_size",
        "target",
        "times",
        (F.col("times") * F.col("size")).alias("taken"),
    )


def repeat_rows(docs: DataFrame, plan: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as ``mix`` takes it, with its columns.

    A document without words is in the mix as often as its source's plan says, like any other.
    """
    taken = mix(docs.withColumn("_row", F.struct(*docs.columns)), plan, keep=["_row"], **options)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))
    return taken.select("_row", copies.alias("_copy")).select("_row.*")
