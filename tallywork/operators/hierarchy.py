"""Hierarchies given as rows that name their parent."""

import math
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.fixed_values import INDENT, MAX_DEPTH, PATH_SEPARATOR
from tallywork.plans import remove, stored


def traverse_hierarchy(
    df: DataFrame,
    *,
    id: str = "emp_id",
    parent: str = "manager_id",
    name: str = "name",
    max_depth: int | None = MAX_DEPTH,
) -> DataFrame:
    """Depth and path from the root for every row reachable from a root.

    Roots have no parent. Rows on a cycle, below a missing parent or deeper than ``max_depth`` (None:
    any depth) have no result. Instead of walking down level by level, every row follows its chain of parents
    upwards and each round doubles the length of all chains: four joins reach sixteen levels.
    """
    step = F.struct(F.col(id).alias("id"), F.col(name).alias("name"))
    chains = df.select(
        F.col(id).alias("_id"), F.array(step).alias("_chain"), F.col(parent).alias("_next")
    )
    before = None
    rounds = count() if max_depth is None else range(math.ceil(math.log2(max_depth)))
    for _ in rounds:
        chains = _doubled(chains)
        if max_depth is None:  # a chain that comes back to itself never ends
            again = F.exists("_chain", lambda s: s["id"] == F.col("_next"))
            chains = chains.filter(F.col("_next").isNull() | ~again)
        chains, folder = stored(chains, "chains")
        if before:
            remove(df.sparkSession, before)
        before = folder
        if chains.filter(F.col("_next").isNotNull()).isEmpty():
            break
    deep_enough = F.lit(True) if max_depth is None else F.size("_chain") <= max_depth
    found = chains.filter(F.col("_next").isNull() & deep_enough)
    path = F.reverse("_chain")
    depth = F.size("_chain")
    own_name = F.element_at("_chain", 1)["name"]
    names = F.transform(path, lambda s: s["name"])
    named = ~F.exists(names, lambda n: n.isNull())  # a missing name leaves no path
    return found.select(
        F.col("_id").alias(id),
        F.concat(F.repeat(F.lit(INDENT), depth - 1), own_name).alias("indented_name"),
        depth.alias("depth"),
        F.when(named, F.concat_ws(PATH_SEPARATOR, names)).alias("full_path"),
        F.transform(path, lambda s: s["id"]).alias("path"),
    )


def _doubled(chains: DataFrame) -> DataFrame:
    """Append to every open chain the chain of the row it stopped at."""
    unfinished = F.col("_next").isNotNull()
    open_chains = chains.filter(unfinished)
    above = chains.select(
        F.col("_id").alias("_next"), F.col("_chain").alias("_rest"), F.col("_next").alias("_top")
    )
    # one row above for each chain; Spark splits the partition of a parent with very many children
    longer = open_chains.join(above, "_next").select(
        "_id", F.concat("_chain", "_rest").alias("_chain"), F.col("_top").alias("_next")
    )
    return chains.filter(~unfinished).unionByName(longer)
