"""Python callbacks over bounded chunks of a large table."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import Accumulator
from pyspark.sql import DataFrame

from tallywork.fixed_values import CHUNK_SIZE


def process_in_chunks(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame | None],
    schema: str,
    *,
    chunk_size: int = CHUNK_SIZE,
    counter: Accumulator | None = None,
) -> DataFrame:
    """Call ``fn`` on chunks of at most ``chunk_size`` rows and return the rows it yields.

    Partitions run in parallel, so chunk borders and the order of results are not fixed; a chunk
    never spans partitions. ``fn`` may return None for no result. ``counter`` adds up the rows that
    have been processed; tasks that run again count again.
    """

    # nested so that workers get both functions by value, without this package installed
    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        held = 0
        for batch in batches:
            start = 0
            while len(batch) - start >= chunk_size - held:
                stop = start + chunk_size - held
                yield pd.concat([*waiting, batch.iloc[start:stop]], ignore_index=True)
                waiting, held, start = [], 0, stop
            if start < len(batch):
                waiting.append(batch.iloc[start:])
                held += len(batch) - start
        if held:
            yield pd.concat(waiting, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks(batches):
            result = fn(chunk)
            if counter is not None:
                counter.add(len(chunk))
            if result is not None:
                yield result

    if chunk_size < 1:
        raise ValueError("chunk_size must be positive")
    return df.mapInPandas(run, schema)
