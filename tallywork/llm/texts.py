"""Helpers that several operators of this subpackage share."""

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


_MOST_BYTES = 32_000_000
_HOME = Path(__file__).resolve().parents[2]


def map_in_arrow(df: DataFrame, function: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with a function that uses this library.

    Workers on machines that share the driver's folders find the library where the driver has it, in
    whatever folder the application was started; other clusters get it with ``--py-files``.
    """
    environment = df.sparkSession.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _HOME.is_dir() and str(_HOME) not in known:
        environment["PYTHONPATH"] = os.pathsep.join([str(_HOME), *known])
    return df.mapInArrow(function, schema)


def pieces(texts: pa.Array, largest: int) -> Iterator[tuple[int, int]]:
    """Start and length of runs of texts that are few and short enough together."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start, before = 0, 0
    while start < len(texts):
        fitting = int(np.searchsorted(ends, before + _MOST_BYTES, side="right"))
        n = max(1, min(largest, fitting - start))
        yield start, n
        start += n
        before = int(ends[start - 1])


def arrow_rows(
    df: DataFrame,
    keep: list[str],
    text: str,
    make: Callable[[list[bytes]], list[pa.Array]],
    added: str,
    largest: int = 512,
) -> DataFrame:
    """Add columns computed from a text column, in one pass and without a shuffle.

    Keeps the columns ``keep`` of ``df`` and adds those that the DDL string ``added`` names. ``make``
    gets the UTF-8 bytes of some texts (NULL as an empty text) and returns one array per added
    column. It is called with at most ``largest`` texts, and 32 MB of text or one longer text, which
    bounds the memory of a worker. A name in ``keep`` that is also added is an error.
    """
    new = StructType.fromDDL(added)
    clashing = sorted(set(keep) & set(new.names))
    if clashing:
        raise ValueError(f"keep holds names of added columns: {clashing}")
    schema = StructType([df.schema[name] for name in keep])
    for field in new.fields:
        schema = schema.add(field)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in pieces(batch.column(len(keep)), largest):
                part = batch.slice(start, n)
                texts = part.column(len(keep)).cast(pa.binary()).to_pylist()
                columns = make([t or b"" for t in texts])
                kept = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=names)

    rows = df.select(*(df[name] for name in keep), df[text].alias("_text"))
    return map_in_arrow(rows, run, schema)
