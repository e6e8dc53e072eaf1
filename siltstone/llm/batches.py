"""Running vectorised text functions over the partitions of a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def map_texts(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """mapInArrow with a function from a batch to named columns.

    Only the columns of df travel to Python, in Arrow batches; whole texts do.
    An empty partition gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = function(batch)
                yield pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(column).to_pylist()
