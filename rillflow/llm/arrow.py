"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def struct_of(schema: str) -> StructType:
    """A schema from its DDL text."""
    return _parse_datatype_string(schema)


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def map_batches(df: DataFrame, work, schema: str) -> DataFrame:
    """``work`` turns one Arrow batch into columns by name, or yields several such."""
    target = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in work(batch):
                    arrays = [pa.array(columns[f.name], f.type) for f in target]
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)
