"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilewright.session import shared_folder

# Characters that end a word: blank, tab, line feed, vertical tab, form feed, carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; without the setting, one in the
    session's warehouse, which must not be local to one machine unless all of Spark is."""
    return shared_folder(spark)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder, read it back, and drop the files when the session ends.

    Later steps then start from files instead of repeating what made them, and a
    lost executor costs no more than the tasks it was running.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def map_columns(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[..., Iterator[tuple]]],
    portion: int = 2_000_000,
) -> DataFrame:
    """Run a function over portions of ``df``, column lists in, rows out.

    ``make`` is called once per task and returns the function, so that what a task
    needs to load is loaded once. A portion has about so many bytes of text, or one row:
    only that much is held as Python values, whatever the size of a batch.
    """
    fields = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = make()
        for batch in batches:
            for part in batch_portions(batch, portion):
                rows = rows_of(*(column.to_pylist() for column in part.columns))
                columns = list(zip(*rows)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, fields)], schema=fields
                )

    return df.mapInArrow(run, schema)


def batch_portions(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text and binary values."""
    sizes = np.full(batch.num_rows, 16, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    until = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = until[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(until, before + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def portions(texts: list[str], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` characters, to bound what is held at once."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
