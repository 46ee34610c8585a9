"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from listloom import shipping
from listloom.storage import shared_folder, stored

#: Rows whose Python objects exist at one time in a worker; texts may be long.
ROWS_AT_ONCE = 256
#: UTF-8 bytes of text that a worker handles at one time, unless one text alone is longer.
BYTES_AT_ONCE = 4 << 20

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

__all__ = ["default_parallelism", "map_texts", "pieces", "shared_folder", "ship", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors, and keep their Arrow batches small: rows hold whole texts here."""
    if spark.conf.get(ARROW_ROWS) == "10000":  # Spark's default
        spark.conf.set(ARROW_ROWS, "1000")
    shipping.ship(spark)


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of batch with at most ROWS_AT_ONCE rows and, unless of one row, BYTES_AT_ONCE bytes in column text."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= ROWS_AT_ONCE or total + size > BYTES_AT_ONCE):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(df: DataFrame, text: str, keep: list[str], added: str, rows: Callable[[], Callable[[list], list[tuple]]]) -> DataFrame:
    """Columns keep of df plus the columns of the DDL string added, computed from whole texts in Arrow batches.

    rows() is called once a task and gives a function from a list of texts (None for null) to a list of tuples. One row
    out for each row in, without a shuffle. Names may clash: kept columns travel by position.
    """
    ship(df.sparkSession)
    kept = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("t"))
    new = StructType.fromDDL(added)
    n = len(keep)
    schema = StructType([StructField(f.name, f.dataType, True) for f in kept.schema.fields[:n]] + [StructField(f"a{i}", f.dataType, True) for i, f in enumerate(new.fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        do = rows()
        for batch in batches:
            for part in pieces(batch, "t"):
                out = do(part.column("t").to_pylist())
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).cast(arrow.field(i).type) for i in range(n)] + [pa.array(c, arrow.field(n + i).type) for i, c in enumerate(columns)],
                    schema=arrow,
                )

    out = kept.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"a{i}").alias(f.name) for i, f in enumerate(new.fields)])


def default_parallelism(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: what a keyed repartition gets."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

