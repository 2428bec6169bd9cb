"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker holds as words at one time.
SLICE_BYTES = 4_000_000


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it stands there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with about ``SLICE_BYTES`` of text each (one row at
    least), and the texts as UTF-8; a null text is empty."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
    start = held = 0
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    for row, size in enumerate(sizes):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(start, row - start), texts(column.slice(start, row - start))
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start), texts(column.slice(start))


def texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.to_pylist()]


def per_text(
    df: DataFrame,
    make: Callable[[], Callable[[list[bytes]], list[pa.Array]]],
    text: str,
    keep: list[str],
    added: str,
) -> DataFrame:
    """Columns computed from each whole text, beside the ``keep`` columns.

    ``make`` is called once a task and gives the function from a slice of texts
    (UTF-8) to the ``added`` columns. No shuffle; memory is a slice, or one text
    where that is longer.
    """
    kept = df.select(*[F.col(f"`{c}`") for c in keep]).schema
    schema = df.sparkSession.createDataFrame([], added).schema
    names = [*keep, *schema.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part, contents in slices(batch, "__text"):
                columns = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, *compute(contents)], names=names)

    given = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    out = type(kept)([*kept.fields, *schema.fields])
    return given.mapInArrow(run, out)
