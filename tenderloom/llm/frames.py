"""Helpers for work on whole Arrow batches of documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.materialize import materialize


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame without the columns that an operator is about to write (names compare without case)."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def map_texts(df: DataFrame, column: str, fields: list[T.StructField],
              fn: Callable[..., list[pa.Array]], keep: bool = True, shared: tuple[Shared, ...] = ()) -> DataFrame:
    """Adds columns computed from a text column, one Arrow batch at a time and without a shuffle.

    Columns of the same names are replaced. ``fn`` gets the texts, and the shared objects if there are
    any, which each task loads once; it returns one array per field. With ``keep`` false the text
    itself is not returned.
    """
    names = [f.name for f in fields]
    source = "_text_in"
    rest = [c for c in df.columns if c.lower() not in {n.lower() for n in names}
            and (keep or c.lower() != column.lower())]
    frame = df.select(*[df[f"`{c}`"] for c in rest], df[f"`{column}`"].cast("string").alias(source))
    schema = T.StructType([f for f in frame.schema.fields if f.name != source] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = [s.value for s in shared]
        for batch in batches:
            at = batch.schema.get_field_index(source)
            made = fn(batch.column(at), *loaded)
            arrays = [batch.column(i) for i in range(batch.num_columns) if i != at] + made
            yield pa.RecordBatch.from_arrays(arrays, names=[*rest, *names])

    return frame.mapInArrow(run, schema)


stored = materialize


class Shared:
    """A broadcast object of this package. Broadcast values are pickled by reference to their classes,
    which workers need not have, so the object travels as bytes that bring its classes along."""

    def __init__(self, spark: SparkSession, value: object):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        return cloudpickle.loads(self._bytes.value)


def rows_of_texts(df: DataFrame, column: str, carry: list[str], fields: list[T.StructField],
                  fn: Callable[[pa.RecordBatch, pa.Array], Iterator[tuple[pa.Array, list[pa.Array]]]]) -> DataFrame:
    """Any number of rows per text. ``fn`` gets the batch and its texts, and yields the batch rows
    that its rows belong to, with one array per field; the columns in ``carry`` are repeated."""
    source = "_text_in"
    others = [c for c in df.columns if c != column]
    frame = df.select(*[df[f"`{c}`"] for c in others], df[f"`{column}`"].cast("string").alias(source))
    schema = T.StructType([frame.schema[c] for c in carry] + fields)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, made in fn(batch, batch.column(batch.schema.get_field_index(source))):
                arrays = [batch.column(batch.schema.get_field_index(c)).take(rows) for c in carry] + made
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return frame.mapInArrow(run, schema)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents with ``_key``, a hash of id and text that joins them, and ``_rank``, the id as a
    number by which documents are earlier or later (null ids come last)."""
    return without(docs, ["_key", "_rank"]).withColumns({
        "_key": F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")),
        "_rank": F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit((1 << 63) - 1)),
    })
