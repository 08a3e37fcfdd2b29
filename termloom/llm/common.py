"""What the operators of this subpackage share.

Texts reach Python workers as UTF-8 bytes: ``bytes.split()`` cuts at exactly
space and 0x09-0x0D, and ``bytes.lower()`` changes A-Z only. A null text is an
empty text. Operators read the named columns only, so extra columns with any
name never clash with the columns they make.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that a worker turns into Python objects at once.
SLICE_ROWS = 96


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: str) -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """Run ``make()`` once per task and its result on each slice of rows.

    The function gets ``{column: list}`` and returns ``{column: list or array}``
    for ``schema``; it may return any number of rows.
    """
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                made = work(batch.slice(start, SLICE_ROWS).to_pydict())
                columns = [pa.array(made[field.name], type=field.type) for field in arrow]
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def crc_share(id_column: str, buckets: int) -> Column:
    """crc32 of the id's text modulo ``buckets``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(buckets)).cast("int")


class Memo(dict):
    """A dictionary that fills itself from ``make`` and starts anew when it is full."""

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


@contextmanager
def growing():
    """Filling a large memo: it holds no cycles, so looking for some again and again is time lost."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
