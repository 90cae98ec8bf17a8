"""Small helpers shared by the operators: columns added in Arrow batches, names that do not clash, written tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ratelens.session import release, work_dir  # noqa: F401 (release is for the operators)

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 1000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BYTES = 4 << 20


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores before it where the table has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_batches(spark: SparkSession) -> None:
    """Hand texts and sets to Python in batches that take little memory beside the executor's heap, unless they are smaller already."""
    if int(spark.conf.get(BATCH_ROWS)) > MOST_ROWS:
        spark.conf.set(BATCH_ROWS, str(MOST_ROWS))
    held = spark.conf.get(BATCH_BYTES).removesuffix("b")
    if held.isdigit() and int(held) > MOST_BYTES:  # a setting with another unit is the user's own
        spark.conf.set(BATCH_BYTES, str(MOST_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives the loss of executors."""
    small_batches(df.sparkSession)
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_arrow_columns(
    df: DataFrame,
    inputs: list[str],
    added: T.StructType,
    compute: Callable[[], Callable[..., list[pa.Array]]],
    *,
    rows: int = 500,
) -> DataFrame:
    """All columns of ``df`` and the ``added`` ones, computed from the ``inputs`` over slices of at most ``rows`` rows.

    ``compute()`` runs once per task and returns the function of a slice. A column of ``df`` with the name
    of an added one (in either case) is replaced.
    """
    small_batches(df.sparkSession)
    names = {f.name.lower() for f in added.fields}
    kept = [c for c in df.columns if c.lower() not in names]
    columns = kept + [c for c in inputs if c not in kept]
    source = df.select(*[f"`{c}`" for c in columns])
    schema = T.StructType([df.schema[c] for c in kept] + list(added.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = compute()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                new = work(*[part.column(columns.index(c)) for c in inputs])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(kept))] + new, names=kept + [f.name for f in added.fields]
                )

    return source.mapInArrow(lean(run), schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def give_back() -> None:
    """Return memory that this worker has freed to the system, where the C library can (a worker lives on between tasks)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, which gives its memory back when it ends."""

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean_run
