"""What the operators share: reading tables, stored intermediates, Arrow helpers, worker caches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.session import shared_folder
from tablewright.session import ship_package as ship  # noqa: F401  (the operators take it from here)

# Text handled at a time inside a worker; bounds the Python objects alive, not the results.
PIECE_BYTES = 1 << 20
# Bytes of an Arrow batch that Spark sends to a worker: texts are of any length, so that rows bound nothing.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
# Bytes of a row group of stored tables: a writer holds one in memory.
ROW_GROUP = 16 << 20
# Entries of one generation of a worker's cache; two generations are alive at most.
CACHE_ENTRIES = 100_000

_models: dict[tuple[str, bytes], Any] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A fresh place in the cluster's shared folder; it goes when the application's file systems close."""
    path = f"{shared_folder(spark)}/tablewright-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{path}/data"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of a few megabytes for the jobs inside; the session's own setting comes back."""
    before = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared folder and read it back.

    Cuts the lineage: later passes re-read stored rows, and a lost executor costs a re-read.
    """
    path = new_folder(df.sparkSession)
    with small_batches(df.sparkSession):
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files behind tables that are stored by now.

    Its cleaner acts when the driver's JVM collects the plans that own them, which a driver with free memory
    may put off for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def model(kind: str, key: bytes, build: Callable[[], Any]) -> Any:
    """One parsed model per worker process, kept between tasks until the worker needs one of another kind."""
    found = _models.get((kind, key))
    if found is None:
        for other in [k for k in _models if k[0] != kind]:
            del _models[other]
        found = _models[(kind, key)] = build()
    return found


def give_back() -> None:
    """Return the worker's freed memory to the system, from Arrow's pool and, where the C library can, from its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(batches: Iterable[pa.RecordBatch], text: str | None, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of column ``text`` each; one row at least."""
    for batch in batches:
        if text is None or batch.num_rows <= 1:
            yield batch
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, seen = 0, 0
        for i, n in enumerate(sizes):
            if seen and seen + n > limit:
                yield batch.slice(start, i - start)
                start, seen = i, 0
            seen += int(n)
        yield batch.slice(start)
    give_back()  # the worker goes on to other stages


def with_fields(schema: T.StructType, added: list[tuple[str, T.DataType]]) -> T.StructType:
    """The schema after adding columns; a column of the same name is replaced, as withColumn does."""
    names = {name for name, _ in added}
    return T.StructType([f for f in schema.fields if f.name not in names] + [T.StructField(n, t, True) for n, t in added])


def with_columns(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in added]
    kept += added.items()
    return pa.RecordBatch.from_arrays([c for _, c in kept], names=[n for n, _ in kept])


def map_columns(
    df: DataFrame,
    text: str,
    added: list[tuple[str, T.DataType]],
    make: Callable[[pa.Array], dict[str, pa.Array]],
    keep_text: bool = True,
    limit: int = PIECE_BYTES,
) -> DataFrame:
    """Add columns computed from one text column, a bounded piece of an Arrow batch at a time."""
    ship(df.sparkSession)
    schema = with_fields(df.schema, added)
    if not keep_text:
        schema = T.StructType([f for f in schema.fields if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, limit):
            out = with_columns(piece, make(piece.column(piece.schema.get_field_index(text))))
            yield out if keep_text else out.drop_columns([text])

    return df.mapInArrow(run, schema)


class Generations:
    """A bounded cache: a full young generation becomes the old one, and what is used again comes back."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries = entries
        self.young: dict = {}
        self.old: dict = {}

    def fill(self, keys: set, make: Callable[[list], Iterable]) -> dict:
        """A mapping that holds every key; missing values come from ``make`` in one call."""
        if len(self.young) > self.entries:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = keys - young.keys()
        again = missing & old.keys()
        young.update(zip(again, map(old.__getitem__, again), strict=True))
        new = list(missing - again)
        if new:
            young.update(zip(new, make(new), strict=True))
        return young


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """Rename columns whose names an operator needs for itself; the mapping gives the old names back."""
    taken = set(df.columns) & set(names)
    renames = {n: f"_aside_{i}_{n}" for i, n in enumerate(sorted(taken))}
    return df.withColumnsRenamed(renames), {new: old for old, new in renames.items()}
