"""What the operators share: bounded Arrow batches, appended columns, word hashing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

#: Text that one Arrow batch holds, about; a single longer document is a batch of its own.
BATCH_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Readies a session for Python tasks.

    Arrow batches are cut by bytes, so that a worker's memory does not follow the row length, and workers get this package.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's source to the executors, once per application: they need not have it installed."""
    app, package = spark.sparkContext.applicationId, Path(__file__).parent.parent
    if app in _shipped or not package.is_dir():
        return
    folder = tempfile.mkdtemp()         # the driver's own; Spark serves the file from there
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` (any case) has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def append_columns(df: DataFrame, source: str, fields: Sequence[StructField],
                   fn: Callable[[pa.Array], Sequence[pa.Array]]) -> DataFrame:
    """``df`` with more columns, computed batch by batch from the one named ``source``.

    All other columns pass through untouched; the names in ``fields`` must be free (see ``fresh``).
    """
    bound_batches(df.sparkSession)
    at = df.columns.index(source)
    names = [*df.columns, *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *fn(b.column(at))], names=names)

    return df.mapInArrow(run, StructType([*df.schema.fields, *fields]))


def texts_of(column: pa.Array) -> list[str]:
    """Python strings; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


# --- 64-bit hashing in numpy -------------------------------------------------------------------------------------

_M1, _M2, _GOLDEN = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def hash_words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): the words of text i are ``hashes[offsets[i]:offsets[i + 1]]``.

    Words are runs of anything but ASCII white space; null has none.  Each distinct word of the batch is hashed once.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pc.ascii_trim_whitespace(pc.ascii_lower(column) if lower else column)
    lists = pc.ascii_split_whitespace(column)
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_numpy(zero_copy_only=False)), np.uint64, len(coded.dictionary))
    words = table[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.empty(0, np.uint64)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # an empty text comes out as one empty word
    empty = pc.equal(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    if empty.any():
        words = words[np.repeat(~empty, counts)]
        counts = np.where(empty, 0, counts)
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), words


def hash_windows(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words of one long array, whatever text they belong to."""
    n = max(0, len(words) - size + 1)
    acc = words[:n].copy()
    for i in range(1, size):
        acc *= _BASE
        acc += words[i:i + n]
    return mix(acc)


def window_starts(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place in the word array) of every window that lies inside one text."""
    n = np.maximum(np.diff(offsets) - size + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    return doc, np.arange(len(doc)) - np.repeat(first - offsets[:-1], n)
