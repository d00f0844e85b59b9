"""Token ids as flat binary files.

Format, per file: ``part-NNNNN.ids`` holds the ids of its documents one after the other (unsigned, little-endian, 16 bits
if every id of the vocabulary fits and else 32), ``part-NNNNN.offsets`` the documents' first token inside the file plus the
end (unsigned 64 bits), ``part-NNNNN.docs`` their ids (signed 64 bits).  Files follow each other in rising document id; the
place of a file's first token in the whole is the sum of the sizes before it.  ``manifest`` (Parquet) names the files that
count, one row each, in order.

A task writes under a name of its own attempt and reports it, so a task that runs again, or twice at once, never leaves a
half-written file in the manifest.  Files are written and read through ``pyarrow.fs``; local paths are memory-mapped.

Defined cases: null and empty texts are the end token alone; a null id comes first; rows with equal ids follow by text; an
empty table gives a manifest without rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort.llm.common import bound_batches
from hexcohort.llm.tokens import crc, encoder, tokenizer
from hexcohort.sources.scratch import scratch_path

#: No id: a stand-in below every real one in the file of ids.
NO_ID = np.iinfo(np.int64).min


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def write(docs: DataFrame, folder: str, tokenizer_path: str, end: int, partitions: int | None = None,
          text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Encodes and writes all documents; returns the manifest ``(part, path, n_docs, n_tokens)`` as read back."""
    spark = docs.sparkSession
    bound_batches(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = "<u2" if tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        stem = f"{folder}/part-{part:05d}-{uuid.uuid4().hex}"
        store, path = _open(stem)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        pieces_of = encoder(tokenizer_path)
        tokens = n = 0
        with (store.open_output_stream(f"{path}.ids") as ids_out, store.open_output_stream(f"{path}.offsets") as offsets_out,
              store.open_output_stream(f"{path}.docs") as docs_out):
            for b in batches:
                offsets, ids = pieces_of.encode(b.column(1), end)
                ids_out.write(ids.astype(width).tobytes())
                offsets_out.write((offsets[:-1] + tokens).astype("<u8").tobytes())
                names = b.column(0).cast(pa.int64()).fill_null(int(NO_ID))
                docs_out.write(names.to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                tokens, n = tokens + int(offsets[-1]), n + b.num_rows
            offsets_out.write(np.array([tokens], "<u8").tobytes())
        if n:
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [stem], "n_docs": [n], "n_tokens": [tokens], "width": [width]})

    ordered = docs.select(doc_id, text).repartitionByRange(partitions, F.col(doc_id).asc_nulls_first())
    files = (ordered.sortWithinPartitions(F.col(doc_id).asc_nulls_first(), F.col(text).asc_nulls_first())
             .mapInArrow(run, "part long, path string, n_docs long, n_tokens long, width string"))
    files.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as the files have it: ``(doc_id, start, n_tokens, ids_crc32)``."""
    base, parts = 0, []
    for r in spark.read.parquet(f"{folder}/manifest").orderBy("part").collect():     # one row per file
        parts.append((r["path"], base, r["width"]))
        base += r["n_tokens"]
    if not parts:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def mapped(path: str, kind: str) -> np.ndarray:
        store, name = _open(path)
        if isinstance(store, fs.LocalFileSystem):
            return np.memmap(name, dtype=kind, mode="r")
        with store.open_input_file(name) as f:
            return np.frombuffer(f.read(), dtype=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first, width in zip(*[c.to_pylist() for c in b.columns], strict=True):
                ids, offsets, names = mapped(f"{path}.ids", width), mapped(f"{path}.offsets", "<u8"), mapped(f"{path}.docs", "<i8")
                for at in range(0, len(names), 10_000):
                    own = names[at:at + 10_000]
                    edge = offsets[at:at + len(own) + 1].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=np.asarray(own) == NO_ID), pa.array(edge[:-1] + first), pa.array(np.diff(edge)),
                         pa.array([crc(ids[a:z]) for a, z in zip(edge, edge[1:], strict=False)], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = spark.createDataFrame(parts, "path string, base long, width string").repartition(len(parts))
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, end: int) -> DataFrame:
    """Writes the documents below the shared scratch folder and reads them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    write(docs, folder, tokenizer_path, end)
    return read(docs.sparkSession, folder)
