"""Quality of documents by logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text's words and the marks between them (runs of letters and digits, runs of anything else) are tokens; single tokens and
pairs of neighbours are hashed into ``2 ** BITS`` places.  A document is the sparse vector of ``1 + log(count)`` scaled to
length one, and its score is the sparse dot product with the weights, through the logistic function.

* Learning takes a bounded sample: the ``max_rows`` labelled ids of smallest hash.  Their list, bounded so, is broadcast, and
  vectors are made where the documents are read.  The vectors, once per epoch, stream sorted through one task that holds
  nothing but the state of the regression (two numbers a place), whatever the length of the texts.
* The weights, ``2 ** BITS`` numbers whatever the data, go through the driver to all tasks; scoring reads all documents once
  and shuffles nothing.

Labels, language, source and id are no inputs of a score; ids only decide which labels are held out (crc32 of the id modulo 5
is 0) and the order of learning.

Defined cases: null and empty texts, and blanks alone, are one place of their own; a null id counts as an empty name, which is
held out; of differing labels for one id the smallest counts, labels other than 0 and 1 do not; of rows with one id and
differing texts the one with the smallest vector is learned from, all are scored; without labelled rows every score is 0.5; an
empty table gives an empty one; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.llm.common import bound_batches, hash_windows, hash_words, mix, window_starts

BITS, SIZES = 18, (1, 2)
FOLDS, THRESHOLD = 5, 0.3
MAX_ROWS, EPOCHS = 20_000, 3
#: Learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.0, 1e-3


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges, places, values): text i has ``places[edges[i]:edges[i + 1]]``, rising."""
    spaced = pc.replace_substring_regex(column.cast(pa.large_string()), r"([\pL\pN]+)", r" \1 ")
    offsets, words = hash_words(spaced)
    docs, places = [np.flatnonzero(np.diff(offsets) == 0)], [np.zeros(int((np.diff(offsets) == 0).sum()), np.uint64)]
    for n in SIZES:
        doc, at = window_starts(offsets, n)
        docs.append(doc)
        places.append(mix(hash_windows(words, n)[at] + np.uint64(n)) >> np.uint64(64 - BITS))
    both = (np.concatenate(docs).astype(np.uint64) << np.uint64(BITS)) | np.concatenate(places)
    found, count = np.unique(both, return_counts=True)
    doc = (found >> np.uint64(BITS)).astype(np.int64)
    value = 1 + np.log(count)
    value /= np.sqrt(np.bincount(doc, value * value, minlength=len(column)))[doc]
    return np.searchsorted(doc, np.arange(len(column) + 1)), (found & np.uint64((1 << BITS) - 1)).astype(np.int64), value


class Leader:
    """Follow-the-regularised-leader for logistic loss; place ``2 ** BITS`` is the constant."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(places, 1 << BITS), np.append(values, 1.0)
        w = self.weights(at)
        g = (_logistic(w @ x) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def _remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def sampled(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``(id, label, place)`` of at most ``max_rows`` ids that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label"))
    known = known.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (_remainder(F.col("id")) != 0))
    return known.groupBy("id").agg(F.min("label").alias("label")).withColumn("place", F.xxhash64("id")).orderBy("place", "id").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """The weights, the constant last."""
    bound_batches(docs.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edges, places, values = vectors(b.column(3))
            lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(x, t)) for x, t in ((places, pa.int32()), (values, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *lists], names=["id", "label", "place", "at", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = Leader()
        for b in batches:
            for label, at, x in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                leader.learn(at.values.to_numpy(), x.values.to_numpy(), label)
        yield pa.RecordBatch.from_arrays([pa.array([leader.weights(slice(None)).astype("<f8").tobytes()])], names=["weights"])

    sample = F.broadcast(sampled(labels, max_rows))             # ids, bounded by max_rows
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    made = (sample.join(texts, "id").select("id", "label", "place", "text")
            .mapInArrow(features, "id long, label int, place long, at array<int>, x array<double>"))
    one = made.groupBy("id", "label", "place").agg(F.min(F.struct("at", "x")).alias("v"))
    rows = one.select(F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"), "place", "id", "label", "v.at", "v.x")
    trained = rows.repartition(1).sortWithinPartitions("epoch", "place", "id").select("label", "at", "x").mapInArrow(learn, "weights binary")
    found = trained.first()
    return np.frombuffer(bytes(found[0]), "<f8") if found else np.zeros((1 << BITS) + 1)


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float64))      # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            edges, places, values = vectors(b.column(2))
            sums = np.add.reduceat(np.append(w[places] * values, 0.0), edges[:-1]) if b.num_rows else np.empty(0)
            score = _logistic(sums + w[-1])
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (_remainder(F.col("doc_id")) == 0).alias("held_out"), "text")
    return named.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
