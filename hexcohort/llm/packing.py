"""Cost-balanced packing of documents into sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n`` (attention stays inside a piece).  Each task packs its own
documents in bundles of about ``bundle`` tokens: a bundle gets just as many sequences as its tokens fill, whole ones and,
for the rest, sequences of falling powers of two, which need no padding either.  Long documents are cut into whole
sequences and a tail; then tails go, dearest first, to the cheapest sequence with room for them.  A tail that fits nowhere
fills the cheapest sequence with any room and goes on with what is left, so no token of a bundle is ever padding.

No shuffle, and no state beyond one bundle: a document's pieces may lie in two bundles, but each bundle is final once it is
written.  Sequence numbers hold the partition and the place in it, so a task that runs again gives the same ones (given the
same input rows in the same order).

Defined cases: a null or empty text is its end token alone; a document of any length is cut; equal documents are packed one
by one; repeated rows give repeated pieces with other places; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hexcohort.llm.common import bound_batches
from hexcohort.llm.tokens import crc, encoder

SEQUENCE = 1024
BUNDLE = 1024 * SEQUENCE
LINEAR, QUADRATIC = 1.0, 1.0 / 512

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long, cost double")


def capacities(tokens: int, size: int = SEQUENCE) -> list[int]:
    """Sequence lengths that hold the tokens without a gap: whole ones, then powers of two."""
    rest = tokens % size
    return [size] * (tokens // size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cost(n: np.ndarray | int, linear: float = LINEAR, quadratic: float = QUADRATIC):
    return linear * n + quadratic * n * n


def pack(lengths: list[int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` and gapless, full sequences for the given documents."""
    room = np.array(capacities(sum(lengths), size), np.int64)
    full, load, used = len(room), np.zeros(len(room)), np.zeros(len(room), np.int64)
    free, pieces, tails = 0, [], []
    for d, n in enumerate(lengths):
        start = 0
        while n - start >= size:
            pieces.append((d, start, size, free, 0))
            room[free], used[free], load[free] = 0, size, cost(size)
            start, free = start + size, free + 1
        if n > start:
            tails.append((d, start, n - start))
    tails.sort(key=lambda t: (-t[2], t[0]))
    for d, start, n in tails:
        while n:
            fits = np.flatnonzero(room[free:] >= n)
            if not len(fits):
                fits = np.flatnonzero(room[free:] > 0)
            s = free + fits[np.argmin(load[free:][fits])]
            put = int(min(n, room[s]))
            pieces.append((d, start, put, int(s), int(used[s])))
            room[s] -= put
            used[s] += put
            load[s] += cost(put)
            start, n = start + put, n - put
    assert full == len(room) and not room.any()
    return pieces


def packed(docs: DataFrame, tokenizer_path: str, end: int, size: int = SEQUENCE, bundle: int = BUNDLE,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece; ``cost`` is its estimated share of the work, ``sequence_length`` that of its whole sequence."""
    bound_batches(docs.sparkSession)

    def rows(bundle_docs: list[tuple[int, int, np.ndarray, int]], first: int) -> tuple[pa.RecordBatch, int]:
        pieces = pack([len(ids) for _, _, ids, _ in bundle_docs], size)
        held = capacities(sum(len(ids) for _, _, ids, _ in bundle_docs), size)
        out = [[] for _ in range(9)]
        for d, start, length, s, offset in pieces:
            name, before, ids, total = bundle_docs[d]
            row = (name, before + start, length, crc(ids[start:start + length]), total, first + s, offset, held[s], float(cost(length)))
            for column, value in zip(out, row, strict=True):
                column.append(value)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 8 + [pa.float64()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
        return batch, first + len(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_of = encoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 40
        held, tokens = [], 0
        for b in batches:
            offsets, ids = pieces_of.encode(b.column(1), end)
            for i, name in enumerate(b.column(0).to_pylist()):
                at, total = 0, int(offsets[i + 1] - offsets[i])
                own = ids[offsets[i]:offsets[i + 1]]
                while at < total:
                    take = min(total - at, bundle - tokens)
                    held.append((name, at, own[at:at + take], total))
                    at, tokens = at + take, tokens + take
                    if tokens == bundle:
                        batch, first = rows(held, first)
                        yield batch
                        held, tokens = [], 0
        if held:
            yield rows(held, first)[0]

    return docs.select(doc_id, text).mapInArrow(run, SCHEMA)
