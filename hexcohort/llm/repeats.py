"""Removing passages that an earlier document already has, by level-wise doubling.

Levels halve the wanted window (13 words: 7, then 13).  A level looks only at windows whose two halves were repeated at the
level before, so most of the text drops out at the first level, which is also the cheapest one: it asks no more than
whether a window's slot (some leading bits of its hash) is used by two documents.  The next level extends what is left
to twice the length (the halves may share a word) with whole hashes, and the last one finds the smallest document of each
window.

Documents are dealt into groups by their id; a group keeps its texts in one place through all levels (Spark reuses that one
exchange), and only packed numbers travel: sorted slots or hashes as differences in byte planes, which the shuffle's own
compression shrinks to about two (slots) or six (hashes) bytes each.  A group folds its windows before sending, so a line
that a third of all documents share is one entry per group.  Buckets cut the hash range evenly; no bucket depends on how
often a window occurs.

Windows are compared by 64-bit hashes: among n windows about n * n / 2^65 are taken for another one by chance.

Defined cases: null and empty texts, and texts shorter than a window, lose nothing; a null id counts as larger than all
others; rows with equal ids are one document and do not remove each other's words; other columns are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.llm.common import bound_batches, hash_windows, hash_words, mix, window_starts

WINDOW = 13
NO_ID = np.iinfo(np.int64).max
_ODD = np.uint64(0x9FB21C651E98DF25)


# --- packed numbers -----------------------------------------------------------------------------------------------------

def to_planes(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as byte planes; empty high planes are left out."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = 8
    while used and not planes[used - 1].any():
        used -= 1
    return bytes([used]) + planes[:used].tobytes() + len(values).to_bytes(8, "little")


def from_planes(blob: bytes) -> np.ndarray:
    used, n = blob[0], int.from_bytes(blob[-8:], "little")
    out = np.zeros((n, 8), np.uint8)
    if used:
        out[:, :used] = np.frombuffer(blob, np.uint8, used * n, 1).reshape(used, n).T
    return out.view("<u8").ravel()


def to_sorted(values: np.ndarray) -> bytes:
    """Rising numbers: the first one, then the differences."""
    first = values[0] if len(values) else np.uint64(0)
    return int(first).to_bytes(8, "little") + to_planes(np.diff(values, prepend=first))


def from_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(from_planes(blob[8:]), dtype=np.uint64) + np.uint64(int.from_bytes(blob[:8], "little"))


# --- the shape of a run -------------------------------------------------------------------------------------------------

class Plan:
    """Sizes that follow the input: bytes per group grow with its square root, so that groups times buckets stays small."""

    def __init__(self, total_bytes: int, partitions: int, window: int):
        share = min(max(math.isqrt(max(total_bytes, 1) * 20_000), 1 << 20), 64 << 20)
        n = max(2 * partitions, total_bytes // share, 1)
        self.buckets = n
        self.groups = next(p for p in range(n | 1, 4 * n + 8, 2) if all(p % q for q in range(3, math.isqrt(p) + 1, 2)))
        self.bits = min(64, max(32, math.ceil(math.log2(max(total_bytes, 2))) + 3))
        self.lengths = [window]
        while self.lengths[0] > 7:
            self.lengths.insert(0, (self.lengths[0] + 1) // 2)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits)

    def edges(self, rising: np.ndarray, bits: int = 64) -> np.ndarray:
        """Where each bucket begins in rising numbers of so many bits; buckets cut the range evenly."""
        bucket = ((rising >> np.uint64(bits - 32)) * np.uint64(self.buckets)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(self.buckets + 1, dtype=np.uint64))


def group_of(doc_id: Column, groups: int) -> Column:
    """Even for running and for sparse ids alike; bit operations cannot overflow."""
    name = F.coalesce(doc_id.cast("long"), F.lit(int(NO_ID)))
    spread = name.bitwiseXOR(F.shiftrightunsigned(name, 15)).bitwiseXOR(F.shiftrightunsigned(name, 37))
    return F.pmod(spread, F.lit(groups)).cast("int")


class Group:
    """The windows of one group of documents, in rising document id."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").combine_chunks().cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        self.texts = table.column("text").combine_chunks().take(pa.array(self.order))
        self.offsets, self.words = hash_words(self.texts)

    def ladder(self, lengths: list[int]) -> list[np.ndarray]:
        """Per length a hash for each place of the words; only those of ``window_starts`` lie inside one text."""
        out = [np.zeros(len(self.words), np.uint64)]
        found = hash_windows(self.words, lengths[0])
        out[0][:len(found)] = found
        for length, longer in zip(lengths, lengths[1:], strict=False):
            shift, low = longer - length, out[-1]
            high = np.zeros_like(low)
            high[:len(low) - shift] = mix(low[:len(low) - shift] * _ODD + low[shift:])
            out.append(high)
        return out

    def candidates(self, lengths: list[int], passed: np.ndarray | None, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of the windows of the last length whose halves have a slot in ``passed``."""
        hashes = self.ladder(lengths)
        doc, at = window_starts(self.offsets, lengths[-1])
        if passed is not None:
            halves = hashes[-2]
            keep = contains(passed, plan.slots(halves[at]))
            doc, at = doc[keep], at[keep]
            keep = contains(passed, plan.slots(halves[at + lengths[-1] - lengths[-2]]))
            doc, at = doc[keep], at[keep]
        return doc, hashes[-1][at]


def contains(rising: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(rising):
        return np.zeros(len(values), bool)
    return rising[np.minimum(np.searchsorted(rising, values), len(rising) - 1)] == values


def run_starts(rising: np.ndarray) -> np.ndarray:
    """First place of every run of equal numbers."""
    return np.flatnonzero(np.concatenate([[True], rising[1:] != rising[:-1]])) if len(rising) else np.empty(0, np.int64)


def _merged(table: pa.Table, column: str) -> np.ndarray:
    """All numbers of all blobs, rising."""
    parts = [from_sorted(b) for b in table.column(column).to_pylist()]
    return np.sort(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


# --- levels -------------------------------------------------------------------------------------------------------------

_SENT = "bucket int, g int, numbers binary, more binary"
_REPLY = "g int, passed binary"


def _sent(rows: Iterator[tuple[int, bytes, bytes]], g: int) -> pa.Table:
    bucket, numbers, more = [list(c) for c in zip(*rows, strict=True)] or [[], [], []]
    return pa.table([pa.array(bucket, pa.int32()), pa.array([g] * len(bucket), pa.int32()), pa.array(numbers, pa.binary()),
                     pa.array(more, pa.binary())], names=["bucket", "g", "numbers", "more"])


def _replies(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table([pa.array([g for g, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["g", "passed"])


def _send_slots(docs: pa.Table, passed: np.ndarray | None, lengths: list[int], plan: Plan) -> pa.Table:
    """A group's distinct slots, and which of them several of its documents use."""
    doc, hashes = Group(docs).candidates(lengths, passed, plan)
    slots = plan.slots(hashes)
    order = np.argsort(slots, kind="stable")
    slots, doc = slots[order], doc[order]
    first = run_starts(slots)
    last = np.append(first[1:], len(slots)) - 1
    several = doc[first] != doc[last] if len(first) else np.empty(0, bool)
    slots = slots[first]
    edge = plan.edges(slots, plan.bits)
    g = docs.column("g")[0].as_py()
    return _sent([(i, to_sorted(slots[a:z]), to_sorted(slots[a:z][several[a:z]]))
                  for i, (a, z) in enumerate(zip(edge, edge[1:], strict=False)) if z > a], g)


def _answer_slots(table: pa.Table) -> pa.Table:
    """To each group those of its slots that two documents use."""
    groups, sent = table.column("g").to_pylist(), [from_sorted(b) for b in table.column("numbers").to_pylist()]
    every = np.sort(np.concatenate(sent))
    shared = np.union1d(every[1:][every[1:] == every[:-1]], _merged(table, "more"))
    found = [(g, own[contains(shared, own)]) for g, own in zip(groups, sent, strict=True)]
    return _replies([(g, to_sorted(own)) for g, own in found if len(own)])


def _send_owners(docs: pa.Table, passed: np.ndarray | None, lengths: list[int], plan: Plan) -> pa.Table:
    """A group's distinct windows, each with the smallest document of the group that has it."""
    group = Group(docs)
    doc, hashes = group.candidates(lengths, passed, plan)
    order = np.argsort(hashes, kind="stable")     # documents rise, so a run begins with the smallest
    hashes, doc = hashes[order], doc[order]
    first = run_starts(hashes)
    hashes, owner = hashes[first], group.ids[doc[first]].astype(np.uint64)
    edge = plan.edges(hashes)
    return _sent([(i, to_sorted(hashes[a:z]), to_planes(owner[a:z]))
                  for i, (a, z) in enumerate(zip(edge, edge[1:], strict=False)) if z > a], docs.column("g")[0].as_py())


def _answer_owners(table: pa.Table) -> pa.Table:
    """To each group those of its windows that a smaller document of another group has."""
    groups, sent = table.column("g").to_pylist(), [from_sorted(b) for b in table.column("numbers").to_pylist()]
    owners = [from_planes(b).astype(np.int64) for b in table.column("more").to_pylist()]
    every, owner = np.concatenate(sent), np.concatenate(owners)
    order = np.lexsort((owner, every))
    first = run_starts(every[order])
    windows, smallest = every[order][first], owner[order][first]
    found = [(g, own[smallest[np.searchsorted(windows, own)] < o]) for g, own, o in zip(groups, sent, owners, strict=True)]
    return _replies([(g, to_sorted(own)) for g, own in found if len(own)])


def _trim(docs: pa.Table, earlier: np.ndarray, lengths: list[int], plan: Plan) -> pa.Table:
    """What is left of each document, given the group's windows that smaller documents elsewhere have."""
    group, size = Group(docs), lengths[-1]
    doc, at = window_starts(group.offsets, size)
    hashes = group.ladder(lengths)[-1][at]
    order = np.argsort(hashes, kind="stable")
    first = run_starts(hashes[order])
    smallest = np.repeat(group.ids[doc[order][first]], np.diff(np.append(first, len(order))))
    gone = contains(earlier, hashes)
    gone[order] |= group.ids[doc[order]] > smallest
    cover = np.zeros(len(group.words) + 1, np.int64)
    np.add.at(cover, at[gone], 1)
    np.add.at(cover, at[gone] + size, -1)
    removed = np.cumsum(cover[:-1]) > 0
    kept, spans = [], []
    for i, text in enumerate(group.texts.to_pylist()):
        own = removed[group.offsets[i]:group.offsets[i + 1]]
        words = (text or "").encode().split()
        kept.append(b" ".join(w for w, r in zip(words, own.tolist(), strict=True) if not r) if own.any() else b" ".join(words))
        edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
        spans.append(",".join(f"{a}:{z}" for a, z in edge.reshape(-1, 2).tolist()))
    total = np.concatenate([[0], np.cumsum(removed)])[group.offsets]
    return pa.table([pa.array(group.ids, pa.int64(), mask=group.ids == NO_ID), pa.array(np.diff(group.offsets)), pa.array(np.diff(total)),
                     pa.array([k.decode() for k in kept], pa.string()), pa.array(spans, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept", "spans"])


def _first(step: Callable, lengths: list[int], plan: Plan) -> Callable:
    def run(docs: pa.Table) -> pa.Table:
        return step(docs, None, lengths, plan)

    return run


def _next(step: Callable, lengths: list[int], plan: Plan) -> Callable:
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        return step(docs, _merged(replies, "passed"), lengths, plan)

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, spans)``: the words left (joined by blanks) and the word ranges removed."""
    spark = docs.sparkSession
    bound_batches(spark)
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0       # one number
    plan = Plan(total, int(spark.conf.get("spark.sql.shuffle.partitions")), window)
    dealt = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), group_of(F.col(doc_id), plan.groups).alias("g"))
    replies = None
    for level in range(1, len(plan.lengths) + 1):
        lengths, last = plan.lengths[:level], level == len(plan.lengths)
        send, answer = (_send_owners, _answer_owners) if last else (_send_slots, _answer_slots)
        if replies is None:
            sent = dealt.groupBy("g").applyInArrow(_first(send, lengths, plan), _SENT)
        else:
            sent = dealt.groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(_next(send, lengths, plan), _SENT)
        replies = sent.groupBy("bucket").applyInArrow(answer, _REPLY)
    return dealt.groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(
        _next(_trim, plan.lengths, plan), "doc_id long, n_words long, n_removed long, kept string, spans string")
