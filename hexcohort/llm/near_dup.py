"""Near-duplicate documents: BagMinHash signatures, banding, exact check of multiset overlap, components.

Documents are compared by the weighted Jaccard similarity of their multisets of five-word shingles (case of ASCII letters
ignored); similar ones (``threshold`` or more) are linked, and a class is a connected set of links.

* Copies (equal word sequences) fold to their smallest id before anything else.
* Documents that agree in a band share a bucket.  First every bucket
  links its members to its smallest one, after the exact check: a large group of near copies is joined with about one
  comparison per member.
* What a bucket still holds apart then is compared completely, block by block inside tasks: signatures first, and the texts
  of those members that look like one of another part.  A task keeps the parts it has joined and writes only links that join
  two; so no connection between bucket members is lost, rows stay below the number of members, and documents that merely
  share a passage cost none.
* With 48 bands of 8 rows a pair at similarity 0.8 shares no bucket with a probability of 1.5 in ten thousand, and one at
  0.3 shares any with 3 in a thousand.

Nothing is collected; the steps' small tables (ids, keys, links) are written to the shared scratch folder.

Defined cases: texts without words (null, empty, blanks only) are in a class of their own; texts of fewer than five words
are one shingle; rows with equal ids and words are copies of each other; rows with one id and differing words are one document
that is similar to what any of its texts is; a row without id is outside of all classes (its class is null, it counts as kept);
texts of any length are compared whole; an empty table gives an empty one; other columns, whatever their names, are not
touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.llm.bagminhash import band_keys, signatures, weighted_jaccard
from hexcohort.llm.common import bound_batches, fresh, hash_windows, hash_words, window_starts
from hexcohort.operators.components import connected_components
from hexcohort.sources.scratch import materialize

SHINGLE, THRESHOLD = 5, 0.8
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BANDS, ROWS = 48, 8
#: Components that are kept, one byte each, for an estimate.  A pair at the threshold has fewer equal ones than this with
#: a probability of one in a billion.
MARKS, LEAST_EQUAL = 96, 52
#: Members of a bucket, or bytes of their texts, that make a block; blocks are compared two at a time.
BLOCK, BLOCK_BYTES = 1024, 4 << 20


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """(text number, shingle, count) of each distinct shingle of each text, and a digest of each text's words."""
    offsets, words = hash_words(column, lower=True)
    lengths = np.diff(offsets)
    doc, at = window_starts(offsets, size)
    found = hash_windows(words, size)[at]
    for n in range(1, size):          # shorter texts are one shingle
        short = np.flatnonzero(lengths == n)
        if len(short):
            doc = np.concatenate([doc, short])
            found = np.concatenate([found, hash_windows(words, n)[offsets[short]]])
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    first = np.flatnonzero(new)
    digests = [xxhash.xxh3_128_digest(words[a:z].tobytes()) if z > a else None for a, z in zip(offsets, offsets[1:], strict=False)]
    return doc[first], found[first], np.diff(np.append(first, len(doc))), digests


def signed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(id, digest, keys, marks)``: band keys, and one byte of each component for a cheap estimate."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, found, count, digests = shingles(b.column(1))
            times = signatures(doc, found, count, b.num_rows, BANDS * ROWS)
            keys = band_keys(times, BANDS, ROWS).astype(np.int64)
            marks = (times.view(np.uint64)[:, :MARKS] >> np.uint64(8)).astype(np.uint8)
            some = np.array([d is not None for d in digests], bool)
            yield pa.RecordBatch.from_arrays([
                b.column(0).cast(pa.int64()), pa.array(digests, pa.binary()),
                pa.array([k if s else None for k, s in zip(keys.tolist(), some, strict=True)], pa.list_(pa.int64())),
                pa.array([m.tobytes() if s else None for m, s in zip(marks, some, strict=True)], pa.binary())],
                names=["id", "digest", "keys", "marks"])

    return docs.select(doc_id, text).mapInArrow(run, "id long, digest binary, keys array<long>, marks binary")


def checked(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs ``(a, b)`` whose texts ``(id, text)`` are similar.  Each task counts the overlap exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for column in (batch.column(2), batch.column(3)):
                doc, found, count, _ = shingles(column)
                edge = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                sides.append([(found[i:j], count[i:j]) for i, j in zip(edge, edge[1:], strict=False)])
            close = [weighted_jaccard(x, y) >= threshold for x, y in zip(*sides, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(close, pa.bool_()))

    both = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b"))
    return both.mapInArrow(run, "a long, b long").distinct()


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, MARKS)


def likely(pairs: DataFrame) -> DataFrame:
    """The pairs ``(a, b)``, each once, whose ``(marks_a, marks_b)`` agree well enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal = (_bytes(batch.column(2)) == _bytes(batch.column(3))).sum(1)
            yield batch.select([0, 1]).filter(pa.array(equal >= LEAST_EQUAL, pa.bool_()))

    return pairs.select("a", "b", "marks_a", "marks_b").mapInArrow(run, "a long, b long").distinct()


def _paired(held: DataFrame, size: Column, limit: int) -> DataFrame:
    """Rows ``held(key, part, head, ...)`` once per pair of blocks of their bucket that can hold a pair of different parts.

    ``size`` adds up to about ``limit`` in a block.  A part of more than that has blocks of its own, which are not paired with
    each other; smaller parts share blocks.
    """
    sizes = held.groupBy("key", "part").agg(F.sum(size).alias("size"))
    sizes = sizes.withColumn("own", F.when(F.col("size") > limit, F.col("part")))
    blocks = (sizes.groupBy("key", "own").agg(F.ceil(F.sum("size") / limit).cast("int").alias("n"))
              .groupBy("key").agg(F.collect_list(F.struct("own", "n")).alias("all")))
    of_part = materialize(sizes.select("key", "part", "own").join(blocks, "key"), "blocks")
    mine = F.aggregate("all", F.lit(1), lambda n, b: F.when(b["own"].eqNullSafe(F.col("own")), b["n"]).otherwise(n))
    placed = held.join(of_part.hint("merge"), ["key", "part"]).withColumn("block", F.struct("own", F.pmod(F.xxhash64("head"), mine).alias("i")))
    every = F.flatten(F.transform("all", lambda b: F.transform(F.sequence(F.lit(0), b["n"] - 1), lambda i: F.struct(b["own"].alias("own"), i.cast("long").alias("i")))))
    others = F.filter(every, lambda b: b["own"].isNull() | F.col("own").isNull() | (b["own"] != F.col("own")))
    spread = placed.withColumn("other", F.explode(others)).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    return spread.withColumn("is_low", F.col("block") == F.col("low")).withColumn("is_high", F.col("block") == F.col("high")).drop("all", "own", "block", "other")


def _likely_partners(i: int, others: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return others[(marks[others] == marks[i]).sum(1) >= LEAST_EQUAL]


def undecided(held: DataFrame) -> DataFrame:
    """``(key, head)`` of members of ``held(key, head, part, marks)`` with a likely partner of another part in their bucket."""
    def run(group: pa.Table) -> pa.Table:
        head, part = group.column("head").to_numpy(), group.column("part").to_numpy()
        marks = _bytes(group.column("marks").combine_chunks())
        low, high = (np.flatnonzero(group.column(c).to_numpy()) for c in ("is_low", "is_high"))
        some = np.zeros(len(head), bool)
        for i in low:
            near = _likely_partners(i, high[part[high] != part[i]], marks)
            some[near] = True
            some[i] |= len(near) > 0
        found = head[some]
        return pa.table({"key": pa.array(np.full(len(found), group.column("key")[0].as_py()), pa.int64()), "head": pa.array(found, pa.int64())})

    columns = ["key", "head", "part", "marks", "low", "high", "is_low", "is_high"]
    return (_paired(held, F.lit(1), BLOCK).select(columns).groupBy("key", "low", "high")
            .applyInArrow(run, "key long, head long").distinct())


def joining(held: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links ``(a, b)`` between parts of each bucket of ``held(key, head, part, marks, text)``, enough to join what is similar.

    A task compares a pair of blocks exactly, and leaves out pairs whose parts it has joined already: such a link changes no
    class.  So it writes fewer links than it has members.
    """
    def run(group: pa.Table) -> pa.Table:
        head = group.column("head").to_numpy()
        _, part = np.unique(group.column("part").to_numpy(), return_inverse=True)
        marks = _bytes(group.column("marks").combine_chunks())
        low, high = (np.flatnonzero(group.column(c).to_numpy()) for c in ("is_low", "is_high"))
        doc, found, count, _ = shingles(group.column("text").combine_chunks())
        edge, total = np.searchsorted(doc, np.arange(len(head) + 1)), np.bincount(doc, count, minlength=len(head))
        # which members hold a shingle, and how often
        _, code = np.unique(found, return_inverse=True)
        by_code = np.argsort(code, kind="stable")
        holders, times = doc[by_code], count[by_code]
        begin = np.searchsorted(code[by_code], np.arange(code.max(initial=-1) + 2))
        links = []
        for i in low:
            near = _likely_partners(i, high[part[high] != part[i]], marks)
            if not len(near):
                continue
            own = code[edge[i]:edge[i + 1]]
            size = begin[own + 1] - begin[own]
            at = np.repeat(begin[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
            shared = np.bincount(holders[at], np.minimum(np.repeat(count[edge[i]:edge[i + 1]], size), times[at]), minlength=len(head))
            for j in near[shared[near] / (total[i] + total[near] - shared[near]) >= threshold]:
                if part[i] != part[j]:
                    links.append(sorted((head[i], head[j])))
                    part[part == part[j]] = part[i]
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    columns = ["head", "part", "marks", "text", "key", "low", "high", "is_low", "is_high"]
    return (_paired(held, F.octet_length("text") + 64, BLOCK_BYTES).select(columns).groupBy("key", "low", "high")
            .applyInArrow(run, "a long, b long").distinct())


def classes(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(id, class_id, kept)``, one row per row of ``docs``: the smallest id of its class, and whether it is that one."""
    marked = materialize(signed(docs, text, doc_id), "signed")
    named = marked.filter(F.col("digest").isNotNull() & F.col("id").isNotNull())
    heads = named.groupBy("digest").agg(F.min("id").alias("head"))          # copies fold here
    own = materialize(named.join(heads, "digest").filter("id = head").select("digest", "head", "keys", "marks").dropDuplicates(["digest"]), "heads")
    marks = own.select("head", "marks")
    rows = own.select("head", F.explode("keys").alias("key"))        # many: ids and keys only
    # joins that carry keys or texts are told to sort and merge, so that they work alike at every size
    shared = materialize(rows.groupBy("key").agg(F.min("head").alias("leader"), F.max("head").alias("top")).filter("leader < top").drop("top")
                         .join(marks.withColumnsRenamed({"head": "leader", "marks": "leader_marks"}).hint("merge"), "leader"), "leaders")
    members = materialize(rows.join(shared.hint("merge"), "key").join(marks.hint("merge"), "head"), "buckets")
    nodes = members.select(F.col("head").alias("node")).distinct()
    texts = materialize(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
                        .join(nodes.withColumnRenamed("node", "id").hint("merge"), "id", "left_semi"), "texts")

    def linked(pairs: DataFrame) -> DataFrame:
        return materialize(checked(materialize(pairs, "pairs"), texts, threshold), "links")

    def parts_of(links: DataFrame) -> DataFrame:
        ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
        return connected_components(ends, links).withColumnsRenamed({"node": "head", "comp": "part"})

    links = linked(likely(members.filter("head > leader").select(
        F.col("leader").alias("a"), F.col("head").alias("b"), F.col("leader_marks").alias("marks_a"), F.col("marks").alias("marks_b"))))
    parts = parts_of(links)
    placed = materialize(members.select("key", "head", "marks").distinct().join(parts, "head", "left")
                         .select("key", "head", "marks", F.coalesce("part", "head").alias("part")), "placed")
    several = placed.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("key")
    apart = materialize(placed.join(several.hint("merge"), "key", "left_semi"), "apart")
    open_ = materialize(undecided(apart), "undecided")
    held = materialize(apart.join(open_.hint("merge"), ["key", "head"], "left_semi")
                       .join(texts.withColumnRenamed("id", "head").hint("merge"), "head"), "apart-texts")
    more = materialize(joining(held, threshold), "links")
    if not more.isEmpty():
        parts = parts_of(links.union(more))

    named_heads = own.select("digest", "head").distinct().join(parts, "head", "left")
    found = marked.select("id", "digest").join(named_heads, "digest", "left")
    class_id = F.coalesce("part", "head", "id")
    return found.select("id", F.when(F.col("id").isNotNull(), class_id).alias("class_id"),
                        (F.col("id").isNull() | (F.col("id") == class_id)).alias("kept"))


def distinct_documents(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each class, with its columns; of rows with equal ids and words one stays.

    Rows with one id and differing words stay all, if the id is its class's.  Rows without id stay.
    """
    kept_id, words = fresh(docs, "kept_id", "words")
    kept = classes(docs, threshold, text, doc_id).filter("kept AND id IS NOT NULL").select(F.col("id").alias(kept_id)).distinct()
    ids = F.col(f"`{doc_id}`")
    named = docs.join(kept, ids.cast("long") == F.col(kept_id), "left_semi")
    plain = F.regexp_replace(F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), _UPPER, _UPPER.lower()), r"[\x20\x09-\x0D]+", " ")
    one = named.withColumn(words, F.xxhash64(F.trim(plain))).dropDuplicates([doc_id, words]).drop(words)
    return one.unionByName(docs.filter(ids.isNull()))
