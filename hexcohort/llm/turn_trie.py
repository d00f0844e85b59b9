"""The prefix trie of conversations: which turns, from the first on, conversations share, and how many tokens that saves.

A node is a distinct sequence of first turns (role and text).  Conversations are sequences of turn digests; equal ones fold to
one sequence with a count before anything is sorted.

* Sequences are ranged, so that those with a common beginning stand together, and each task cuts its range into shards of a
  bounded number of turns.  A shard codes the digests it meets as dense numbers (its dictionary) and inserts its sequences
  into a ternary search tree, the middle one first, then the middles of both halves; so the trees of siblings are balanced
  whatever the order of arrival.
* A node of the tree is a node of the trie.  One walk with an explicit stack lists nodes parents first; a second one, from the
  last to the first, adds up members, leaves and savings.
* Only the beginnings of a shard's first and last sequence can go on in another shard.  These boundary nodes leave the shard
  with what hangs below them and is inside it, and with their ancestors at distances of powers of two.  They are merged by
  digest, and their sums go up to all ancestors in as many rounds as the depth has binary digits.
* The SHA-256 of the ids that end in a node runs over chunks of a bounded number of ids, joined in parallel; only chunks meet
  in one task, as a batch at a time.

Defined cases: a null role or text is empty; rows without ``conv_id`` take no part; null turns come first, ties follow by role
and text; repeated rows are turns of their own; a conversation whose turns all go is a member of the root alone; an empty
table gives no node, not even a root; other columns, whatever their names, are not read.  A conversation's digests (20 bytes
a turn, no texts) have to fit into a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexcohort.llm.common import bound_batches
from hexcohort.sources.scratch import materialize

#: Turns of a shard, about, and ids that are joined at once.
SHARD, CHUNK = 200_000, 4096
#: Conversations of one block start like the block's first, for so many turns at most.
BLOCK, HEAD = 100, 5
NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order, as ``(digest, length)``."""
    conv_id, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    rows = (conversations.filter(F.col("conv_id").isNotNull())
            .select(conv_id.alias("conv_id"), turn.alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.select("conv_id", F.struct(F.row_number().over(order).alias("at"), digest.alias("digest"), F.length("text").alias("length")).alias("t"))
    plain = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["length"].alias("length")))
    return placed.groupBy("conv_id").agg(plain.alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that start with up to ``HEAD`` turns of their block's first one, as the crc32 of their id says."""
    heads = turns.filter(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    own = turns.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    both = own.join(heads, "base", "left")
    first = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return both.select("conv_id", F.concat(first, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def _name(turns: Column) -> Column:
    return F.md5(F.array_join(F.transform(turns, lambda t: F.hex(t["digest"])), ""))


def endings(named: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(name, first, n, sha)`` of each sequence in ``named(name, conv_id)``: smallest id, number of ids, hash of all ids."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, out = None, [], []
        for b in batches:
            for name, conv_id in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if ids and (name != last or len(ids) == chunk):
                    out.append((last, ids[0], len(ids), ",".join(map(str, ids))))
                    ids = []
                last = name
                ids.append(conv_id)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["name", "first", "n", "ids"])
                out = []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (last, ids[0], len(ids), ",".join(map(str, ids)))],
                                             names=["name", "first", "n", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha, first, n, out = None, None, 0, 0, []
        for b in batches:
            for name, start, more, ids in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if name != last:
                    if sha:
                        out.append((last, first, n, sha.hexdigest()))
                    last, sha, first, n = name, hashlib.sha256(), start, 0
                sha.update((("," if n else "") + ids).encode())
                n += more
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["name", "first", "n", "sha"])
                out = []
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (last, first, n, sha.hexdigest())], names=["name", "first", "n", "sha"])

    chunks = (named.select("name", "conv_id").repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
              .mapInArrow(join, "name string, first long, n long, ids string"))
    return chunks.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digest, "name string, first long, n long, sha string")


class TernaryTree:
    """A ternary search tree over sequences of numbers; ``-1`` stands for no node.

    ``same`` leads to the trees of a node's children, ``less`` and ``more`` to siblings.
    """

    def __init__(self) -> None:
        self.turn, self.less, self.same, self.more = [], [], [], []
        self.root = -1

    def _new(self, turn: int) -> int:
        self.turn.append(turn)
        for links in (self.less, self.same, self.more):
            links.append(-1)
        return len(self.turn) - 1

    def insert(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence, added where they lack."""
        links, at, path = None, -1, []            # the link to follow: links[at], or the root
        for turn in sequence:
            node = self.root if links is None else links[at]
            while node >= 0 and self.turn[node] != turn:
                links, at = (self.less if turn < self.turn[node] else self.more), node
                node = links[at]
            if node < 0:
                node = self._new(turn)
                if links is None:
                    self.root = node
                else:
                    links[at] = node
            path.append(node)
            links, at = self.same, node
        return path

    def insert_balanced(self, sequences: list[list[int]]) -> list[list[int]]:
        """Inserts sorted sequences, medians first; returns the nodes of each."""
        paths: list[list[int]] = [[] for _ in sequences]
        spans = [(0, len(sequences))]
        while spans:
            a, z = spans.pop()
            if a < z:
                m = (a + z) // 2
                paths[m] = self.insert(sequences[m])
                spans += [(a, m), (m + 1, z)]
        return paths

    def walk(self) -> list[tuple[int, int]]:
        """``(node, parent)``, parents first; the parent of a first turn is -1."""
        out, stack = [], [(self.root, -1)] if self.root >= 0 else []
        while stack:
            node, parent = stack.pop()
            out.append((node, parent))
            for link, up in ((self.less, parent), (self.more, parent), (self.same, node)):
                if link[node] >= 0:
                    stack.append((link[node], up))
        return out


#: A finished node, or one whose parent (``parent_key``, in ``shard``) is a boundary node.
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")
#: All a shard gives out: nodes, and boundary nodes (``key`` is set) with what is below them inside the shard.
PIECE = f"{NODE}, shard string, parent_key binary, key binary, ups array<binary>, length long"


def _keys(digests: list[bytes]) -> list[bytes]:
    """The names of a sequence's beginnings, from the empty one on."""
    out = [b""]
    for d in digests:
        out.append(hashlib.md5(out[-1] + d).digest())
    return out


def shard_nodes(shard: str, rows: list[tuple]) -> Iterator[tuple]:
    """The ``PIECE`` rows of one shard: sorted, distinct ``(turns, first, n, sha)``."""
    codes = {d: i for i, d in enumerate(sorted({t["digest"] for turns, *_ in rows for t in turns}))}
    tree = TernaryTree()
    paths = tree.insert_balanced([[codes[t["digest"]] for t in turns] for turns, *_ in rows])
    size = len(tree.turn)                           # the root is kept behind all others, at -1
    members, least, leaves, saved, children = [0] * (size + 1), [None] * (size + 1), [0] * (size + 1), [0] * (size + 1), [0] * (size + 1)
    length, depth, sha = [0] * (size + 1), [0] * (size + 1), [None] * (size + 1)
    for path, (turns, first, n, digest) in zip(paths, rows, strict=True):
        for node, t in zip(path, turns, strict=True):
            length[node] = t["length"]
        end = path[-1] if path else -1
        members[end], least[end], sha[end] = n, first, digest
    # boundary: what the first and the last sequence pass
    key, ups, chain = {}, {}, {-1: [-1]}
    for i in (0, len(rows) - 1):
        nodes, names = [-1, *paths[i]], _keys([t["digest"] for t in rows[i][0]])
        for d, node in enumerate(nodes):
            key[node] = names[d]
            ups[node] = [names[d - (1 << k)] for k in range(d.bit_length()) if 1 << k <= d]
    order = tree.walk()
    for node, parent in order:
        depth[node] = depth[parent] + 1
    for node, parent in reversed(order):
        if node not in key:
            leaves[node] += children[node] == 0
            saved[node] += (members[node] - 1) * length[node]
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
        members[parent] += members[node]
        if least[parent] is None or least[node] < least[parent]:
            least[parent] = least[node]
    for node, parent in [*order, (-1, None)]:
        edge = node in key
        up = None if edge or parent in key else least[parent]
        yield (least[node], depth[node], up, members[node], children[node], leaves[node], saved[node], sha[node] or (None if edge else NOTHING),
               shard, key[parent] if parent is not None and parent in key else None, key.get(node), ups.get(node), length[node] if edge else None)


def in_shards(sorted_rows: DataFrame, size: int) -> DataFrame:
    """``PIECE`` rows of ``(turns, first, n, sha)``, sorted within partitions; a shard ends after ``size`` turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, turns = TaskContext.get().partitionId(), 0, [], 0
        names = [f.split(" ")[0] for f in PIECE.split(", ")]
        types = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.binary()] * 2 + [pa.list_(pa.binary()), pa.int64()]

        def flushed() -> Iterator[pa.RecordBatch]:
            rows = list(shard_nodes(f"{part}-{number}", held))
            for at in range(0, len(rows), 10_000):
                columns = zip(zip(*rows[at:at + 10_000], strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                held.append(row)
                turns += len(row[0]) + 1
                if turns >= size:
                    yield from flushed()
                    number, held, turns = number + 1, [], 0
        if held:
            yield from flushed()

    return sorted_rows.mapInArrow(run, PIECE)


def nodes(convs: DataFrame, shard: int = SHARD, chunk: int = CHUNK) -> DataFrame:
    """``NODE``, one row per distinct beginning of the sequences ``convs(conv_id, turns)``."""
    bound_batches(convs.sparkSession)
    named = materialize(convs.select("conv_id", _name(F.col("turns")).alias("name"), "turns"), "sequences")
    folded = named.groupBy("name").agg(F.first("turns").alias("turns")).join(endings(named, chunk), "name")
    digests = F.transform("turns", lambda t: t["digest"])
    ranged = folded.select("turns", "first", "n", "sha").repartitionByRange(digests).sortWithinPartitions(digests)
    pieces = materialize(in_shards(ranged, shard), "pieces")

    inside, partial = pieces.filter("key IS NULL"), pieces.filter("key IS NOT NULL")
    merged = partial.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("ends_sha256").alias("ends_sha256"), F.first("ups").alias("ups"), F.first("length").alias("length"))
    below = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    edge = materialize(merged.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
                       .withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
                       .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("length")).drop("more"), "boundary")
    sums = edge.select("key", "ups", "n_leaves", "saved_tokens")
    deepest = edge.agg(F.max(F.size("ups"))).first()[0] or 0            # a binary logarithm
    for k in range(deepest):
        up = sums.filter(F.size("ups") > k).select(F.col("ups")[k].alias("key"), F.lit(None).cast("array<binary>").alias("ups"), "n_leaves", "saved_tokens")
        sums = materialize(sums.unionByName(up).groupBy("key").agg(F.max("ups").alias("ups"), F.sum("n_leaves").alias("n_leaves"),
                                                                   F.sum("saved_tokens").alias("saved_tokens")), "sums")
    parents = edge.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    whole = (edge.drop("n_leaves", "saved_tokens").join(sums.drop("ups"), "key").join(parents, "parent_key", "left")
             .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))))
    # a node below the boundary gets its parent's name from its own shard: no parent has more rows there than a shard
    names = (partial.select("shard", F.col("key").alias("parent_key")).join(parents, "parent_key")
             .withColumnRenamed("parent_conv_id", "up"))
    hung = inside.filter("parent_key IS NOT NULL").join(names, ["shard", "parent_key"]).withColumn("parent_conv_id", F.col("up"))
    columns = [f.split(" ")[0] for f in NODE.split(", ")]
    return inside.filter("parent_key IS NULL").select(columns).unionByName(hung.select(columns)).unionByName(whole.select(columns))
