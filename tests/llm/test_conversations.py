"""Turn repair and the prefix trie against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from hexcohort.llm import turn_repair, turn_trie
from hexcohort.llm.turn_repair import Node, Repair, before

ROWS = "conv_id long, turn long, role string, text string"
ODD = ([(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (None, 1, "user", "a?"), (None, None, "assistant", "b"), (2, 1, "", ""),
        (2, 1, "x", "y"), (2, 1, "x", "y"), (3, 5, None, "é! "), (4, 1, "system", "s."), (4, 2, "user", "u."), (4, 9, "assistant", "t.\n"),
        (5, 0, "user", "word " * 60_000), (6, -3, "assistant", "\x0b\x0c"), (200, 0, "user", "only here?")]
       + [(7, i % 3, "user", "same.") for i in range(40)]
       + [(8, i, ("user", "assistant", "tool", "system")[i * 7 % 4], f"t{i % 5}{'.?'[i % 2]}") for i in range(60)]
       + [(100 + i, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for i in range(30) for t in range(i % 4)])


# --- repair -------------------------------------------------------------------------------------------------------------

def cheapest(rows):
    """(cost, audit, text) by trying all edits, with at most two inserted turns in a gap."""
    best = None

    def go(i, state, cost, audit, out, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows) and state in "-a":
            found = (cost, audit, "\n".join(out))
            best = found if best is None or found < best else best
        role = "assistant" if state == "u" else "user"
        if inserted < 2:
            go(i, role[0], cost + 5, audit + "I", [*out, role + ":"], inserted + 1)
        if i < len(rows):
            name, text, gone, extra = rows[i]
            go(i + 1, state, cost + 2, audit + "D", out, 0)
            if not gone:
                if name[:1] == role[0] or state == "-" and name[:1] == "s":
                    go(i + 1, name[0], cost + extra, audit + "K", [*out, f"{name}:{text}"], 0)
                go(i + 1, role[0], cost + 1 + extra, audit + "R", [*out, f"{role}:{text}"], 0)

    go(0, "-", 0, "", [], 0)
    return best


def spoiled(rows):
    out = []
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv_id, turn)).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    convs = {r[0]: [] for r in rows}
    for r in spoiled(rows):
        convs[r[0]].append(r)
    out = []
    for conv_id, own in convs.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, counts, edits = set(), [0, 0, 0], []
        for _, _, role, text in own:
            solid = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
            edits.append((role, text, fault in (0, 1), 5 if fault == 2 else 0))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        if len(own) <= 6:
            cost, audit, text = cheapest(edits)
        else:
            repair = Repair()
            for e in edits:
                repair._edit(*e)
            *_, cost, audit, text = repair.result()
        out.append((conv_id, gaps, *counts, illegal, cost, audit, text if len(own) > 6 else hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_edits_are_the_cheapest_and_least():
    r = random.Random(1)
    for _ in range(300):
        rows = [(r.choice(["user", "assistant", "system", "x", ""]), r.choice("pq"), r.random() < .2, r.choice([0, 0, 5])) for _ in range(r.randint(0, 5))]
        repair, best = Repair(), cheapest(rows)
        for row in rows:
            repair._edit(*row)
        assert repair.result()[5:] == (best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest())


def test_long_audits_are_compared_through_their_ancestors():
    r = random.Random(2)
    shared = Node(None, "")
    for c in r.choices("KD", k=5000):
        shared = Node(shared, c)
    ends = []
    for _ in range(30):
        node = shared
        for c in r.choices("DK", k=r.randint(0, 40)):
            node = Node(node, c)
        ends.append(node)
    for a in ends:
        for b in ends:
            assert before(a, b) == (a.path() < b.path())


def test_hashes_that_meet_are_verified():
    def path(letters):
        node = Node(None, "")
        for c in letters:
            node = Node(node, c)
            node.hash = 7
        return node

    for a in ("DKKD", "DKRD", "KKKD", "DKKDI"):
        for b in ("DKKD", "DKRD", "KKKD", "DKKDI"):
            assert before(path(a), path(b)) == (a < b)


def test_conversations_with_odd_rows(spark):
    df = spark.createDataFrame(ODD, ROWS).selectExpr("*", "1 AS conv", "2 AS copies", "3 AS seen", "'x' AS digest", "'y' AS `at`").repartition(5)
    assert sorted(map(tuple, turn_repair.repaired(turn_repair.damaged(df)).collect()), key=str) == plain_repair(ODD)
    assert turn_repair.repaired(turn_repair.damaged(df.limit(0))).collect() == []


def test_a_conversation_with_many_equal_rows_stays_one_row_until_it_is_read(spark):
    df = spark.range(4000).selectExpr("CAST(9 AS LONG) AS conv_id", "CAST(1 AS LONG) AS turn", "'user' AS role", "'hello.' AS text", "1L AS copies")
    (row,) = turn_repair.repaired(df).collect()
    # one row is answered by an inserted turn, or goes: deleting is cheaper
    assert (row.duplicate, row.illegal, row.cost, row.audit) == (3999, 3999, 8000, "D" * 4000)


# --- trie ---------------------------------------------------------------------------------------------------------------

def plain_trie(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(ts, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))] for c, ts in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seq = own.get(c - c % 100, [])[:h] + own[c][h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    out = []
    for p, ms in members.items():
        below = [q for q in members if q[:len(p)] == p]
        n_children = sum(len(q) == len(p) + 1 for q in below)
        leaves = sum(not any(len(x) == len(q) + 1 and x[:len(q)] == q for x in members) for q in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        sha = hashlib.sha256(",".join(map(str, ends[p] if p in ends else [])).encode()).hexdigest()
        out.append((ms[0], len(p), min(members[p[:-1]]) if p else None, len(ms), n_children, leaves, saved, sha))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard,chunk", [(200_000, 4096), (25, 2), (1, 1)])
def test_trie_with_odd_rows_and_any_size_of_shards(spark, shard, chunk):
    df = spark.createDataFrame(ODD, ROWS).selectExpr("*", "1 AS base", "2 AS head", "3 AS name", "4 AS h", "5 AS turns").repartition(4)
    got = turn_trie.nodes(turn_trie.rebuilt(turn_trie.sequences(df)), shard, chunk)
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(ODD)


def test_empty_table_has_no_trie(spark):
    assert turn_trie.nodes(turn_trie.rebuilt(turn_trie.sequences(spark.createDataFrame([], ROWS)))).collect() == []


def test_median_insertion_keeps_siblings_shallow():
    tree = turn_trie.TernaryTree()
    tree.insert_balanced([[i] for i in range(1023)])

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.less[node]), height(tree.more[node]))

    assert height(tree.root) == 10
