"""Token files and packing against the plain tokenizer."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hexcohort.llm import packing, token_files
from hexcohort.llm.tokens import PieceEncoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TRICKY = ["  a b  \n\n c d\te  ", "x <|endoftext|> y<|endoftext|>z", "<|startoftext|>a", " lead", "can't 'll it's d'être", "a b  b  ", "e\u0301 \u0301 e",
          "ÀÉ ß İ ΑΣ Σ", "tail ", "a\u00a0b \u3000 c", "\x1c a \x1d", "1 234 5.6,7", "a\r\nb \r\n c", "a \0b", "\0a \0b\0 \0", "\0", "a b \0a b", "<|ENDOFTEXT|> x", "a <|endoftext| b",
          "a\u2028b \u2009c", "x \x85 y"]


def plain_ids(path, texts, end):
    t = Tokenizer.from_file(path)
    return [e.ids + [end] for e in t.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("remembered", [800_000, 3])
def test_pieces_give_the_ids_of_the_text(path, remembered):
    rng = random.Random(5)
    alphabet = ["a", "b", "The", " ", " ", "  ", "\n", ".", ",", "'s", "é", "1", "日", "\t", "!!", "🙂", "\0"]
    texts = [t or "" for t in ODD] + TRICKY + ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(400)]
    encoder = PieceEncoder(path, remembered)
    for _ in range(2):
        for i in range(0, len(texts), 60):
            part = texts[i:i + 60]
            offsets, ids = encoder.encode(part, 7)
            for k, want in enumerate(plain_ids(path, part, 7)):
                assert ids[offsets[k]:offsets[k + 1]].tolist() == want, part[k]


def test_files_round_trip(spark, docs_of):
    texts = [*ODD, *TRICKY]
    rows = [(i * 3 - 10, t) for i, t in enumerate(texts)] + [(None, "no id"), (5, "five b"), (5, "five a")]
    df = docs_of(rows).withColumn("start", F.lit("mine"))
    got = token_files.round_trip(df, WORD, 2).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = plain_ids(WORD, [t for _, t in order], 2)
    want, at = [], 0
    for (name, _), own in zip(order, ids):
        want.append((name, at, len(own), crc(own)))
        at += len(own)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_empty_table_gives_no_files(spark, docs_of):
    assert token_files.round_trip(docs_of(["x"]).limit(0), WORD, 2).collect() == []


def test_a_second_attempt_does_not_disturb_the_manifest(spark, docs_of, tmp_path):
    df = docs_of(["one two", "three"])
    first = token_files.write(df, str(tmp_path), WORD, 2, partitions=2).collect()
    (tmp_path / "part-00000-left-over.ids").write_bytes(b"\x01")        # of a task that died
    assert {r["path"] for r in first} and token_files.read(spark, str(tmp_path)).count() == 2


@pytest.mark.parametrize("total", [0, 1, 64, 1023, 1024, 1025, 5000])
def test_capacities_hold_exactly_and_need_no_padding(total):
    sizes = packing.capacities(total)
    assert sum(sizes) == total and all(s == 1024 or s & (s - 1) == 0 for s in sizes)


def test_packing_fills_every_sequence():
    rng = random.Random(6)
    for size in (16, 1024):
        for _ in range(30):
            lengths = [rng.choice([1, 2, rng.randint(1, size), rng.randint(1, 5 * size)]) for _ in range(rng.randint(1, 60))]
            pieces = packing.pack(lengths, size)
            by_doc, by_seq = defaultdict(list), defaultdict(list)
            for d, start, n, s, offset in pieces:
                by_doc[d].append((start, n))
                by_seq[s].append((offset, n))
            room = packing.capacities(sum(lengths), size)
            for d, n in enumerate(lengths):
                at = 0
                for start, k in sorted(by_doc[d]):
                    assert start == at and k > 0
                    at += k
                assert at == n
            assert sorted(by_seq) == list(range(len(room)))
            for s, held in by_seq.items():
                at = 0
                for offset, k in sorted(held):
                    assert offset == at
                    at += k
                assert at == room[s]


def test_tails_go_to_the_cheapest_sequence_with_room():
    pieces = packing.pack([600, 500, 400, 300, 200, 48], 1024)      # two sequences of 1024
    home = {d: s for d, start, _, s, _ in pieces if start == 0}
    assert home[0] != home[1] and home[2] == home[1] and home[3] == home[0]


def test_packed_pieces_are_the_tokens(spark, docs_of):
    texts = [*ODD, *TRICKY, "word " * 3000]
    df = docs_of(texts).withColumn("offset", F.lit(1))
    rows = packing.packed(df, BYTE, 0, bundle=4096).collect()
    ids = plain_ids(BYTE, texts, 0)
    for i, own in enumerate(ids):
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(own) and r["ids_crc32"] == crc(own[at:at + r["length"]])
            at += r["length"]
        assert at == len(own)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_length"]))
    for held in sequences.values():
        at = 0
        for offset, n, _ in sorted(held):
            assert offset == at
            at += n
        assert at == held[0][2] and (at == 1024 or at & (at - 1) == 0)
    assert packing.packed(df.limit(0), BYTE, 0).collect() == []
