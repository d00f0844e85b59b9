"""Token ids of whole texts with a public tokenizer file, each piece encoded once while it is remembered.

Texts are cut where the tokenizer's own rules always cut (before a single blank between two other characters), so the ids
of the pieces, put together, are the ids of the text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # Spark already runs a task per core

from tokenizers import Tokenizer  # noqa: E402

#: White space but the blank and the line end, and where blanks are more than a single one between two other characters.
_OTHER_SPACE = r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNEVEN = rf"(?s)  | \n|\n |\A | \z|{_OTHER_SPACE}"
_CUT = re.compile(r"(?<=[^\s]) (?=[^\s])")
#: Pieces that one call of the library encodes.
_AT_ONCE = 256


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@cache
def encoder(path: str) -> PieceEncoder:
    """The encoder of this process; a Python worker keeps what it has learned for its next task."""
    return PieceEncoder(path)


class _Slots(dict):
    """Piece to slot; a piece not met before gets the next slot, and what is to be encoded for it waits in ``new``."""

    def __init__(self, lead: str, new: list[str], numbers: Iterator[int], held: dict[str, int] | None = None):
        super().__init__(held or {})
        self.lead, self.new, self.numbers = lead, new, numbers

    def __missing__(self, piece: str) -> int:
        self.new.append(self.lead + piece)
        self[piece] = slot = next(self.numbers)
        return slot


class PieceEncoder:
    """Encodes texts; remembers about ``remembered`` pieces, the ones used more than once first.

    Pieces behind a blank and first pieces of texts have tables of their own.
    """

    def __init__(self, path: str, remembered: int = 800_000):
        self.tokenizer, self.remembered = tokenizer(path), remembered
        marks = [(i, t) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items()) if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self.mark_id, self.mark = (marks[-1][0], marks[-1][1].content) if marks else (None, None)
        self._hold({}, {}, np.empty(0, np.uint32), np.empty(0, np.int64))

    def _hold(self, behind: dict[str, int], first: dict[str, int], pool: np.ndarray, lengths: np.ndarray) -> None:
        self.new: list[str] = []
        numbers = count(len(lengths))
        self.behind, self.first = _Slots(" ", self.new, numbers, behind), _Slots("", self.new, numbers, first)
        self.pool, self.lengths, self.uses = pool, lengths, np.zeros(len(lengths), np.int64)

    def _trim(self) -> None:
        """Keeps the pieces used at least twice, or nothing if that is still too much."""
        keep = self.uses > 1
        if keep.sum() > self.remembered // 2:
            keep[:] = False
        place = np.cumsum(keep) - 1
        behind, first = ({p: int(place[s]) for p, s in held.items() if keep[s]} for held in (self.behind, self.first))
        self._hold(behind, first, self.pool[np.repeat(keep, self.lengths)], self.lengths[keep])

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece).

        Many pieces go through the library as one text, parted by a special token; if one of them holds it, each by itself.
        """
        if self.mark is not None:
            (found,) = self.tokenizer.encode_batch_fast([self.mark.join([*pieces, ""])], add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            end = ids == self.mark_id
            if end.sum() == len(pieces):
                return ids[~end], np.diff(np.flatnonzero(end), prepend=-1) - 1
        own = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        return np.fromiter(chain.from_iterable(own), np.uint32, int(lengths.sum())), lengths

    def _learn(self) -> None:
        pools, lengths = [self.pool], [self.lengths]
        for i in range(0, len(self.new), _AT_ONCE):
            ids, sizes = self._ids(self.new[i:i + _AT_ONCE])
            pools.append(ids)
            lengths.append(sizes)
        self.uses = np.concatenate([self.uses, np.zeros(len(self.new), np.int64)])
        self.new.clear()
        self.pool, self.lengths = np.concatenate(pools), np.concatenate(lengths)

    def _slots(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of pieces of each text, their slots)."""
        counts, empty = np.zeros(len(column), np.int64), pc.equal(pc.binary_length(column), 0)
        uneven = pc.match_substring_regex(column, _UNEVEN)
        even = np.flatnonzero(pc.invert(pc.or_(empty, uneven)).to_numpy(zero_copy_only=False))
        lists = pc.split_pattern(column.take(pa.array(even, pa.int64())), " ")
        counts[even] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        words, code = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy(zero_copy_only=False)
        begins = np.zeros(len(code), bool)
        begins[np.cumsum(counts[even]) - counts[even]] = True
        slots, table = np.empty(len(code), np.int64), np.empty(len(words), np.int64)
        for some, of in ((~begins, self.behind), (begins, self.first)):
            used = np.unique(code[some])
            table[used] = list(map(of.__getitem__, words[used].tolist()))
            slots[some] = table[code[some]]
        odd = {}
        for i in np.flatnonzero(uneven.to_numpy(zero_copy_only=False)).tolist():
            pieces = _CUT.split(column[i].as_py())
            counts[i] = len(pieces)
            odd[i] = [self.first[pieces[0]], *map(self.behind.__getitem__, pieces[1:])]
        if not odd:
            return counts, slots
        out, at = np.empty(counts.sum(), np.int64), np.cumsum(counts) - counts
        out[np.repeat(at[even] - (np.cumsum(counts[even]) - counts[even]), counts[even]) + np.arange(len(slots))] = slots
        for i, own in odd.items():
            out[at[i]:at[i] + len(own)] = own
        return counts, out

    def encode(self, texts: pa.Array | list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) with ``end`` appended to each text; null counts as empty."""
        if len(self.behind) + len(self.first) > self.remembered:
            self._trim()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        counts, at = self._slots(pc.fill_null(column.cast(pa.large_string()), ""))
        if self.new:
            self._learn()
        self.uses += np.bincount(at, minlength=len(self.uses))
        size, starts = self.lengths[at], np.cumsum(self.lengths) - self.lengths
        # each text is as long as its pieces and the end token
        before = np.concatenate([[0], np.cumsum(size)])
        edge = before[np.concatenate([[0], np.cumsum(counts)])]
        offsets = edge + np.arange(len(edge))
        out = np.full(offsets[-1], end, np.uint32)
        body = np.ones(len(out), bool)
        body[offsets[1:] - 1] = False
        out[body] = self.pool[np.repeat(starts[at] - before[:-1], size) + np.arange(before[-1])]
        return offsets, out


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
