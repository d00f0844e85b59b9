"""Weighted MinHash signatures of multisets by hierarchical Poisson processes (BagMinHash).

An element with weight w owns the strip of levels (0, w].  Levels are grouped into (0, 1], (1, 2], (2, 4], (4, 8] ...; each
group of an element is a Poisson process in time whose rate is the group's width, and each of its points has a random
level inside the group and a random component of the signature.  Points above the element's weight are passed over.  A
component keeps the earliest time of all points that fall to it.  Processes depend on the element and the group alone, so
two multisets share exactly the points below both weights, and a component agrees with probability

    sum of min(weights) / sum of max(weights),

the weighted Jaccard similarity.  Weights are counts, so the levels are discrete without error.

Processes run in step for all texts of a batch, in order of time, and a process stops as soon as it is later than the
latest component of its text.  So a text costs about its number of distinct elements, not that times the components.
"""

from __future__ import annotations

import numpy as np

from hexcohort.llm.common import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = np.uint64(0xC2B2AE3D27D4EB4F)


def signatures(text: np.ndarray, element: np.ndarray, count: np.ndarray, n_texts: int, size: int) -> np.ndarray:
    """Times, one row of ``size`` per text; rows of texts without elements stay infinite.

    ``text`` (number), ``element`` (64-bit hash) and ``count`` describe each distinct element of each text.
    """
    held = np.full(n_texts * size, np.inf)
    owner, seed, width, room = [text], [mix(element)], [np.ones(len(text))], [np.ones(len(text))]
    low = 1
    while len(text) and low < count.max():
        more = count > low              # the group (low, 2 low]
        owner.append(text[more])
        seed.append(mix(element[more] + np.uint64(int(_LEVEL) * low % 2 ** 64)))
        width.append(np.full(more.sum(), float(low)))
        room.append(np.minimum(count[more] - low, low).astype(float))
        low *= 2
    owner, seed, width, room = map(np.concatenate, (owner, seed, width, room))
    time = np.zeros(len(owner))
    while len(owner):
        # a few processes left: several of their points at once
        steps = max(1, min(64, 8192 // len(owner)))
        seeds = seed + (np.arange(1, steps + 1, dtype=np.uint64) * _STEP)[:, None]
        a = mix(seeds)
        b = mix(a ^ _LEVEL)
        late = np.log1p((a >> np.uint64(11)) * -(2.0 ** -53)) / -width
        late[0] += time                 # one after another: the same bits however many points are taken at once
        times = np.cumsum(late, axis=0)
        level = (b >> np.uint64(32)) * (width * 2.0 ** -32)
        part = ((b & np.uint64(0xFFFFFFFF)) * np.uint64(size)) >> np.uint64(32)
        hit = level < room
        np.minimum.at(held, (owner * size + part.astype(np.int64))[hit], times[hit])
        first = np.flatnonzero(np.diff(owner, prepend=-1))            # texts stand together in each group of levels
        last = np.repeat(held.reshape(n_texts, size)[owner[first]].max(axis=1), np.diff(np.append(first, len(owner))))
        on = times[-1] < last
        owner, seed, width, room, time = owner[on], seeds[-1][on], width[on], room[on], times[-1][on]
    return held.reshape(n_texts, size)


def band_keys(times: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band of ``rows`` components."""
    bits = times.view(np.uint64).reshape(len(times), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, (len(times), bands)).copy()
    for i in range(rows):
        keys = mix(keys ^ bits[:, :, i]) + _LEVEL
    return keys


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets (rising distinct elements, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / max(1, int(a[1].sum() + b[1].sum()) - shared)
