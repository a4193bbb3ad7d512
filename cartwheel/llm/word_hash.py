"""Hashes of the words of Arrow text columns, computed from their bytes in numpy.

A word is a run of bytes other than the six blanks (none of which occurs inside a UTF-8
character); A-Z count as a-z. Its hash is a polynomial in its bytes' random values, read off
running sums over the whole buffer, mixed with its length: no word becomes a Python object.
Words longer than WINDOW bytes are hashed by xxhash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from cartwheel.llm.common import BLANKS

#: Bytes that are worked on together; texts are put together or cut at blanks to about so many.
WINDOW = 1 << 18

_rng = np.random.Generator(np.random.PCG64(2027))
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[65:91] = _VALUES[97:123]
_SOLID = np.ones(256, dtype=bool)
_SOLID[[ord(c) for c in BLANKS]] = False
_BASE = int(_rng.integers(1, 2**62)) * 4 + 1


def _powers_to(n: int) -> list[np.ndarray]:
    """The first n + 1 powers of the base and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n + 1, base, dtype=np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors))
    return out


_POWERS, _INVERSES = _powers_to(WINDOW)
_LENGTH, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of at most WINDOW bytes, their starts); words also end at ``cuts``."""
    n = len(data)
    solid = _SOLID[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[cuts] = edge[0] = edge[n] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * _POWERS[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _INVERSES[starts]
    return mixed(h ^ ((ends - starts).astype(np.uint64) * _LENGTH)), starts


def run_hashes(values: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the runs of values that are ``inside``, their starts) of any integers."""
    n = len(values)
    powers, inverses = (_POWERS, _INVERSES) if n <= WINDOW else _powers_to(n)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    # odd numbers, all of whose bits differ for different values
    np.cumsum(((values.astype(np.uint64) + _VALUES[0]) * _MIX2 | np.uint64(1)) * powers[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverses[starts]
    return mixed(h ^ ((ends - starts).astype(np.uint64) * _LENGTH)), starts


def _long_text(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one text of more than WINDOW bytes."""
    blanks = np.flatnonzero(~_SOLID[data])
    out, start = [], 0
    while start < len(data):
        end = min(start + WINDOW, len(data))
        if end < len(data):
            k = int(np.searchsorted(blanks, end, side="right")) - 1
            if k >= 0 and blanks[k] >= start:
                end = int(blanks[k]) + 1
            else:  # one word is longer than the window
                end = int(blanks[k + 1]) if k + 1 < len(blanks) else len(data)
                word = data[start:end].copy()
                word[(word >= 65) & (word <= 90)] += 32
                out.append(np.array([xxhash.xxh3_64_intdigest(word.tobytes())], dtype=np.uint64))
                start = end
                continue
        # blanks may end a window that is one byte too long
        out.append(_hashes(data[start:end][:WINDOW], np.zeros(0, dtype=np.int64))[0])
        start = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of every text's words, in order (none for null)."""
    n = len(texts)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    if texts.null_count:  # what a null's place in the buffer holds is not defined
        texts = texts.fill_null("")
        yield from word_hashes(texts)
        return
    at = 0
    while at < n:
        if offsets[at + 1] - offsets[at] > WINDOW:
            yield _long_text(data[offsets[at]:offsets[at + 1]])
            at += 1
            continue
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + WINDOW, side="right")) - 1)
        cuts = offsets[at:end + 1] - offsets[at]
        hashes, starts = _hashes(data[offsets[at]:offsets[end]], cuts)
        places = np.searchsorted(starts, cuts)
        for k in range(end - at):
            yield hashes[places[k]:places[k + 1]]
        at = end
