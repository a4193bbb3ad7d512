"""Texts as dictionary codes of their parts, and rows of unequal length, in Arrow and numpy.

A column of texts is cut to parts (words, segments); equal parts of a group of texts are found
by Arrow, so Python sees each of them once, and the rows are put together from the parts'
values by index arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut and coded together, about.
GROUP_BYTES = 2 << 20


def groups(column: pa.Array, most: int = GROUP_BYTES) -> Iterator[pa.Array]:
    """The column in slices of about ``most`` bytes of text (a longer text by itself)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield column.slice(at, end - at)
        at = end


def codes_of(parts: pa.Array) -> tuple[list[str], np.ndarray]:
    """(distinct parts, the number of each part among them)."""
    coded = parts.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def put_together(values: list[bytes], kind: str, codes: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, end of each row) of rows of ``parts`` codes each; ``values`` are the
    codes' values as bytes of ``kind``."""
    width = np.dtype(kind).itemsize
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // width
    starts = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(values), dtype=kind)
    n = sizes[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    # place i of the result is place i - (end - size) of its part
    out = flat[np.arange(total) + np.repeat(starts[codes] - (ends - n), n)] if total else flat[:0]
    last = np.cumsum(parts)
    return out, np.concatenate([[0], ends])[last]


def cut_at(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The text of ``data`` (UTF-8 bytes) in parts that begin at ``starts``, the first at 0."""
    offsets = np.append(starts, len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, n + 1 offsets) of a column without nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


class Memory:
    """Values of distinct parts, those used of late: two generations of at most ``size``
    parts. When the younger is full it becomes the older, whose other parts are forgotten."""

    def __init__(self, size: int, longest: int):
        self.size, self.longest = size, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __contains__(self, part: str) -> bool:
        return part in self.young or part in self.old

    def __len__(self) -> int:
        return len(self.young) + len(self.old)

    def values(self, parts: list[str], learn) -> list[bytes]:
        """The value of every part; ``learn`` makes a dictionary of a list of unknown ones."""
        out = list(map(self.young.get, parts))
        missing = [i for i, x in enumerate(out) if x is None]
        if not missing:
            return out
        get, unknown, used = self.old.get, [], {}
        for i in missing:
            part = parts[i]
            value = out[i] = get(part)
            if value is None:
                unknown.append(part)
            else:
                used[part] = value
        if unknown:
            found = learn(unknown)
            for i in missing:
                if out[i] is None:
                    out[i] = found[parts[i]]
            used.update((k, found[k]) for k in unknown if len(k) <= self.longest)
        if len(self.young) + len(used) > self.size:
            self.old, self.young = self.young, {}
        if len(used) <= self.size:
            self.young.update(used)
        return out
