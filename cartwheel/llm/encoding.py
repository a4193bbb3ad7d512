"""SentencePiece encoding and decoding; giant documents as a max-plus parallel scan.

Texts are cut into chunks of CHUNK characters, wherever that falls. A state at a border
is a piece that covers the character before it. For every chunk, on its own, a matrix
says which state at its end can be reached from which state at its start, at what value
(minus the tokens spent at its two ends; minus infinity: not at all). Matrices of neighbouring chunks
combine by max-plus products, which are associative: blocks of BLOCK neighbouring chunks are
combined each by itself, a scan over a text's blocks fixes the states at their borders, those
are handed down to the borders inside, all blocks at once, and then every chunk is traced
back by itself between its two states.

A step from piece to piece is open only if the model allows the two side by side (see
``pieces.py``), so the one path through a text is exactly the library's encoding.

Inside a chunk only its first and last segment depend on the borders. What lies between
costs every path the same, so it is left out of the matrix and worked out when tracing.

Defined results: null and empty texts have no tokens and decode to the empty text; a
literal U+2581 is encoded as, and decodes to, a blank, as in the library; special
strings are ordinary text; repeated rows are encoded each, also with equal ids. Columns
other than the text are passed through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, remembers, written
from cartwheel.llm.pieces import BYTES, SPACE, PieceModel, piece_model
from cartwheel.llm.ragged import Memory, bytes_of, codes_of, cut_at, groups, put_together

CHUNK = 32_768
#: Neighbouring chunks whose matrices one task combines.
BLOCK = 32
#: Chunks that a task works on together.
CHUNK_GROUP = 16
#: Rows that are decoded together.
DECODED = 256
#: A piece occurrence: first character and the one after the last, counted in the text.
State = tuple[int, int]
NOTHING = -np.inf


def normal(text: str | None) -> str:
    """The text as the model sees it: blanks as ``SPACE``, one more at the start."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def plain(texts: pa.Array) -> pa.Array:
    """The same for a column, with plain blanks (``Encoder`` takes those)."""
    texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(" ", texts, ""))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus matrix product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


class Chunk:
    """Characters [low, high) of a normal text of ``length`` characters, seen through a
    window that starts at ``origin`` and reaches a longest piece beyond both borders."""

    def __init__(self, encoder: Encoder, window: str, origin: int, low: int, high: int, length: int):
        self.encoder, self.model = encoder, encoder.model
        self.window, self.origin, self.low, self.high, self.length = window, origin, low, high, length
        self.first, self.last = self.states(low), self.states(high)
        # borders of segments inside the chunk: what is left of one does not matter to its right
        ends = [m.end() + low for m in self.model.segments.finditer(self.cut(low, high).replace(SPACE, " "))]
        inner = [p for p in ends if low < p < high and self.breaks(p)]
        self.head, self.tail = (inner[0], inner[-1]) if inner else (None, None)

    def cut(self, start: int, end: int) -> str:
        return self.window[start - self.origin:end - self.origin]

    def breaks(self, p: int) -> bool:
        """Whether a segment of the whole text ends at p (a cut segment may seem to)."""
        pair = self.cut(p - 1, p + 1).replace(SPACE, " ")
        return self.model.segments.fullmatch(pair) is None

    def piece(self, start: int, end: int) -> int | None:
        found = self.model.id_of.get(self.cut(start, end))
        return BYTES if found is None and end == start + 1 else found

    def states(self, border: int) -> list[State]:
        """Every piece that covers the character before the border; one state at the ends."""
        if border == 0 or border == self.length:
            return [(border, border)]
        reach = self.model.longest
        return [(s, e) for s in range(max(0, border - reach), border)
                for e in range(border, min(self.length, s + reach) + 1) if self.piece(s, e) is not None]

    def paths(self, starts: list[State], end: int) -> dict[State, dict[int, tuple[float, State | None]]]:
        """Best value and step before, from every start (by number), of each piece that
        follows and begins before ``end``."""
        nodes: dict[State, dict[int, tuple[float, State | None]]] = {}
        by_end: dict[int, list[State]] = {}
        for k, s in enumerate(starts):
            if s not in nodes:
                by_end.setdefault(s[1], []).append(s)
            nodes.setdefault(s, {})[k] = (0.0, None)
        for p in range(min(s[1] for s in starts), end):
            for node in by_end.get(p, ()):
                left = BYTES if node[0] == node[1] else self.piece(*node)
                for q in range(p + 1, min(self.length, p + self.model.longest) + 1):
                    right = self.piece(p, q)
                    if right is None or not self.model.follows(left, right):
                        continue
                    if (p, q) not in nodes:
                        by_end.setdefault(q, []).append((p, q))
                    into = nodes.setdefault((p, q), {})
                    for k, (value, _) in nodes[node].items():
                        if value - 1 > into.get(k, (NOTHING,))[0]:
                            into[k] = (value - 1, node)
        return nodes

    def values(self, starts: list[State], end: int, ends: list[State]) -> np.ndarray:
        nodes = self.paths(starts, end)
        out = np.full((len(starts), len(ends)), NOTHING)
        for j, e in enumerate(ends):
            for k, (value, _) in nodes.get(e, {}).items():
                out[k, j] = value
        return out

    def ending_at(self, p: int) -> list[State]:
        """Pieces that end exactly at a break."""
        return [(s, p) for s in range(max(0, p - self.model.longest), p) if self.piece(s, p) is not None]

    def matrix(self) -> np.ndarray:
        ends = [(self.length, self.length)] if self.high == self.length else self.last
        if self.head is None:
            return self.to_end(self.first, self.low)
        heads = self.ending_at(self.head)
        to_head = self.values(self.first, self.head, heads).max(axis=1, initial=NOTHING)
        from_tail = self.to_end([(self.tail, self.tail)], self.tail)
        return to_head[:, None] + from_tail[0][None, :len(ends)]

    def to_end(self, starts: list[State], low: int) -> np.ndarray:
        """Values from states to the states at the chunk's end."""
        if self.high < self.length:
            return self.values(starts, self.high, self.last)
        lasts = self.ending_at(self.length)
        return self.values(starts, self.length, lasts).max(axis=1, initial=NOTHING)[:, None]

    def back(self, starts: list[State], end: int, goals: list[State]) -> list[State]:
        """The best path from the start to one of the goals, without the start."""
        nodes = self.paths(starts, end)
        goal = max((g for g in goals if 0 in nodes.get(g, {})), key=lambda g: nodes[g][0][0])
        path: list[State] = []
        step: State | None = goal
        while step is not None and nodes[step][0][1] is not None:
            path.append(step)
            step = nodes[step][0][1]
        return path[::-1]

    def trace(self, i: int, j: int) -> np.ndarray:
        """Ids of the pieces that begin in the chunk, between its states i and j."""
        goals = [self.last[j]] if self.high < self.length else self.ending_at(self.length)
        if self.head is None:
            return self.ids(self.back([self.first[i]], self.high, goals))
        head = self.back([self.first[i]], self.head, self.ending_at(self.head))
        tail = self.back([(self.tail, self.tail)], self.high, goals)
        return np.concatenate([self.ids(head), self.encoder.ids_between(self, self.head, self.tail), self.ids(tail)])

    def ids(self, path: list[State]) -> np.ndarray:
        out: list[int] = []
        for s, e in path:
            piece = self.piece(s, e)
            out += [self.model.byte_id[b] for b in self.cut(s, e).encode()] if piece == BYTES else [piece]
        return np.array(out, dtype=np.int32)


# Classes of characters that part the usual segments (PieceModel.segments), by their UTF-8
# bytes: blank, line end, Latin letter, anything else.
_BLANK, _LINE, _LATIN, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[ord(" ")], _CLASS[ord("\n")] = _BLANK, _LINE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LATIN


def segment_starts(data: np.ndarray) -> np.ndarray:
    """Whether a segment of the usual kind starts at each byte of UTF-8 text; blanks stand
    before what follows them, except before a line end."""
    n = len(data)
    kind = _CLASS[data]
    # U+00C0 to U+024F but U+00D7 and U+00F7 are Latin letters, of two bytes
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
    if len(lead):
        following = data[np.minimum(lead + 1, n - 1)]
        first = data[lead]
        latin = ~((first == 0xC3) & ((following == 0x97) | (following == 0xB7))) & ~((first == 0xC9) & (following > 0x8F))
        lead = lead[latin]
        kind[lead] = kind[np.minimum(lead + 1, n - 1)] = _LATIN
    before = kind[:-1]
    out = np.ones(n, dtype=bool)
    out[1:] = ((kind[1:] != before) & ((before != _BLANK) | (kind[1:] == _LINE))) | ((kind[1:] == _LINE) & (before == _LINE))
    return out


class Encoder:
    """Encodes texts, remembering the segments of earlier ones."""

    REMEMBER = 100_000
    SHORT = 48

    def __init__(self, model: PieceModel):
        self.model = model
        self.known = Memory(self.REMEMBER, self.SHORT)

    def learn(self, segments: list[str]) -> dict[str, bytes]:
        """Ids (int32) of distinct segments, with plain blanks."""
        found = {}
        for s, _, last, size in self.model.prefixes(sorted(x.replace(" ", SPACE) for x in segments)):
            found[s.replace(SPACE, " ")] = np.array(self.model.back(s, last, size), dtype=np.int32).tobytes()
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, end of each text among them) of texts with plain blanks, without nulls, that
        begin and end at segment borders."""
        data, offsets = bytes_of(texts)
        n = len(data)
        if not n:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        inside = offsets[offsets < n]
        if self.model.crossing:  # whole texts
            starts = np.unique(inside)
        else:
            first = segment_starts(data)
            first[inside] = True
            starts = np.flatnonzero(first)
        segments, codes = codes_of(cut_at(data, starts))
        parts = np.diff(np.searchsorted(starts, offsets))
        return put_together(self.known.values(segments, self.learn), "<i4", codes, parts)

    def ids_between(self, chunk: Chunk, start: int, end: int) -> np.ndarray:
        return self.encode(pa.array([chunk.cut(start, end).replace(SPACE, " ")]))[0]

    def chunk(self, text: str, number: int, size: int = CHUNK) -> Chunk:
        """A chunk of a whole normal text (tests; tasks get windows instead)."""
        low, high = number * size, min(len(text), (number + 1) * size)
        window, origin = cut_window(text, low, high, self.model.longest)
        return Chunk(self, window, origin, low, high, len(text))


@remembers
@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """One encoder, with its memory, per Python worker, whatever the number of tasks."""
    return Encoder(piece_model(path))


def cut_window(text: str, low: int, high: int, reach: int) -> tuple[str, int]:
    origin = max(0, low - reach)
    return text[origin:high + reach], origin


def states_of_best_path(matrices: list[np.ndarray]) -> list[int]:
    """The state at every border of the best path through the chunks' matrices."""
    before = [np.zeros((1, 1))]
    for m in matrices:
        before.append(product(before[-1], m))
    after = [np.zeros((1, 1))]
    for m in reversed(matrices):
        after.append(product(m, after[-1]))
    after.reverse()
    # a border's state is where the best value before it and the best after it add up to most
    return [int((b[0] + a[:, 0]).argmax()) for b, a in zip(before, after)]


def combined(matrices: list[np.ndarray]) -> np.ndarray:
    """One matrix for several neighbouring chunks."""
    return reduce(product, matrices)


def states_inside(matrices: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """The states at the borders of a block of chunks, from ``enter`` to ``leave``."""
    inside = [matrices[0][enter:enter + 1], *matrices[1:]]
    inside[-1] = inside[-1][:, leave:leave + 1]
    return [enter, *states_of_best_path(inside)[1:-1], leave]


class Decoder:
    """Ids to text: pieces with blanks for ``SPACE``, bytes joined and read as UTF-8."""

    def __init__(self, model: PieceModel):
        single = {i: bytes([byte]) for byte, i in model.byte_id.items()}
        pieces = [single.get(i) or x.replace(SPACE, " ").encode() for i, x in enumerate(model.text_of)]
        self.sizes = np.array([len(x) for x in pieces], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of the ids as UTF-8. Bytes that are none are replaced as the library does."""
        if not len(ids):
            return b""
        n = self.sizes[ids]
        ends = np.cumsum(n)
        # the blank that encoding put before the text is left out
        out = self.flat[np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - n), n)].tobytes()
        try:
            out.decode()
        except UnicodeDecodeError:
            out = out.decode("utf-8", "replace").encode()
        return out[1:]


def id_lists(rows: list[np.ndarray]) -> pa.ListArray:
    """One list of ids for each row."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def encode_documents(docs: DataFrame, model_path: str, into: str = "token_ids", chunk: int = CHUNK,
                     block: int = BLOCK) -> DataFrame:
    """The columns of ``docs`` with the ids of the column ``text``.

    A text of one chunk is its own scan and is encoded where it is. The chunks of longer
    texts are written once, spread over tasks, and joined again by text.
    """
    at = docs.columns.index("text")
    schema = docs.select("*", F.array(F.lit(0)).alias(into)).schema
    length = F.coalesce(F.length("text"), F.lit(0))

    def whole(batches):
        encoder = shared_encoder(model_path)
        for b in batches:
            start = 0
            for texts in groups(b.column(at), 1 << 20):
                part = b.slice(start, len(texts))
                start += len(texts)
                ids, ends = encoder.encode(plain(texts))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, into])

    # SPACE comes before a text: it makes one character more
    short = docs.where(length < chunk).mapInArrow(whole, schema)

    giants = docs.where(length >= chunk).withColumn("__row", F.monotonically_increasing_id())
    giants = written(giants, "giant_documents")
    columns = "__row long, number int, low long, high long, length long, origin long, window string"

    def cut(batches):
        reach = piece_model(model_path).longest
        for b in batches:
            for row, text in zip(b["__row"].to_pylist(), b["text"].to_pylist()):
                text = normal(text)
                for number, low in enumerate(range(0, len(text), chunk)):
                    high = min(len(text), low + chunk)
                    window, origin = cut_window(text, low, high, reach)
                    yield pa.RecordBatch.from_pydict({
                        "__row": [row], "number": pa.array([number], pa.int32()), "low": [low], "high": [high],
                        "length": [len(text)], "origin": [origin], "window": [window]})

    # few rows of like size: dealt out evenly, then written for the two passes over them
    chunks = written(giants.select("__row", "text").mapInArrow(cut, columns)
                     .repartition(F.col("__row"), F.col("number")), "text_chunks")

    def opened(batches):
        """Few chunks at a time, with the rows that they come from."""
        encoder = shared_encoder(model_path)
        for b in batches:
            for start in range(0, b.num_rows, CHUNK_GROUP):
                yield [(r, Chunk(encoder, r["window"], r["origin"], r["low"], r["high"], r["length"]))
                       for r in b.slice(start, CHUNK_GROUP).to_pylist()]

    def keys(group):
        return [pa.array([r["__row"] for r, _ in group], pa.int64()), pa.array([r["number"] for r, _ in group], pa.int32())]

    def transfer(batches):
        for group in opened(batches):
            found = [c.matrix() for _, c in group]
            yield pa.RecordBatch.from_arrays(
                [*keys(group), pa.array([m.shape[0] for m in found], pa.int32()),
                 pa.array([m.astype(np.float64).tobytes() for m in found], pa.binary())],
                ["__row", "number", "rows", "matrix"])

    def matrices(pdf: pd.DataFrame) -> list[np.ndarray]:
        return [np.frombuffer(m).reshape(n, -1) for m, n in zip(pdf["matrix"], pdf["rows"])]

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        m = combined(matrices(pdf.sort_values("number")))
        return pd.DataFrame({"__row": pdf["__row"].iloc[:1], "block": pdf["block"].iloc[0], "rows": m.shape[0],
                             "matrix": [np.ascontiguousarray(m).tobytes()]})

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        found = states_of_best_path(matrices(pdf))
        return pd.DataFrame({"__row": pdf["__row"], "block": pdf["block"], "enter": found[:-1], "leave": found[1:]})

    def down(chunks_pdf: pd.DataFrame, border: pd.DataFrame) -> pd.DataFrame:
        pdf = chunks_pdf.sort_values("number")
        found = states_inside(matrices(pdf), int(border["enter"].iloc[0]), int(border["leave"].iloc[0]))
        return pd.DataFrame({"__row": pdf["__row"], "number": pdf["number"], "enter": found[:-1], "leave": found[1:]})

    # up: blocks of neighbouring chunks to one matrix each; a scan over a text's few blocks; and
    # down again to the borders inside each block, all blocks at once
    transfers = written(chunks.mapInArrow(transfer, "__row long, number int, rows int, matrix binary").withColumn(
        "block", F.floor(F.col("number") / block).cast("int")), "transfer_matrices")
    borders = (transfers.groupBy("__row", "block").applyInPandas(combine, "__row long, block int, rows int, matrix binary")
               .groupBy("__row").applyInPandas(scan, "__row long, block int, enter int, leave int"))
    states = transfers.groupBy("__row", "block").cogroup(borders.groupBy("__row", "block")).applyInPandas(
        down, "__row long, number int, enter int, leave int")

    def trace(batches):
        for group in opened(batches):
            yield pa.RecordBatch.from_arrays(
                [*keys(group), id_lists([c.trace(r["enter"], r["leave"]) for r, c in group])], ["__row", "number", "ids"])

    ids = (chunks.join(states, ["__row", "number"]).mapInArrow(trace, "__row long, number int, ids array<int>")
           .groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("number", "ids"))).alias("parts"))
           .select("__row", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("__ids")))
    long = giants.join(ids, "__row").select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__ids").alias(into))
    return short.unionByName(long)


def id_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """The ids of every row, one row at a time."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    end = 0
    for size in column.value_lengths().to_numpy(zero_copy_only=False):
        start, end = end, end + int(size)
        yield flat[start:end]


def slices(batches: Iterator[pa.RecordBatch], rows: int = DECODED) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, whose texts are held more than once."""
    for b in batches:
        for start in range(0, b.num_rows, rows):
            yield b.slice(start, rows)


def decode_documents(encoded: DataFrame, model_path: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """Add the text that the ids stand for."""
    at = encoded.columns.index(ids)
    schema = encoded.select("*", F.lit("").alias(into)).schema

    def run(batches):
        decoder = Decoder(piece_model(model_path))
        for b in slices(batches):
            texts = pa.array([decoder.decode(x) for x in id_rows(b.column(at))], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, into])

    return encoded.mapInArrow(run, schema)


def digest(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_chars and whether the text came back, from
    rows of doc_id, text and token_ids. Decoded texts stay in the task."""
    def run(batches):
        decoder = Decoder(piece_model(model_path))
        for b in slices(batches):
            out: list[list] = [[], [], [], []]
            spaced = pc.replace_substring(pc.fill_null(b["text"], ""), SPACE, " ").cast(pa.binary())
            for text, ids in zip(spaced, id_rows(b["token_ids"])):
                decoded = decoder.decode(ids)
                # characters are the bytes that do not go on with one
                chars = int((np.frombuffer(decoded, dtype=np.int8) >= -64).sum())
                for c, v in zip(out, (len(ids), zlib.crc32(ids.astype("<u4").tobytes()), chars, text.as_py() == decoded)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.bool_())],
                ["doc_id", "n_tokens", "ids_crc32", "decoded_chars", "round_trip"])

    return encoded.select("doc_id", "text", "token_ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, decoded_chars long, round_trip boolean")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, decoded again, and the digest of both."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return digest(encode_documents(docs, path), path)
