"""Token ids in bit-packed binary files.

A file holds the documents of one shard in ascending order. Every id takes the bits that
the vocabulary needs, so block b of BLOCK ids has a known place, and numpy unpacks a
block with a few shifts. Layout, all numbers little-endian:

    payload   blocks of packed ids; 64 ids make ``width`` words of 64 bits, the last
              block is filled up with zeros to the next multiple of 64 ids
    offsets   u64 for each block: where it begins in the file
    starts    u64 for each document and one more: its first id, counted in the file
    doc ids   i64 for each document, then one byte each: 1 if the id is null
    trailer   u64 ids, u64 documents, u64 place of the offsets, u32 ids a block,
              u32 width, 8 bytes magic

Files are written under another name and renamed, so a task that runs twice or is lost
leaves whole files only.

Defined results: null and empty texts have the end id alone; rows with equal ids stand
together, ordered by a hash of the text; null ids come first; an empty table gives no
files and no rows. Only the named columns are read.
"""

from __future__ import annotations

import os
import random
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, remembers, written
from cartwheel.llm.ragged import GROUP_BYTES, Memory, bytes_of, codes_of, cut_at, groups, put_together
from cartwheel.session import local_path, scratch_path

BLOCK = 4096
MAGIC = b"bitpack1"
TRAILER = struct.Struct("<QQQII8s")
END_ID = 1
#: Bytes of text in a shard, about.
SHARD_BYTES = 32 << 20
#: Blocks that a reader holds at a time.
READ_BLOCKS = 256


def bit_width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """64 ids to ``width`` 64-bit words, lowest bits first."""
    groups = np.zeros((-(-len(ids) // 64), 64), dtype=np.uint64)
    groups.reshape(-1)[:len(ids)] = ids
    out = np.zeros((len(groups), width), dtype="<u8")
    for k in range(64):
        word, shift = divmod(k * width, 64)
        out[:, word] |= groups[:, k] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= groups[:, k] >> np.uint64(64 - shift)
    return out.tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed data."""
    words = np.frombuffer(data, dtype="<u8").reshape(-1, width)
    out = np.empty((len(words), 64), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, k] = value & mask
    return out.reshape(-1)[:count]


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder that all tasks share, and the path in it."""
    if path.startswith("file:") or "://" not in path:
        return pa.fs.LocalFileSystem(), local_path(path)
    return pa.fs.FileSystem.from_uri(path)


class TokenWriter:
    """Writes one file; holds one block and the places of the documents."""

    def __init__(self, stream, width: int, block: int = BLOCK):
        if block % 64:
            raise ValueError("a block is a multiple of 64 ids")
        self.stream, self.width, self.block = stream, width, block
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = self.at = 0
        self.offsets: list[int] = []
        self.starts = [0]
        self.doc_ids: list[int | None] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.width:
            raise ValueError("an id does not fit the vocabulary's bits")
        self.doc_ids.append(doc_id)
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        self.starts.append(self.ids)
        if self.held >= 64 * self.block:
            self.flush(final=False)

    def flush(self, final: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, dtype=np.uint32)
        whole = len(ids) if final else len(ids) // self.block * self.block
        for start in range(0, whole, self.block):
            data = pack(ids[start:min(whole, start + self.block)], self.width)
            self.offsets.append(self.at)
            self.stream.write(data)
            self.at += len(data)
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self.flush(final=True)
        self.stream.write(np.array(self.offsets, dtype="<u8").tobytes())
        self.stream.write(np.array(self.starts, dtype="<u8").tobytes())
        self.stream.write(np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes())
        self.stream.write(bytes(d is None for d in self.doc_ids))
        self.stream.write(TRAILER.pack(self.ids, len(self.doc_ids), self.at, self.block, self.width, MAGIC))
        self.stream.close()


class TokenFile:
    """Random access to one file: reads the blocks that are asked for."""

    def __init__(self, path: str):
        fs, inner = filesystem(path)
        self.stream = fs.open_input_file(inner)
        size = self.stream.size()
        self.ids_count, docs, place, self.block, self.width, magic = TRAILER.unpack(
            self.stream.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {path}")
        blocks = -(-self.ids_count // self.block)
        tail = self.stream.read_at(size - TRAILER.size - place, place)
        self.offsets = np.append(np.frombuffer(tail, "<u8", blocks), np.uint64(place)).astype(np.int64)
        self.starts = np.frombuffer(tail, "<u8", docs + 1, 8 * blocks).astype(np.int64)
        self.doc_ids = np.frombuffer(tail, "<i8", docs, 8 * (blocks + docs + 1))
        self.null_ids = np.frombuffer(tail, np.bool_, docs, 8 * (blocks + 2 * docs + 1))

    def __len__(self) -> int:
        return self.ids_count

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end) of the file."""
        if end <= start:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        data = self.stream.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        low = first * self.block
        return unpack(data, self.width, min(self.ids_count, (last + 1) * self.block) - low)[start - low:end - low]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def checksums(self) -> Iterator[tuple[int, int]]:
        """(ids, crc32 of the ids as little-endian u32) of every document, read in order."""
        crc = doc = 0
        for low in range(0, self.ids_count, READ_BLOCKS * self.block):
            high = min(self.ids_count, low + READ_BLOCKS * self.block)
            ids = self.ids(low, high).astype("<u4")
            at = low
            while at < high:
                end = min(high, int(self.starts[doc + 1]))
                crc = zlib.crc32(ids[at - low:end - low], crc)
                at = end
                if end == self.starts[doc + 1]:
                    yield int(end - self.starts[doc]), crc
                    crc, doc = 0, doc + 1

    def close(self) -> None:
        self.stream.close()


# Classes of bytes: blanks end words; signs after a Latin letter, up to the word's end, are a
# part of their own; A-Z are read as a-z.
_BLANK, _SIGN = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_BLANK[[ord(" "), ord("\n")]] = True
_SIGN[list(b".,;:!?#$%&*")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the parts of texts (UTF-8 bytes, n + 1 offsets) begin: blanks, words, and the signs
    at the end of a word behind a Latin letter."""
    n = len(data)
    text_start = np.zeros(n + 1, dtype=bool)
    text_start[offsets] = True
    blank, sign = _BLANK[data], _SIGN[data]
    first = text_start[:n].copy()
    first[1:] |= blank[1:] != blank[:-1]
    # the last byte of a Latin letter: ASCII, or the second of U+00C0 to U+00FF but × and ÷
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    after = np.flatnonzero(sign[1:] & letter[:-1]) + 1
    after = after[~text_start[after]]
    # the signs go on to the end of the word
    other = np.flatnonzero(~sign | text_start[:n])
    k = np.searchsorted(other, after, side="right")
    end = np.append(other, n)[k]
    whole = (end == n) | text_start[end] | np.append(blank, True)[end]
    first[after[whole]] = True
    return np.flatnonzero(first)


class WordEncoder:
    """Encodes texts part by part with the tokenizers library, remembering the parts.

    The tokenizer drops white space, reads capitals as small letters and never joins what is
    parted here, so the ids of a text are those of its parts, one after the other. Where a
    special string may stand, capitals are left to the tokenizer.
    """

    REMEMBER = 800_000
    LONG = 64

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if self.vocabulary > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.check()
        self.known = Memory(self.REMEMBER, self.LONG)

    #: What the texts of the check are made of.
    SIGNS = "abzABZ019 \n\t.,;:!?#$%&*'\"-_()[]<|>/\\@éßñØ×÷ığ東ё😀\u00a0\u200b"

    def check(self) -> None:
        """The parts of this tokenizer must be those that are cut here: on given and drawn texts."""
        draw = random.Random(49)
        texts = ["a b", "a\nb", " a", "ab, c", "it's. x", "a1.b", "é, ab### c", "<|endoftext|>", "A<|endoftext|>. b", "ÉA. Aé,"]
        texts += ["".join(draw.choices(self.SIGNS, k=draw.randrange(1, 24))) for _ in range(400)]
        self.known = Memory(0, 0)
        ids, ends = self.encode_group(pa.array(texts))
        for text, start, end in zip(texts, [0, *ends.tolist()], ends.tolist()):
            if self.tokenizer.encode(text, add_special_tokens=False).ids != ids[start:end].tolist():
                raise ValueError("this tokenizer does not work part by part")

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        found = {}
        for start in range(0, len(parts), 4096):
            some = parts[start:start + 4096]
            # one encoding of many parts, each by itself, and the part of every id
            e = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids, cuts = np.array(e.ids, dtype="<u2").tobytes(), 2 * np.searchsorted(e.word_ids, np.arange(len(some) + 1))
            found.update((p, ids[a:b]) for p, a, b in zip(some, cuts.tolist(), cuts[1:].tolist()))
        return found

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """Ids of every text with the end id behind them."""
        end = np.array([end_id], dtype="<u2")
        for group in groups(pc.fill_null(texts, "")):
            if pc.binary_length(group[0]).as_py() > GROUP_BYTES:
                yield np.concatenate([*(self.encode_group(p)[0] for p in at_blanks(group[0].as_py())), end])
                continue
            ids, ends = self.encode_group(group)
            start = 0
            for e in ends.tolist():
                yield np.concatenate([ids[start:e], end])
                start = e

    def encode_group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text among them)."""
        data, offsets = bytes_of(texts)
        if not len(data):
            return np.zeros(0, dtype="<u2"), np.zeros(len(texts), dtype=np.int64)
        starts = part_starts(data, offsets)
        if not ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():
            data = _LOWER[data]
        parts, codes = codes_of(cut_at(data, starts))
        return put_together(self.known.values(parts, self.learn), "<u2", codes, np.diff(np.searchsorted(starts, offsets)))


def at_blanks(text: str, size: int = GROUP_BYTES) -> Iterator[pa.Array]:
    """A long text in pieces of about ``size`` characters, parted at blanks."""
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):
            found = re.compile("[ \n]").search(text, end)
            end = found.start() if found else len(text)
        yield pa.array([text[start:end]])
        start = end


@remembers
@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder, with its memory, per Python worker."""
    return WordEncoder(path)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all documents in ascending order of doc_id; returns shard, path, n_docs, n_ids."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def write(batches):
        encoder = word_encoder(tokenizer)
        number, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        fs, inner = filesystem(folder)
        name, partial = f"{inner}/shard-{number:06d}.ids", f"{inner}/.partial-{number:06d}-{attempt}"
        writer = None
        for b in batches:
            if writer is None and b.num_rows:
                fs.create_dir(inner, recursive=True)
                writer = TokenWriter(fs.open_output_stream(partial), bit_width(encoder.vocabulary))
            for doc_id, ids in zip(b["doc_id"].to_pylist(), encoder.encode(b["text"], end_id)):
                writer.add(doc_id, ids)
        if writer is not None:
            writer.close()
            fs.move(partial, name)
            yield pa.RecordBatch.from_pydict({
                "shard": [number], "path": [f"{folder}/shard-{number:06d}.ids"],
                "n_docs": [len(writer.doc_ids)], "n_ids": [writer.ids]})

    return written(rows.mapInArrow(write, "shard long, path string, n_docs long, n_ids long"), "token_manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    # one small row per file: its ids before it are summed in one task
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    count = manifest.count()

    def read(batches):
        for b in batches:
            for path, base in zip(b["path"].to_pylist(), b["base"].to_pylist()):
                f = TokenFile(path)
                sums = list(f.checksums())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids, pa.int64(), mask=f.null_ids), pa.array(f.starts[:-1] + base, pa.int64()),
                     pa.array([n for n, _ in sums], pa.int64()), pa.array([c for _, c in sums], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])
                f.close()

    return files.select("path", "base").repartition(max(1, count)).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ids in packed files, and what the files hold."""
    folder = scratch_path(spark, "llm", "token_files")
    return read_tokens(write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json")))
