"""Product-quantised codes of vectors from Hilbert-sorted blocks, in exact integers.

1. Every component x becomes the integer floor(256 * x); a vector is cut into PARTS equal
   consecutive parts, and each part position has a codebook of at most ENTRIES entries, at
   first those parts of the vectors with the smallest ids.
2. A task gathers its vectors to chunks. In a chunk, each part position's points are sorted
   along a Hilbert curve and cut into flat blocks that keep their least and greatest
   corner (a box) and their sums. The chunks are written once; vectors never travel again.
3. In each round, the distances from a block's box to the entries give its shortlist: the
   entries whose least distance to the box is no more than the least of all entries'
   greatest distances. No other entry can be nearest to any point of the block. A block
   with one entry on its list gives its sums as they are; the others are settled by an
   exact integer kernel over their points and shortlists.
4. Tasks add up sums and counts per entry, and the driver divides them: PARTS * ENTRIES rows
   a round, whatever the number of vectors.

Ties go to the lower index: shortlists keep entries at equal distance, in index order.

Defined results: rows whose vector is null or holds null or non-finite components are left
out. The codebooks' width is that of the vector with the smallest id that PARTS divides;
vectors of another width (the empty one too) keep their row, with null code and error.
Equal ids are taken in the order of their vectors, null ids last; repeated rows are rows of
their own. An error or sum that a long cannot hold is null; sums pass over null errors.
Null labels are added up together. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import join_by_share, written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
#: Vectors of a chunk, and points of a block.
CHUNK, BLOCK = 32768, 16
#: Components below this keep every sum and distance of a chunk within 64 bits.
SMALL = 1 << 20
MOST = (1 << 63) - 1
#: Sums travel in limbs of so many bits, which millions of tasks can add up in a long.
LIMB = 40


def as_integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * values) of finite doubles, as int64, or as Python integers if some are large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    if not len(values) or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    # a double of 2 ** 53 or more is a whole number itself
    flat = [int(v) * SCALE if abs(v) >= 2.0 ** 53 else int(s) for v, s in zip(values.ravel().tolist(), scaled.ravel().tolist())]
    return np.array(flat, dtype=object).reshape(values.shape)


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Position of each point (n, d) on a Hilbert curve through the grid of their range."""
    n, d = points.shape
    bits = max(1, min(8, 62 // max(d, 1)))
    dims = min(d, 62 // bits)
    points = points[:, :dims]
    low, high = points.min(axis=0), points.max(axis=0)
    span = np.maximum(high - low, 1)
    x = [np.asarray((points[:, i] - low[i]) * ((1 << bits) - 1) // span[i], dtype=np.int64) for i in range(dims)]
    # fold every cell's orientation into its coordinates, from the coarsest bit on
    for level in range(bits - 1, 0, -1):
        bit, mask = 1 << level, (1 << level) - 1
        for i in range(dims):
            turned = (x[i] & bit) != 0
            swap = (x[0] ^ x[i]) & mask
            first = np.where(turned, x[0] ^ mask, x[0] ^ swap)
            if i:
                x[i] = np.where(turned, x[i], x[i] ^ swap)
            x[0] = first
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros(n, dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | (((x[i] ^ flip) >> level) & 1)
    return key


class Blocks:
    """One part position of a chunk: points in Hilbert order in blocks of BLOCK."""

    def __init__(self, points: np.ndarray, order: np.ndarray):
        n = len(points)
        self.order, self.n = order, n
        self.count = -(-n // BLOCK)
        # the last block is filled up with its last point; ``sizes`` knows
        padded = np.concatenate([order, np.repeat(order[-1:], self.count * BLOCK - n)])
        self.points = points[padded].reshape(self.count, BLOCK, -1)
        self.sizes = np.full(self.count, BLOCK, dtype=np.int64)
        self.sizes[-1] = n - (self.count - 1) * BLOCK
        self.real = np.arange(BLOCK)[None, :] < self.sizes[:, None]
        self.low, self.high = self.points.min(axis=1), self.points.max(axis=1)
        self.sums = np.where(self.real[:, :, None], self.points, 0).sum(axis=1)

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """Which entries (columns) can be nearest to some point of a block (rows)."""
        e = entries[None, :, :]
        low, high = self.low[:, None, :], self.high[:, None, :]
        outside = np.maximum(np.maximum(low - e, e - high), 0)
        least = (outside * outside).sum(axis=2)
        away = np.maximum(np.abs(e - low), np.abs(high - e))
        greatest = (away * away).sum(axis=2)
        return (least <= greatest.min(axis=1)[:, None]).astype(bool)

    def _groups(self, entries: np.ndarray):
        """(blocks, their shortlists as entry indexes) for each length of shortlist."""
        can = self.shortlists(entries)
        lengths = can.sum(axis=1)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            yield at, np.nonzero(can[at])[1].reshape(len(at), length)

    @staticmethod
    def _kernel(points: np.ndarray, lists: np.ndarray, entries: np.ndarray):
        """(best entry, its distance) of every point of blocks that share a shortlist length."""
        apart = points[:, :, None, :] - entries[lists][:, None, :, :]
        distances = (apart * apart).sum(axis=3)
        best = distances.argmin(axis=2)
        return np.take_along_axis(lists, best, axis=1), np.take_along_axis(distances, best[:, :, None], axis=2)[:, :, 0]

    def add_up(self, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add every point to the sums and counts of its nearest entry."""
        for at, lists in self._groups(entries):
            if lists.shape[1] == 1:
                np.add.at(sums, lists[:, 0], self.sums[at])
                np.add.at(counts, lists[:, 0], self.sizes[at])
                continue
            best, _ = self._kernel(self.points[at], lists, entries)
            real = self.real[at]
            np.add.at(sums, best[real], self.points[at][real])
            np.add.at(counts, best[real], 1)

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point's nearest entry, in the chunk's own order."""
        kind = np.result_type(self.points, entries)
        index = np.empty((self.count, BLOCK), dtype=np.int64)
        distance = np.empty((self.count, BLOCK), dtype=kind)
        for at, lists in self._groups(entries):
            index[at], distance[at] = self._kernel(self.points[at], lists, entries)
        out_index, out_distance = np.empty(self.n, dtype=np.int64), np.empty(self.n, dtype=kind)
        out_index[self.order] = index[self.real]
        out_distance[self.order] = distance[self.real]
        return out_index, out_distance


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, values (doubles) of the rows whose vector has finite components only."""
    values = F.col("embedding").cast("array<double>")
    fine = F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return embeddings.where(F.col("embedding").isNotNull() & fine).select("vec_id", "label", values.alias("values"))


CHUNKS = "vec_ids array<long>, labels array<int>, n int, points binary, orders binary, large boolean"


def chunks(vectors: DataFrame, width: int) -> DataFrame:
    """Chunks of vectors of ``width`` components: ids, labels, points and, for each part
    position, the order of its points along the Hilbert curve."""
    def chunk(ids, labels, values):
        points = as_integers(values)
        large = points.dtype == object
        per = width // PARTS
        orders = [np.argsort(hilbert_keys(points[:, p * per:(p + 1) * per]), kind="stable").astype(np.uint16) for p in range(PARTS)]
        # doubles are kept as such where their integers may not fit
        stored = values.tobytes() if large else points.astype(np.int32).tobytes()
        return [ids, labels, len(points), stored, np.concatenate(orders).tobytes(), large]

    def table(row):
        types = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary(), pa.bool_()]
        names = ["vec_ids", "labels", "n", "points", "orders", "large"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    def run(batches):
        ids, labels, held = [], [], []
        for b in batches:
            if not b.num_rows:
                continue
            ids += b["vec_id"].to_pylist()
            labels += b["label"].to_pylist()
            held.append(b["values"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width))
            while len(ids) >= CHUNK:
                values = np.concatenate(held)
                yield table(chunk(ids[:CHUNK], labels[:CHUNK], values[:CHUNK]))
                ids, labels, held = ids[CHUNK:], labels[CHUNK:], [values[CHUNK:]]
        if ids:
            yield table(chunk(ids, labels, np.concatenate(held)))

    return vectors.where(F.size("values") == width).select("vec_id", "label", "values").mapInArrow(run, CHUNKS)


def blocks_of(row: dict, width: int) -> list[Blocks]:
    """The part positions of a stored chunk."""
    n, per = row["n"], width // PARTS
    if row["large"]:
        points = as_integers(np.frombuffer(row["points"]).reshape(n, width))
    else:
        points = np.frombuffer(row["points"], dtype=np.int32).astype(np.int64).reshape(n, width)
    orders = np.frombuffer(row["orders"], dtype=np.uint16).reshape(PARTS, n)
    return [Blocks(points[:, p * per:(p + 1) * per], orders[p]) for p in range(PARTS)]


def as_array(entries: list[list[int]]) -> np.ndarray:
    """Codebook entries as int64 if they are small, else as Python integers."""
    small = all(abs(x) < SMALL for e in entries for x in e)
    return np.array(entries, dtype=np.int64 if small else object).reshape(len(entries), -1)


def limbs(x: int) -> list[int]:
    """An integer of any size as limbs of LIMB bits, the last one signed."""
    out = []
    while not -(1 << LIMB) < x < 1 << LIMB:
        out.append(x & ((1 << LIMB) - 1))
        x >>= LIMB
    return [*out, x]


def first_codebooks(vectors: DataFrame) -> list[list[list[int]]]:
    """Per part position, the parts of the vectors with the smallest ids; empty without vectors."""
    usable = vectors.where((F.size("values") > 0) & (F.size("values") % PARTS == 0))
    order = [F.col("vec_id").asc_nulls_last(), "values"]
    first = usable.orderBy(*order).select(F.size("values").alias("width")).first()
    if first is None:
        return []
    width, per = first["width"], first["width"] // PARTS
    rows = usable.where(F.size("values") == width).orderBy(*order).limit(ENTRIES).select("values").collect()
    points = [as_integers(np.array([r["values"]])).tolist()[0] for r in rows]
    return [[[int(x) for x in v[p * per:(p + 1) * per]] for v in points] for p in range(PARTS)]


def next_codebooks(stored: DataFrame, books: list[list[list[int]]]) -> list[list[list[int]]]:
    """The codebooks after one round over the chunks."""
    per, width = len(books[0][0]), len(books[0][0]) * PARTS

    def run(batches):
        sums = [[[0] * per for _ in books[0]] for _ in range(PARTS)]
        counts = [[0] * len(books[0]) for _ in range(PARTS)]
        arrays = [as_array(b) for b in books]
        for batch in batches:
            for row in batch.to_pylist():
                for p, blocks in enumerate(blocks_of(row, width)):
                    exact = blocks.points.dtype == object or arrays[p].dtype == object
                    s = np.zeros(arrays[p].shape, dtype=object if exact else np.int64)
                    c = np.zeros(len(arrays[p]), dtype=np.int64)
                    blocks.add_up(arrays[p], s, c)
                    for k in np.flatnonzero(c).tolist():
                        counts[p][k] += int(c[k])
                        sums[p][k] = [x + int(y) for x, y in zip(sums[p][k], s[k])]
        found = [(p * ENTRIES + k, i, place, n if place == 0 else 0, limb)
                 for p in range(PARTS) for k, n in enumerate(counts[p]) if n
                 for i, x in enumerate(sums[p][k]) for place, limb in enumerate(limbs(x))]
        if found:
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), types)], ["entry", "i", "place", "n", "limb"])

    partial = stored.select("n", "points", "orders", "large").mapInArrow(run, "entry int, i int, place int, n long, limb long")
    total = partial.groupBy("entry", "i", "place").agg(F.sum("n").alias("n"), F.sum("limb").alias("limb"))
    found: dict[tuple[int, int], list[int]] = {}
    for r in total.collect():
        x = found.setdefault((r["entry"], r["i"]), [0, 0])
        x[0], x[1] = x[0] + (r["limb"] << LIMB * r["place"]), x[1] + r["n"]
    out = [[list(e) for e in b] for b in books]
    for (entry, i), (x, n) in found.items():
        out[entry // ENTRIES][entry % ENTRIES][i] = x // n
    return out


def codes(stored: DataFrame, books: list[list[list[int]]]) -> DataFrame:
    """vec_id, label, code and error of every vector of the chunks."""
    width = len(books[0][0]) * PARTS

    def run(batches):
        arrays = [as_array(b) for b in books]
        for batch in batches:
            for row in batch.to_pylist():
                found = [b.assign(a) for b, a in zip(blocks_of(row, width), arrays)]
                digits = np.stack([i for i, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                # Python integers where one part's distances need them
                exact = [d.astype(object) if any(x.dtype == object for _, x in found) else d for _, d in found]
                errors = [e if e <= MOST else None for e in sum(exact[1:], exact[0]).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["vec_ids"], pa.int64()), pa.array(row["labels"], pa.int32()),
                     pa.array([digits[k:k + 2 * PARTS] for k in range(0, len(digits), 2 * PARTS)]), pa.array(errors, pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return stored.mapInArrow(run, "vec_id long, label int, code string, error long")


def codebooks_digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with the error summed over rows of an equal label, nulls together."""
    sums = rows.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("__n"))
    return join_by_share(rows, written(sums, "label_errors"), ["label"], rows.count())


def quantise(embeddings: DataFrame) -> tuple[DataFrame, list[list[list[int]]]]:
    """(vec_id, label, code, error of every kept vector; the final codebooks)."""
    vectors = kept_vectors(embeddings)
    books = first_codebooks(vectors)
    if not books:
        return vectors.select("vec_id", F.col("label").cast("int"), F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), books
    width = len(books[0][0]) * PARTS
    stored = written(chunks(vectors.select("vec_id", F.col("label").cast("int"), "values"), width), "vector_chunks")
    for _ in range(ROUNDS):
        books = next_codebooks(stored, books)
    other = vectors.where(F.size("values") != width).select(
        "vec_id", F.col("label").cast("int"), F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return written(codes(stored, books).unionByName(other), "vector_codes"), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code, error and the error of its label for every kept vector."""
    rows, books = quantise(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_errors(rows).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
