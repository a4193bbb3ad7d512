"""Jaccard join of texts as a blocked sparse product of the document by n-gram incidence.

No link is lost. Texts with equal sets of word n-grams form a class, a row of the incidence
matrix.

1. The n-grams of the first 3/8 of the hash space are counted over all texts. Of these, the
   commonest, at most HOT of them, are taken from the matrix last (by the power of two of
   their count, then by hash), the others by hash; that order is the same everywhere. Two
   sets that link share one of their first s - ceil(PERCENT * s / 100) + 1 n-grams in this
   order, s being the size: these first columns are the product's operands.
2. Blocks of columns are multiplied in tasks: classes that share a column of at most FEW
   classes get a partial count, and partial counts are added up over the blocks. A pair goes
   on if its sizes are close enough and its count can still be filled up to the overlap that
   its sizes demand by what lies beyond the first columns and in columns of more classes.
3. In a column of more than FEW classes, every class is paired with the least one, its hub.
4. Pairs are decided on their whole sets, first every class with its likeliest partner, then
   the pairs whose classes are not in one component by then.
5. All classes that share a column with a hub form a group. Groups that still hold several
   components are multiplied as blocks of rows over all their columns: a block gives links
   between components, one for each two components that it joins, and never its pairs. A
   group beyond a block's size is cut to pairs of blocks.

Whole sets travel as 48-bit hashes: that two of a pair's n-grams agree by chance has a
probability of about 10 ** -9.

Sets of fewer than six n-grams link with equal ones only, which follows from the sizes.

Defined results: texts without words (null, empty, blank) have an empty set and are linked
with nothing; a text of fewer words than an n-gram has one, all its words. Repeated rows are
in one class. A component's id is its smallest non-null doc_id (null if it has none); an
unlinked document without an id has none. Ties and the order of rows change nothing. Only
the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, join_by_share, written
from cartwheel.llm.near_dup import components
from cartwheel.llm.word_hash import mixed, word_hashes

GRAM = 4
#: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Most n-grams that are put last in the order (9 bytes each in every task), and least count of one.
HOT, LEAST_HOT = 1 << 20, 16
#: Most classes of a column whose pairs are counted directly.
FEW = 8
#: Most classes, and n-grams in all their sets, of half a block of rows.
ROWS, ENTRIES = 4096, 1 << 20
#: Rows of a block that are multiplied at a time, and numbers of the dense part of its matrix.
CHUNK, DENSE = 256, 1 << 22
#: Pairs with one class that are decided in one task.
STAR = 2048
#: Bits of the filter of wanted documents (a bounded 8 MB).
FILTER_BITS = 26
#: N-grams that are put together in a task before they are sent, and rows of a block of columns.
PACK = 1 << 20
#: N-grams below this hash are counted.
COUNTED = np.uint64(3 << 61)
#: Bytes of text to a bucket of counts, about.
BUCKET_BYTES = 32 << 20

_rng = np.random.Generator(np.random.PCG64(411))
_PLACES = _rng.integers(1, 2**63, GRAM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_overlap(x, y):
    """Smallest intersection of linked sets of sizes x and y."""
    return -(-PERCENT * (x + y) // (100 + PERCENT))


def beyond(size):
    """Number of a set's n-grams that lie beyond its first columns."""
    return -(-PERCENT * size // 100) - 1


def gram_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The set of every text as sorted distinct 64-bit hashes."""
    for h in word_hashes(texts):
        size = len(h) - GRAM + 1
        if size > 0:
            out = h[:size] * _PLACES[0]
            for k in range(1, GRAM):
                out += h[k:k + size] * _PLACES[k]
            out = mixed(out)
            out.sort()
            keep = np.empty(size, dtype=bool)
            keep[0] = True
            np.not_equal(out[1:], out[:-1], out=keep[1:])
            yield out[keep]
        else:
            yield np.array([xxhash.xxh3_64_intdigest(h.tobytes(), len(h))], dtype=np.uint64) if len(h) else h


def class_of(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


class Fresh:
    """Whether a class is new to this task (forgets when it holds a million)."""

    def __init__(self):
        self.seen: set[bytes] = set()

    def __call__(self, c: bytes) -> bool:
        if c in self.seen:
            return False
        if len(self.seen) >= 1_000_000:
            self.seen.clear()
        self.seen.add(c)
        return True


def short_key(grams: np.ndarray) -> np.ndarray:
    """The first 48 bits of n-gram hashes, by which they are counted and columns are told
    apart. Two that meet by chance are one column: more candidates, never fewer links."""
    return (grams >> np.uint64(16)).astype(np.int64)


def _pack(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1).astype(np.int64)


def key_counts(rows: DataFrame, keys, least: int, buckets: int) -> DataFrame:
    """key and n of the 48-bit keys that occur at least ``least`` times.

    ``keys`` makes an iterator of sorted arrays from a task's batches. A task counts PACK keys
    at a time and sends them packed, 6 bytes each, by ranges of keys; the counts of a range
    are added up in one task, whatever the number of times that one key occurs.
    """
    bits = max(1, (max(2, buckets) - 1).bit_length())

    def send(batches):
        held, size = [], 0

        def out():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(values, np.arange((1 << bits) + 1, dtype=np.int64) << (48 - bits))
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            parts = [(values[cuts[k]:cuts[k + 1]], n[cuts[k]:cuts[k + 1]]) for k in some]
            return pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array([_pack(v[c == 1]) for v, c in parts], pa.binary()),
                 pa.array([_pack(v[c > 1]) for v, c in parts], pa.binary()),
                 pa.array([c[c > 1].astype("<u4").tobytes() for _, c in parts], pa.binary())], ["bucket", "once", "more", "n"])

        for k in keys(batches):
            held.append(k)
            size += len(k)
            if size >= PACK:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def add(batches):
        bucket, held = None, []

        def out():
            values = np.concatenate([_unpack(x) for once, more, _ in held for x in (once, more)])
            n = np.concatenate([x for once, _, c in held for x in (np.ones(len(once) // 6, np.int64), np.frombuffer(c, "<u4").astype(np.int64))])
            order = np.argsort(values, kind="stable")
            values, n = values[order], n[order]
            starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            total = np.add.reduceat(n, starts)
            keep = total >= least
            return pa.RecordBatch.from_arrays([pa.array(values[starts][keep]), pa.array(total[keep])], ["key", "n"])

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("bucket", "once", "more", "n"))):
                if held and row[0] != bucket:
                    yield out()
                    held = []
                bucket = row[0]
                held.append(row[1:])
        if held:
            yield out()

    sent = rows.mapInArrow(send, "bucket int, once binary, more binary, n binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, "key long, n long")


def gram_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """key and number of sets of the n-grams below COUNTED that are in at least LEAST_HOT
    (a set is counted once for each task that reads it: the numbers decide an order only)."""
    def keys(batches):
        fresh = Fresh()
        for b in batches:
            for s in gram_sets(b["text"]):
                if len(s) > GRAM and fresh(class_of(s)):
                    yield short_key(s[:np.searchsorted(s, COUNTED)])

    return key_counts(docs.select("text"), keys, LEAST_HOT, buckets)


def hot_grams(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """At most HOT common n-grams (keys, sorted) and their levels (powers of two of their counts)."""
    counts = written(gram_counts(docs, buckets).select("key", F.floor(F.log2("n")).cast("int").alias("level")), "gram_counts")
    levels = {r["level"]: r["count"] for r in counts.groupBy("level").count().collect()}
    total, least = 0, 64
    for level in sorted(levels, reverse=True):
        total += levels[level]
        if total > HOT:
            break
        least = level
    table = counts.where(F.col("level") >= least).toArrow()
    keys, level = table["key"].to_numpy(), table["level"].to_numpy().astype(np.uint8)
    order = np.argsort(keys)
    return keys[order], level[order]


def prints(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, n_shingles, class (null: empty set) and, once per class and task, its first
    columns in order."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        fresh = Fresh()
        common, levels = shared.value
        for b in batches:
            n, classes, firsts = [], [], []
            for s in gram_sets(b["text"]):
                c = class_of(s) if len(s) else None
                first = None
                if len(s) > 5 and fresh(c):
                    first = s
                    counted = short_key(s[:np.searchsorted(s, COUNTED)])
                    if len(common) and len(counted):
                        at = np.minimum(np.searchsorted(common, counted), len(common) - 1)
                        hot = common[at] == counted
                        if hot.any():
                            level = np.zeros(len(s), dtype=np.uint8)
                            level[:len(counted)][hot] = levels[at[hot]]
                            first = s[np.argsort(level, kind="stable")]  # s is sorted by hash
                    first = first[:len(s) - beyond(len(s))].tobytes()
                n.append(len(s))
                classes.append(c)
                firsts.append(first)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(n, pa.int64()), pa.array(classes, pa.binary()), pa.array(firsts, pa.binary())],
                ["doc_id", "n_shingles", "class", "first"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, class binary, first binary")


def first_columns(b: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(keys of their first columns, sizes, numbers of first columns) of a batch of classes."""
    sizes = b["size"].to_numpy()
    take = sizes - beyond(sizes)
    return [short_key(np.frombuffer(f, np.uint64)[:k]) for f, k in zip(b["first"].to_pylist(), take)], sizes, take


def entries(classes: DataFrame) -> DataFrame:
    """gram (its key), id, size and place of every class's first columns."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                firsts, sizes, take = first_columns(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts)), pa.array(np.repeat(b["id"].to_numpy(), take)),
                     pa.array(np.repeat(sizes, take)), pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in take]))],
                    ["gram", "id", "size", "place"])

    return classes.select("id", "size", "first").mapInArrow(run, "gram long, id long, size long, place int")


def columns_of_several(classes: DataFrame, buckets: int) -> DataFrame:
    """gram: the first columns that more than one class has."""
    def keys(batches):
        for b in batches:
            yield from first_columns(b)[0] if b.num_rows else ()

    return key_counts(classes.select("size", "first"), keys, 2, buckets).select(F.col("key").alias("gram"))


def column_product(members: DataFrame) -> DataFrame:
    """(a, b, n): in how many columns of at most FEW classes two classes of near sizes meet."""
    def multiply(gram, ident, size):
        a, b = [], []
        for apart in range(1, FEW):
            if len(gram) <= apart:
                break
            small, large = size[:-apart], size[apart:]  # ascending inside a column
            meet = (gram[:-apart] == gram[apart:]) & (100 * small >= PERCENT * large)
            a.append(ident[:-apart][meet])
            b.append(ident[apart:][meet])
        if not a or not sum(map(len, a)):
            return None
        a, b = np.concatenate(a), np.concatenate(b)
        a, b = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        counts = np.diff(np.append(starts, len(a)))
        return pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.array(b[starts]), pa.array(counts.astype(np.int32))], ["a", "b", "n"])

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([x, batch[c].to_numpy()]) for x, c in zip(held, ("gram", "id", "size"))]
            if len(held[0]) >= PACK // 8:
                # the last column may go on in the next batch
                cut = int(np.searchsorted(held[0], held[0][-1]))
                if (out := multiply(*(x[:cut] for x in held))) is not None:
                    yield out
                held = [x[cut:] for x in held]
        if (out := multiply(*held)) is not None:
            yield out

    blocks = members.select("gram", "id", "size").repartition("gram").sortWithinPartitions("gram", "size", "id")
    return blocks.mapInArrow(run, "a long, b long, n int").groupBy("a", "b").agg(F.sum("n").alias("n"))


def bounded(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The counted pairs whose overlap can still reach what their sizes demand.

    Common n-grams beyond the first columns are at most those of one of the two sets there;
    ``big`` is the number of first columns with more than FEW classes, which are not counted.
    """
    a = sizes.select(F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("big").alias("big_a"))
    b = sizes.select(F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("big").alias("big_b"))

    def ceil_ratio(top, bottom):
        return F.floor((top + (bottom - 1)) / F.lit(bottom))

    need = ceil_ratio(PERCENT * (F.col("size_a") + F.col("size_b")), 100 + PERCENT)
    rest = ceil_ratio(PERCENT * F.greatest("size_a", "size_b"), 100) - 1
    return (pairs.join(a, "a").join(b, "b")
            .where(F.col("n") + F.least("big_a", "big_b") + rest >= need).select("a", "b", "n"))


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the hashes of ``doc_id``: bits in a fixed number of bytes."""
    h = F.xxhash64("doc_id")
    bits = ids.select(F.explode(F.array(*[
        F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("long")) for shift in (0, FILTER_BITS)])).alias("bit"))
    parts = bits.groupBy(F.floor(F.col("bit") / 32_768).alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit") % 32_768).alias("bitmap")).collect()  # at most 2048 of 4 KB
    out = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for r in parts:
        out[4096 * r["part"]:4096 * (r["part"] + 1)] = np.frombuffer(r["bitmap"], dtype=np.uint8)
    return out


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """class and packed set of the texts of the documents ``wanted`` (class, doc_id), joined with
    the rows of ``wanted``. Documents are told apart where they are; only sets are sent."""
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select("doc_id").distinct()))

    def sets(batches):
        bits, mask = shared.value, np.uint64((1 << FILTER_BITS) - 1)
        for b in batches:
            h = b["h"].to_numpy().view(np.uint64)
            found = np.ones(len(h), dtype=bool)
            for shift in (0, FILTER_BITS):
                at = (h >> np.uint64(shift)) & mask
                found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            some = list(gram_sets(b["text"].filter(pa.array(found))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in some], pa.binary()), pa.array([_pack(short_key(s)) for s in some], pa.binary())],
                ["class", "grams"])

    texts = docs.where("text is not null").select("text", F.xxhash64("doc_id").alias("h"))
    # an id may stand for several texts, and a text for several rows: a set may come twice
    return texts.mapInArrow(sets, "class binary, grams binary").join(wanted.drop("doc_id"), "class")


def decided(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by the sets of one text of each class.

    The set of a meets those of its partners in one task, at most about STAR of them. Sets
    are sent once for each star that they are in, and are not kept.
    """
    dealt = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR).alias("parts"))
    centres = dealt.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                           F.lit(-1).cast("long").alias("b"))
    others = pairs.join(dealt, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), "parts").alias("part"), "b")
    stars = written(centres.unionByName(others).join(classes.select("id", "class", "doc_id"), "id").drop("id"), "stars_of_pairs")

    def run(batches):
        centre, key = None, None
        for batch in batches:
            a, b, grams = batch["a"].to_numpy(), batch["b"].to_numpy(), batch["grams"].to_pylist()
            part, links = batch["part"].to_numpy(), []
            for i in range(batch.num_rows):
                s = _unpack(grams[i])
                if b[i] < 0:
                    centre, key = s, (a[i], part[i])
                    continue
                if key != (a[i], part[i]):
                    raise ValueError("a pair without the set of its first class")
                if overlap(centre, s) >= least_overlap(len(centre), len(s)):
                    links.append(i)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).take(pa.array(links, pa.int64()))

    together = whole_sets(docs, stars).select("a", "part", "b", "grams").repartition("a", "part").sortWithinPartitions("a", "part", "b")
    return together.mapInArrow(run, "a long, b long")


def named_by(found: DataFrame | None, rows: DataFrame, node: str = "id", into: str = "component") -> DataFrame:
    """``rows`` with the component of their class (the class itself if it has no link)."""
    if found is None:
        return rows.withColumn(into, F.col(node))
    return rows.join(found.select(F.col("node").alias(node), F.col("component").alias(into)), node, "left").withColumn(
        into, F.coalesce(into, node))


def several(rows: DataFrame) -> DataFrame:
    """key, members and entries (sizes added up) of the groups that hold more than one component."""
    return rows.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"),
        F.sum("size").alias("entries")).where("low != high").select("key", "members", "entries")


def blocks(rows: DataFrame, most_rows: int, most_entries: int) -> DataFrame:
    """The rows (key, id, size, component) of groups with several components in blocks of that
    size; larger groups as pairs of blocks, so that every two rows meet in one."""
    mixed_rows = written(rows.join(several(rows), "key"), "mixed_groups")
    parts = F.greatest(F.ceil(F.col("members") / most_rows), F.ceil(F.col("entries") / most_entries)).cast("long")
    small = mixed_rows.where(parts <= 2).select("key", "id", "size", "component")
    cut = mixed_rows.where(parts > 2).select(
        "key", "id", "size", "component", F.pmod(F.xxhash64("id"), parts).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("j"))
    pairs = cut.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "id", "size", "component")
    return small.unionByName(pairs.join(several(pairs).select("key"), "key").select("key", "id", "size", "component"))


def block_links(ids: np.ndarray, parts: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between rows of different components (``parts``), one for each two that they join.

    The matrix of the rows' n-grams is multiplied with itself, CHUNK rows at a time: its
    fullest columns as a dense matrix, the others by the lists of their rows. Rows of the
    largest component are not multiplied with each other.
    """
    m, parts = len(ids), parts.copy()
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    length = np.diff(np.append(starts, len(flat)))
    column = np.repeat(np.arange(len(starts)), length)
    dense = np.argsort(-length, kind="stable")[:max(1, DENSE // m)]
    dense = dense[length[dense] >= 32]
    place = np.full(len(starts), -1)
    place[dense] = np.arange(len(dense))
    full = np.zeros((m, len(dense)), dtype=np.float32)
    at = place[column] >= 0
    full[owner[at], place[column[at]]] = 1
    # the other columns that two rows have: for each row its columns
    light = (place[column] < 0) & (length[column] > 1)
    by_row = np.argsort(owner[light], kind="stable")
    row_columns = column[light][by_row]
    row_start = np.searchsorted(owner[light][by_row], np.arange(m + 1))

    names, counts = np.unique(parts, return_counts=True)
    outside = np.flatnonzero(parts != names[counts.argmax()])
    links = []
    for k in range(0, len(outside), CHUNK):
        some = outside[k:k + CHUNK]
        n = full[some] @ full.T
        mine = row_start[some + 1] - row_start[some]
        of_row = np.repeat(np.arange(len(some)), mine)
        which = row_columns[np.arange(mine.sum()) + np.repeat(row_start[some] - (np.cumsum(mine) - mine), mine)]
        take = length[which]
        members = owner[np.arange(take.sum()) + np.repeat(starts[which] - (np.cumsum(take) - take), take)]
        n += np.bincount(np.repeat(of_row, take) * m + members, minlength=len(some) * m).reshape(len(some), m)
        fits = n >= least_overlap(sizes[some][:, None], sizes[None, :])
        for i, row in zip(some.tolist(), fits):
            linked = np.flatnonzero(row)
            for p, j in zip(*(x.tolist() for x in np.unique(parts[linked], return_index=True))):
                if p != parts[i]:
                    links.append((int(ids[i]), int(ids[linked[j]])))
                    parts[parts == p] = parts[i]
    return links


def block_product(rows: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between components, from blocks of rows (key, id, component)."""
    def run(batches):
        key, held = None, []

        def out():
            links = block_links(*(np.array(c, dtype=np.int64) for c in list(zip(*held))[:2]), [_unpack(h[2]) for h in held])
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for k, *row in zip(*(batch[c].to_pylist() for c in ("key", "id", "component", "grams"))):
                if held and k != key:
                    yield out()
                    held = []
                key = k
                held.append(row)
        if held:
            yield out()

    wanted = written(rows.join(classes.select("id", "class", "doc_id"), "id").select("key", "id", "component", "class", "doc_id"), "block_rows")
    sets = whole_sets(docs, wanted).select("key", "id", "component", "grams")
    return sets.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def gram_classes(docs: DataFrame, most_rows: int = ROWS, most_entries: int = ENTRIES) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), text_bytes // BUCKET_BYTES)
    rows = written(prints(docs, hot_grams(docs, buckets)), "gram_prints")
    classes = written(rows.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("size"), F.max("first").alias("first"),
        F.count(F.lit(1)).alias("rows")).withColumn("id", F.monotonically_increasing_id()), "gram_classes")
    usable = classes.where("first is not null")

    shared = written(entries(usable).join(written(columns_of_several(usable, buckets), "columns"), "gram"), "shared_columns")
    columns = written(shared.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("least")).where(
        "members > 1"), "columns")
    members = written(shared.join(columns, "gram"), "column_members")
    large = members.where(F.col("members") > FEW)

    sizes = usable.select("id", "size").join(large.groupBy("id").agg(F.count(F.lit(1)).alias("big")), "id", "left").select(
        "id", "size", F.coalesce("big", F.lit(0)).alias("big"))
    counted = bounded(column_product(members.where(F.col("members") <= FEW)), written(sizes, "sizes"))
    stars = large.where("id != least").groupBy(F.col("least").alias("a"), F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    pairs = written(counted.unionByName(stars).groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")

    links = found = None

    def decide(candidates: DataFrame) -> None:
        nonlocal links, found
        new = written(decided(candidates, classes, docs), "links")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            found = written(components(links), "components")

    def apart(candidates: DataFrame) -> DataFrame:
        """The candidates whose classes are not in one component."""
        both = named_by(found, named_by(found, candidates, "a", "of_a"), "b", "of_b")
        return written(both.where("of_a != of_b").select("a", "b"), "pairs")

    first = written(pairs.groupBy("b").agg(F.max_by("a", F.struct("n", F.negative("a"))).alias("a")).select("a", "b"), "pairs")
    if not first.isEmpty():
        decide(first)
        others = apart(pairs.select("a", "b").join(first, ["a", "b"], "left_anti"))
        if not others.isEmpty():
            decide(others)
    if not large.isEmpty():
        groups = large.select(F.col("least").alias("key"), "id", "size").distinct()
        named = written(named_by(found, groups), "named_groups")
        new = written(block_product(blocks(named, most_rows, most_entries), classes, docs), "links")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            found = written(components(links), "components")

    total = classes.count()
    named = written(named_by(found, classes.select("id", "class", "doc_id", "rows")), "named_classes")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("__n"))
    answer = written(join_by_share(named.select("class", "component", "rows"), written(least, "least"), ["component"], total), "answer")
    known = join_by_share(rows.where("class is not null").select("doc_id", "n_shingles", "class"),
                          answer.select("class", "component_id", F.col("rows").alias("__n")), ["class"], rows.count())
    empty = rows.where("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return known.select("doc_id", "n_shingles", "component_id").unionByName(empty)


def op11_gram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the set and component of every document."""
    return gram_classes(documents(spark, sf_dir))
