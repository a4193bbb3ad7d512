"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full sets.

1. A text's set holds its distinct shingles of five words. Texts with equal sets form a
   class; a third of all rows may be copies of one text and still be one class.
2. A class has TREES * DEPTH minhashes. Every tree orders the classes by DEPTH of them;
   those that share at least MIN_DEPTH leading ones stand together as a region. A region
   of more than REGION classes goes deeper, one hash at a time (adaptive depth), after
   its hub, the class most like the region's consensus, has become a candidate for all
   its members; what is still too large at full depth is dealt to equal parts by hash.
   Afterwards those of a large region that are not in its main component are set against
   all its members in blocks, so the limit costs no link.
3. Inside a region, in the order of the tree, neighbours with the longest common prefix
   are candidates, and so are the members and the hub of their cluster (the class that
   most others of the region resemble, by signature), where signatures agree enough.
   So a region gives about as many pairs as it has members, not all pairs.
4. Candidates are confirmed on their full sets: 100 * intersection >= 75 * union.
   Confirmed links are contracted to components.
5. A second round takes the regions that still hold several components, sends their
   members' full sets there and confirms, inside the region, pairs of members of different
   components whose signatures agree enough. Members of one component need no more links.

A pair of similarity 0.75 shares a region in some tree with probability 0.9998
(1 - (1 - 0.75 ** 3) ** 16), and its signatures agree enough with probability 0.998.
Both rise steeply with the similarity.

Defined results: texts without words (null, empty, blank) have an empty set and are
linked with nothing; a text of fewer than five words has one shingle, all its words.
Repeated rows are in one class. A component's id is its smallest non-null doc_id (null
if it has none). Ties and the order of rows change nothing. Only the named columns are
read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import LOWER_AZ, WORD_RE, documents, written

SHINGLE = 5
TREES, DEPTH, MIN_DEPTH = 16, 8, 3
HASHES = TREES * DEPTH
#: Most classes of a region that are compared in one task (2048 signatures of 512 bytes).
REGION = 2048
#: Least share of equal minhashes of a candidate; similarity 0.75 less 2.9 standard deviations.
LIKELY = 0.64
#: 100 * intersection >= PERCENT * union.
PERCENT = 75

_rng = np.random.Generator(np.random.PCG64(97))
_FACTORS = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Shingle sets as sorted distinct 64-bit hashes, remembering the hashes of words."""

    REMEMBER = 200_000

    def __init__(self):
        self.known: dict[str, int] = {}

    def word_hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        fresh = set(words).difference(known)
        if fresh:
            if len(known) + len(fresh) > self.REMEMBER:
                known.clear()
                fresh = set(words)
            known.update((w, xxhash.xxh3_64_intdigest(w.encode())) for w in fresh)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        words = WORD_RE.findall(text.translate(LOWER_AZ) if not text.isascii() else text.lower()) if text else []
        if not words:
            return np.zeros(0, dtype=np.uint64)
        h = self.word_hashes(words)
        if len(h) < SHINGLE:
            return np.array([xxhash.xxh3_64_intdigest(h.tobytes())], dtype=np.uint64)
        size = len(h) - SHINGLE + 1
        out = np.zeros(size, dtype=np.uint64)
        for k in range(SHINGLE):
            out += h[k:k + size] * _PLACES[k]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return np.unique(out ^ (out >> np.uint64(29)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of HASHES hashes over the set (high halves of products with odd factors)."""
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(shingles), 512):
        part = shingles[start:start + 512, None]
        np.minimum(out, ((part * _FACTORS) >> np.uint64(32)).astype(np.uint32).min(axis=0), out=out)
    return out


def class_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def prints(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class (null: empty set) and signature (once per class and task)."""
    def run(batches):
        shingler, seen = Shingler(), set()
        for b in batches:
            n, classes, signatures = [], [], []
            for text in b["text"].to_pylist():
                s = shingler.shingles(text)
                c = class_of(s) if len(s) else None
                fresh = c is not None and c not in seen
                if fresh:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(c)
                n.append(len(s))
                classes.append(c)
                signatures.append(signature(s).tobytes() if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(n, pa.int64()), pa.array(classes, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "class", "signature"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, class binary, signature binary")


def tree_entries(classes: DataFrame) -> DataFrame:
    """One row per class and tree: class, size, tree and its label of DEPTH minhashes."""
    def run(batches):
        for b in batches:
            sig = signatures_of(b["signature"]).reshape(-1, TREES, DEPTH)
            # big-endian: labels sort as their hashes do
            labels = sig.astype(">u4").tobytes()
            width = 4 * DEPTH
            m = b.num_rows
            pick = np.repeat(np.arange(m), TREES)
            yield pa.RecordBatch.from_arrays(
                [b["class"].take(pa.array(pick)), b["size"].take(pa.array(pick)),
                 pa.array(np.tile(np.arange(TREES, dtype=np.int32), m)),
                 pa.array([labels[i:i + width] for i in range(0, len(labels), width)], pa.binary())],
                ["class", "size", "tree", "label"])

    return classes.select("class", "size", "signature").mapInArrow(run, "class binary, size long, tree int, label binary")


def signatures_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, HASHES)


def agreement(signatures: np.ndarray) -> np.ndarray:
    """Equal minhashes of every two members of a region."""
    m = len(signatures)
    out = np.zeros((m, m), dtype=np.uint8)
    for column in signatures.T:
        out += column[:, None] == column[None, :]
    return out


def alike(signatures: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which two members may be linked, by signatures and set sizes."""
    near = agreement(signatures) >= LIKELY * HASHES
    big, small = np.maximum(sizes[:, None], sizes[None, :]), np.minimum(sizes[:, None], sizes[None, :])
    near &= 100 * small >= PERCENT * big
    np.fill_diagonal(near, False)
    return near


def hub_pairs(near: np.ndarray) -> list[tuple[int, int]]:
    """(member, hub): the member that most others resemble is a hub for them; then again
    among the rest; and neighbours in the region's order."""
    out = [(i, i + 1) for i in range(len(near) - 1) if near[i, i + 1]]
    rest = near.any(axis=1)
    degree = near.sum(axis=1)
    while rest.any():
        hub = int(np.where(rest, degree, -1).argmax())
        members = np.flatnonzero(near[hub] & rest)
        out += [(int(i), hub) for i in members]
        rest[members] = False
        rest[hub] = False
    return out


def by_region(rows: DataFrame, compare, columns: str, partitions: int) -> DataFrame:
    """``compare`` on the table of every region in label order, one region at a time."""
    def run(batches):
        held: list[pa.RecordBatch] = []
        key = None
        for b in batches:
            keys = b["key"].to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if held and keys[start] != key:
                    if (out := compare(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                key = keys[start]
                held.append(b.slice(start, end - start))
        if held and (out := compare(pa.Table.from_batches(held))) is not None:
            yield out

    return rows.repartition(partitions, "key").sortWithinPartitions("key", "label").mapInArrow(run, columns)


def first_round(table: pa.Table) -> pa.RecordBatch | None:
    """Candidates (a, b) of a region, and its members with any look-alike (b null)."""
    near = alike(signatures_of(table["signature"]), table["size"].to_numpy())
    found = np.flatnonzero(near.any(axis=1))
    if not len(found):
        return None
    classes = table["class"].to_pylist()
    key = table["key"][0].as_py()
    a, b = [classes[i] for i in found], [None] * len(found)
    for i, hub in hub_pairs(near):
        a.append(classes[i])
        b.append(classes[hub])
    return pa.RecordBatch.from_arrays(
        [pa.array([key] * len(a), pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["key", "a", "b"])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two full sets (sorted) are similar enough."""
    common = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def second_round(table: pa.Table) -> pa.RecordBatch | None:
    """Links between different components of a region, confirmed on full sets here.

    Look-alikes are tried from the likeliest on, and those whose components have been
    linked meanwhile are passed over: a pair of components costs one link, or one
    comparison for each of its look-alikes if there is none.
    """
    signatures, sizes = signatures_of(table["signature"]), table["size"].to_numpy()
    component = pd.factorize(np.array(table["component"].to_pylist(), dtype=object))[0]
    near = alike(signatures, sizes) & (component[:, None] != component[None, :])
    a, b = np.nonzero(np.triu(near))
    if not len(a):
        return None
    equal = (signatures[a] == signatures[b]).sum(axis=1)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
    joined = list(range(component.max() + 1))

    def root(i: int) -> int:
        while joined[i] != i:
            i = joined[i]
        return i

    links = []
    for k in np.argsort(-equal, kind="stable"):
        i, j = int(a[k]), int(b[k])
        x, y = root(component[i]), root(component[j])
        if x != y and similar(sets[i], sets[j]):
            joined[x] = y
            links.append((i, j))
    if not links:
        return None
    classes = table["class"].to_pylist()
    return pa.RecordBatch.from_arrays(
        [pa.array([classes[i] for i, _ in links], pa.binary()), pa.array([classes[j] for _, j in links], pa.binary())],
        ["a", "b"])


def consensus_hubs(rows: DataFrame, sample: int = 512) -> DataFrame:
    """(class, hub) for the members of regions too large to compare: the hub is the member
    whose signature agrees most with the commonest minhashes of a sample of the region."""
    chosen = rows.where(F.pmod(F.xxhash64("class", "key"), F.lit(1_000_000)) < F.lit(1_000_000.0 * sample) / F.col("members"))

    def commonest(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(pdf["signature"]), dtype=np.uint32).reshape(-1, HASHES)
        mode = np.empty(HASHES, dtype=np.uint32)
        for k in range(HASHES):
            values, counts = np.unique(sig[:, k], return_counts=True)
            mode[k] = values[counts.argmax()]
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "mode": [mode.tobytes()]})

    modes = chosen.groupBy("key").applyInPandas(commonest, "key long, mode binary")

    def agree(batches):
        for b in batches:
            if b.num_rows:
                equal = (signatures_of(b["signature"]) == signatures_of(b["mode"])).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b["key"], b["class"], b["signature"], pa.array(equal, pa.int64())], ["key", "class", "signature", "equal"])

    judged = written(rows.join(modes, "key").mapInArrow(agree, "key long, class binary, signature binary, equal long"), "hub_votes")
    hubs = judged.groupBy("key").agg(F.max_by(F.struct(F.col("class").alias("hub"), F.col("signature").alias("mode")),
                                              F.struct("equal", "class")).alias("best")).select("key", "best.hub", "best.mode")

    def likely(batches):
        for b in batches:
            if b.num_rows:
                equal = (signatures_of(b["signature"]) == signatures_of(b["mode"])).sum(axis=1) >= LIKELY * HASHES
                yield pa.RecordBatch.from_arrays([b["class"], b["hub"]], ["a", "b"]).filter(pa.array(equal))

    return (judged.join(hubs, "key").where(F.col("class") != F.col("hub"))
            .select("class", "signature", "hub", "mode").mapInArrow(likely, "a binary, b binary"))


def forest_regions(entries: DataFrame, signatures: DataFrame,
                   limit: int = REGION) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Members of all regions of 2 to ``limit`` classes (key, label, class, size); and, if
    there are larger ones, candidates (a, b) through their hubs, and the members (key,
    class) of the larger regions before they went deeper."""
    key = F.xxhash64("tree", F.substring("label", 1, 4 * MIN_DEPTH))
    rows, regions, hubs, whole = entries.withColumn("key", key), None, None, None
    for depth in range(MIN_DEPTH, DEPTH + 2):
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members >= 2")
        rows = written(rows.join(counts, "key").select("key", "label", "class", "size", "members"), "forest")
        some = rows.where(F.col("members") <= limit) if depth <= DEPTH else rows
        regions = some if regions is None else regions.unionByName(some)
        large = rows.where(F.col("members") > limit)
        if depth > DEPTH or large.isEmpty():
            break
        whole = large.select("key", "class") if whole is None else whole
        pairs = consensus_hubs(large.join(signatures, "class"))
        hubs = pairs if hubs is None else hubs.unionByName(pairs)
        # one hash deeper; at full depth, equal parts by hash
        part = (F.substring("label", 4 * depth + 1, 4) if depth < DEPTH else
                F.pmod(F.xxhash64("class"), F.ceil(F.col("members") / (limit / 2))).cast("string").cast("binary"))
        rows = large.withColumn("key", F.xxhash64("key", part)).drop("members")
    return regions, hubs, whole


def blocks_of_rest(whole: DataFrame, found: DataFrame, limit: int = REGION) -> DataFrame:
    """Large regions' members (key, class, component) in blocks for the second round.

    Once the hub's links are confirmed, most members of a large region are in one main
    component. The others are set against all members, in blocks of at most about
    ``limit`` rows: every pair of which one is outside the main component meets in a block.
    """
    named = whole.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "key", "class", F.coalesce("component", "class").alias("component"))
    main = (named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main")))
    tagged = named.join(main, "key").withColumn("rest", F.col("component") != F.col("main"))
    half = limit / 2
    sizes = tagged.groupBy("key").agg(F.count(F.lit(1)).alias("all"), F.count_if("rest").alias("others")).where(
        "others > 0").select("key", F.ceil(F.col("all") / half).alias("parts"), F.ceil(F.col("others") / half).alias("rest_parts"))
    tagged = tagged.join(sizes, "key")

    def part(salt: str, parts: str):
        return F.pmod(F.xxhash64("class", F.lit(salt)), F.col(parts))

    def each(parts: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))

    everyone = tagged.select("key", "class", "component", part("all", "parts").alias("part"), each("rest_parts").alias("rest_part"))
    others = tagged.where("rest").select("key", "class", "component", each("parts").alias("part"), part("rest", "rest_parts").alias("rest_part"))
    return everyone.unionByName(others).select(
        F.xxhash64("key", "part", "rest_part").alias("key"), "class", "component").distinct()


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """class and full set of one document (``wanted``: doc_id, class) of every wanted class."""
    def run(batches):
        shingler = Shingler()
        for b in batches:
            sets = [shingler.shingles(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["class", "shingles"])

    ids = wanted.select("doc_id").distinct()
    texts = docs.select("doc_id", "text").where("text is not null").join(
        ids.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select("text")
    found = texts.mapInArrow(run, "class binary, shingles binary")
    # an id may stand for several texts; one set of each wanted class is enough
    return found.join(wanted.select("class").distinct(), "class", "left_semi").dropDuplicates(["class"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    with_a = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = with_a.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b")), "b")

    def run(batches):
        for b in batches:
            keep = [similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                    for x, y in zip(b["set_a"], b["set_b"])]
            yield pa.RecordBatch.from_arrays([b["a"], b["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """node and component (its least node) of all nodes with a link, by large-star and
    small-star contraction; every round is written and read back."""
    def distinct(edges: DataFrame) -> DataFrame:
        return written(edges.where("u != v").distinct(), "stars")

    def mark(edges: DataFrame):
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = distinct(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    before = mark(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours go to the least of all
        large = distinct(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = distinct(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                         .unionByName(least.select("u", F.col("m").alias("v"))))
        now = mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def near_duplicates(docs: DataFrame, limit: int = REGION) -> DataFrame:
    """doc_id, n_shingles, class, component (of classes) and component_id of every document."""
    rows = written(prints(docs), "prints")
    classes = written(
        rows.where("class is not null").groupBy("class").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("size")), "classes")
    signatures = written(rows.where("signature is not null").select("class", F.col("n_shingles").alias("size"), "signature")
                         .dropDuplicates(["class"]), "signatures")
    regions, hubs, whole = forest_regions(tree_entries(signatures), signatures.select("class", "signature"), limit)
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    inside = written(by_region(regions.join(signatures.select("class", "signature"), "class"), first_round,
                               "key long, a binary, b binary", width), "candidates")
    pairs = inside.where("b is not null").select("a", "b")
    if hubs is not None:
        pairs = pairs.unionByName(hubs)
    pairs = written(pairs.distinct(), "pairs")
    nodes = pairs.select(F.col("a").alias("class")).unionByName(inside.select(F.col("a").alias("class"))).unionByName(
        pairs.select(F.col("b").alias("class")))
    nodes = (nodes if whole is None else nodes.unionByName(whole.select("class"))).distinct()
    sets = written(shingle_sets(docs, written(classes.select("class", "doc_id").join(nodes, "class"), "wanted")), "sets")
    links = written(confirmed(pairs, sets), "links")
    found = written(components(links), "components")

    members = inside.where("b is null").select("key", F.col("a").alias("class"))
    named = members.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "key", "class", F.coalesce("component", "class").alias("component"))
    several = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    mixed = named.join(several.select("key"), "key")
    if whole is not None:
        mixed = mixed.unionByName(blocks_of_rest(whole, found, limit))
    mixed = mixed.join(signatures, "class").join(sets, "class").withColumn("label", F.col("class"))
    new = written(by_region(mixed, second_round, "a binary, b binary", width), "more_links")
    if not new.isEmpty():
        found = written(components(found.where("node != component").select(
            F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new)), "components")

    named = classes.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "doc_id", F.coalesce("component", "class").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = named.join(least, "component").select(F.col("class").alias("__class"), "component", "component_id")
    # a class may have a third of all rows: the join is left to AQE, which splits it
    return (rows.select("doc_id", "n_shingles", "class").join(answer, F.col("class") == F.col("__class"), "left")
            .select("doc_id", "n_shingles", "class", "component",
                    F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, limit: int = REGION) -> DataFrame:
    """The rows of ``docs``, one of each component (a row of its smallest id); rows with an
    empty set all stay."""
    found = written(near_duplicates(docs, limit), "near_duplicates")
    best = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("__rows")).withColumnRenamed("doc_id", "__id")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.join(best, F.col("doc_id").eqNullSafe(F.col("__id")))
    again = found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__again"))
    if again.isEmpty():
        return kept.select(*columns)  # every id stands for one row
    several = kept.join(again, F.col("doc_id").eqNullSafe(F.col("__again")), "left_semi")
    once = kept.join(again, F.col("doc_id").eqNullSafe(F.col("__again")), "left_anti").select(*columns)
    # rows that share an id are told apart by the class of their text
    at = docs.columns.index("text")

    def classed(batches):
        shingler = Shingler()
        for b in batches:
            sets = [shingler.shingles(t) for t in b.column(at).to_pylist()]
            c = pa.array([class_of(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, c], names=[*b.schema.names, "__class"])

    schema = docs.select("*", F.lit(b"").cast("binary").alias("__class")).schema
    several = several.select(*columns).mapInArrow(classed, schema)
    node = found.where("class is not null").select(
        F.col("class").alias("__c"), "component", "component_id").distinct()
    chosen = (several.join(node, F.col("__class") == F.col("__c"))
              .where(F.col("doc_id").eqNullSafe(F.col("component_id"))).dropDuplicates(["component"]))
    return (once.unionByName(several.where("__class is null").select(*columns))
            .unionByName(chosen.select(*columns)))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document; the one with the smallest id is kept."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
