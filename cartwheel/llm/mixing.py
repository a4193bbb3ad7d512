"""Mixing sources to target weights, in fixed-length blocks.

1. Each source's words, in a fixed order of its documents, form one long row that is
   cut into blocks of ``BLOCK`` words; a document owns the pieces of the blocks that it
   lies in. Only word counts and positions move, never texts.
2. A source's target words become whole passes over its blocks and one partial pass of
   as many words as are left. Every pass goes through the blocks in a pseudorandom order
   of its own (a keyed permutation of the block numbers, computed, not stored); the last
   block of the partial pass is cut, so a source gives its target to the word.
3. The draws of all sources are dealt to output shards: each shard's counts by source
   are one multinomial draw in proportion to what every source has left.
4. (source, block) joins the drawn slots with the pieces.

Targets are at most 3 times a source's words, so there are at most 3 passes and no
document is taken more than 3 times whole.

Defined results: a null or blank text has size 0 and is taken 0 times; null is a source
of its own, last in order; a source without words has target 0; repeated rows are
documents of their own; an empty table gives an empty result. Same rows and seed, same
result, whatever the partitioning. Only the named columns are read.

The driver holds one row per source (a mixture's configuration) and at most
``MAX_SHARDS`` rows of counts for each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import WORD_RE, documents, word_count, written

BLOCK = 512
CYCLE = (1.0, 2.0, 3.0)
MAX_REPEAT = 3
SLOTS_PER_SHARD = 1024
MAX_SHARDS = 4096
#: Documents of a source are numbered in this many buckets at least, and about
#: ``ROWS_PER_BUCKET`` rows in each.
MIN_BUCKETS, ROWS_PER_BUCKET = 64, 50_000


def water_fill(sizes: list[int], weights: list[float], most: float = MAX_REPEAT) -> list[float]:
    """Targets by weight that sum to all sizes, none above ``most`` times its size."""
    targets, rest, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in sorted(open_))
        full = [i for i in sorted(open_) if rest * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = rest * weights[i] / weight
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            rest -= targets[i]
            open_.discard(i)
    return targets


def _rounds(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    """Four Feistel rounds on numbers of 2 * half bits."""
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    order = range(3, -1, -1) if back else range(4)
    with np.errstate(over="ignore"):
        for r in order:
            if back:
                left, right = right, left
            f = (right + np.uint64((key * 4 + r) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left = left ^ ((f >> np.uint64(32)) & mask)
            if not back:
                left, right = right, left
    return (left << np.uint64(half)) | right


def permute(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of 0..n-1 (``back``: its inverse), by walking the cycles of a
    Feistel network on the next power of four until they come back below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    x = _rounds(np.asarray(index, dtype=np.uint64), half, key, back)
    while (out := x >= n).any():
        x[out] = _rounds(x[out], half, key, back)
    return x.astype(np.int64)


@dataclass(frozen=True)
class SourcePlan:
    """One source's blocks and draws; ``key`` seeds its permutations."""

    name: str | None
    words: int
    target: float
    key: int
    block: int = BLOCK

    @property
    def blocks(self) -> int:
        return -(-self.words // self.block)

    @property
    def passes(self) -> int:
        return int(self.target // self.words) if self.words else 0

    @property
    def rest(self) -> int:
        """Words of the partial pass."""
        return min(self.words, max(0, round(self.target) - self.passes * self.words))

    def short_rank(self) -> int:
        """Where the last, shorter block stands in the order of the partial pass."""
        return int(permute(np.array([self.blocks - 1]), self.blocks, self.key + self.passes, back=True)[0])

    def draws(self) -> int:
        if not self.words:
            return 0
        rank, short = self.short_rank(), self.blocks * self.block - self.words
        ranks = -(-self.rest // self.block)  # if every block were full
        if ranks > rank:
            ranks = max(rank + 1, -(-(self.rest + short) // self.block))
        return self.passes * self.blocks + min(ranks, self.blocks)

    def slots(self, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pass, block, words taken from its start) of the given draws."""
        turn, k = draw // self.blocks, draw % self.blocks
        block = np.empty_like(k)
        for t in np.unique(turn):
            at = turn == t
            block[at] = permute(k[at], self.blocks, self.key + int(t))
        short = self.blocks * self.block - self.words
        words = np.where(block == self.blocks - 1, self.block - short, self.block)
        before = k * self.block - np.where(k > self.short_rank(), short, 0)
        return turn, block, np.where(turn == self.passes, np.clip(self.rest - before, 0, words), words)


def deal(plans: list[SourcePlan], seed: int, slots_per_shard: int = SLOTS_PER_SHARD) -> list[tuple[int, int, int, int]]:
    """(shard, source, first draw, count): multinomial counts of what is left, shard by shard."""
    left = np.array([p.draws() for p in plans], dtype=np.int64)
    total, out, taken = int(left.sum()), [], np.zeros(len(plans), dtype=np.int64)
    shards = min(MAX_SHARDS, max(1, -(-total // slots_per_shard)))
    rng = np.random.Generator(np.random.PCG64(seed))
    for shard in range(shards if total else 0):
        want = int(left.sum()) // (shards - shard)
        counts = np.minimum(rng.multinomial(want, left / left.sum()), left) if shard < shards - 1 else left.copy()
        while (missing := want - int(counts.sum())) > 0 and shard < shards - 1:
            room = left - counts
            counts += np.minimum(rng.multinomial(missing, room / room.sum()), room)
        out += [(shard, s, int(taken[s]), int(c)) for s, c in enumerate(counts) if c]
        taken += counts
        left = left - counts
    return out


def source_plans(sizes: DataFrame, seed: int, weights: tuple[float, ...] = CYCLE, block: int = BLOCK) -> list[SourcePlan]:
    """Plans in code-point order of the sources, null last; ``sizes`` has source and size."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("words")).collect()  # one row per source
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    cycle = [weights[i % len(weights)] for i in range(len(rows))]
    words = [int(r["words"]) for r in rows]
    return [SourcePlan(r["source"], w, t, seed + 16 * i, block)
            for i, (r, w, t) in enumerate(zip(rows, words, water_fill(words, cycle)))]


def drawn_slots(spark: SparkSession, plans: list[SourcePlan], seed: int) -> DataFrame:
    """shard, sidx, turn, block, words: one row for every slot of the mix."""
    table = spark.createDataFrame(deal(plans, seed), "shard int, sidx int, first long, n long")
    draws = table.select("shard", "sidx", F.explode(F.sequence(
        F.col("first"), F.col("first") + F.col("n") - 1)).alias("draw"))

    def mapped(batches):
        for b in batches:
            sidx, draw = b["sidx"].to_numpy(), b["draw"].to_numpy()
            cols = [np.zeros(len(draw), dtype=np.int64) for _ in range(3)]
            for s in np.unique(sidx):
                at = sidx == s
                for c, v in zip(cols, plans[s].slots(draw[at])):
                    c[at] = v
            yield pa.RecordBatch.from_arrays(
                [b["shard"], b["sidx"], *map(pa.array, cols)], ["shard", "sidx", "turn", "block", "words"])

    return draws.mapInArrow(mapped, "shard int, sidx int, turn long, block long, words long")


def positions(sizes: DataFrame, plans: list[SourcePlan]) -> DataFrame:
    """Add sidx, ``start``, a document's first word in its source's row, for each copy, and copies.

    ``sizes``: source, doc_id, size, mark (tells rows of one id apart). Order inside a
    source: (bucket, doc_id, mark). Equal rows are counted before they are shuffled.
    """
    spark = sizes.sparkSession
    rows = sizes.count()
    buckets = max(MIN_BUCKETS, rows // ROWS_PER_BUCKET)
    names = spark.createDataFrame([(p.name, i) for i, p in enumerate(plans)], "__name string, sidx int")
    keyed = (sizes.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(buckets)))
             .groupBy("source", "bucket", "doc_id", "mark", "size").agg(F.count(F.lit(1)).alias("copies"))
             .join(names, F.col("source").eqNullSafe(F.col("__name"))).drop("__name"))
    sums = keyed.groupBy("sidx", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    earlier = Window.partitionBy("sidx").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("sidx", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("sidx", "bucket").orderBy("doc_id", "mark", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = keyed.withColumn("at", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
    return (placed.join(starts, ["sidx", "bucket"])
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .select("source", "sidx", "doc_id", "mark", "size", "copy", "copies",
                    (F.col("base") + F.col("at") + F.col("copy") * F.col("size")).alias("start")))


def taken_pieces(placed: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every document's pieces joined with the slots that drew their block.

    Columns of ``placed`` and shard, turn, ``low`` and ``high`` (words of the document,
    half open); a document that no slot drew, or without words, has one row of nulls.
    """
    last = F.col("start") + F.col("size") - 1
    pieces = placed.withColumn("block", F.explode_outer(F.when(
        F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor(last / block)))))
    origin = F.col("block") * block - F.col("start")  # the block's first word, counted in the document
    joined = pieces.join(slots, ["sidx", "block"], "left")
    low = F.greatest(origin, F.lit(0))
    high = F.least(origin + F.col("words"), F.col("size"))
    hit = F.col("words").isNotNull() & (high > low)  # least() alone would pass over the null of no slot
    return joined.select(*placed.columns, "shard", "turn", F.when(hit, low).alias("low"), F.when(hit, high).alias("high"))


def sized(docs: DataFrame, mark) -> DataFrame:
    return docs.select("source", "doc_id", word_count(F.col("text")).alias("size"), mark.alias("mark"))


def op3_mix_sources(spark: SparkSession, sf_dir: str, seed: int = 20_240_601) -> DataFrame:
    """Words of every document that the mix of all sources takes."""
    sizes = written(sized(documents(spark, sf_dir), F.lit(0).cast("long")), "mix_sizes")
    plans = source_plans(sizes, seed)
    placed = positions(sizes, plans)
    pieces = taken_pieces(placed, drawn_slots(spark, plans, seed))
    taken = pieces.groupBy("doc_id", "copy", "sidx", "size").agg(
        F.sum(F.coalesce(F.col("high") - F.col("low"), F.lit(0))).cast("long").alias("taken"))
    info = spark.createDataFrame([(i, p.words, p.target) for i, p in enumerate(plans)],
                                 "sidx int, source_size long, target double")
    return taken.join(info, "sidx").select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: int = 20_240_601) -> DataFrame:
    """``docs`` as the mix takes them: one row for each pass over a document, with all its
    columns; the text holds what the pass took (whole texts unchanged, cut ones the runs of
    words taken, each as it stands in the text, joined by newlines) and n_chars its length."""
    spark = docs.sparkSession
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    sizes = written(sized(docs, mark), "mix_sizes")
    plans = source_plans(sizes, seed)
    pieces = taken_pieces(positions(sizes, plans), drawn_slots(spark, plans, seed)).where("high is not null")
    passes = pieces.groupBy("doc_id", "mark", "copy", "copies", "turn", "size").agg(
        F.array_sort(F.collect_list(F.struct("low", "high"))).alias("runs"), F.sum(F.col("high") - F.col("low")).alias("taken"))
    passes = passes.select(
        F.col("doc_id").alias("__id"), F.col("mark").alias("__m"), "copy", "copies", "turn",
        F.when(F.col("taken") < F.col("size"), F.col("runs")).alias("__runs"))
    # the rows of one document travel once: its passes are gathered first (3 at most a copy)
    gathered = passes.groupBy("__id", "__m").agg(
        F.collect_list(F.struct("copy", "turn", "__runs")).alias("__passes"),
        F.max("copies").alias("__copies"))
    joined = docs.withColumn("__mark", mark).join(
        gathered, (F.col("__mark") == F.col("__m")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    # of rows that are equal in all columns one is taken, with the passes over all of them
    alone, equal = joined.where("__copies = 1"), joined.where("__copies > 1")
    joined = alone.unionByName(equal.dropDuplicates(["__mark", "doc_id"]))
    rows = joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode("__passes").alias("__pass"))
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__pass.__runs").alias("__runs"))
    at = docs.columns.index("text")

    def cut(batches):
        for b in batches:
            runs, texts = b.column(b.num_columns - 1).to_pylist(), b.column(at).to_pylist()
            done = [t if r is None else cut_words(t, [(x["low"], x["high"]) for x in r]) for t, r in zip(texts, runs)]
            cols = [pa.array(done, b.schema.field(at).type) if i == at else b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    out = rows.mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def cut_words(text: str, runs: list[tuple[int, int]]) -> str:
    """The given half-open word ranges (ascending) as they stand in the text."""
    joined = []
    for low, high in runs:
        if joined and joined[-1][1] == low:
            joined[-1][1] = high
        else:
            joined.append([low, high])
    spans = [m.span() for m in WORD_RE.finditer(text)]
    return "\n".join(text[spans[low][0]:spans[high - 1][1]] for low, high in joined)
