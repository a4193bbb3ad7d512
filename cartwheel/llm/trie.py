"""Prefix trie of rebuilt conversations by whole-sequence collapse.

1. Rebuilding: conversation c takes the first h turns of conversation c - c % 5, then its
   own turns after its first h; h = crc32(decimal c) % 9. Only hashes and sizes of turns
   travel on.
2. A prefix of d turns is known by its depth and two running 64-bit sums (exclusive or of
   hashes of (position, turn)), so that equal prefixes have equal keys.
3. Identical rebuilt conversations collapse to one weighted sequence with the digest of
   its list of ends (the ids in ascending order).
4. Sequences that are proper prefixes of others are dropped by an anti-join: the rest are
   the leaves of the trie.
5. Every sequence gives each of its prefixes its weight. A prefix's owner is the sequence
   of the smallest member, so a node is (smallest member, depth), and sums over subtrees are
   sums of suffixes of sequences in which a node counts at its owner only. No node is ever
   paired with its ancestors.

Hot prefixes (the root, a common first turn) are summed before the shuffle. Their totals go
back to the sequences by a broadcast of the nodes that hold more than 1/4096 of all rows
(fewer than 4096 by counting); the other nodes are joined by key. The ids of a sequence's
ends are ordered by range over tasks, packed to pieces, and digested piece by piece.

Defined results: turns are ordered by turn (null first), then role, then text, null role
and text as empty; repeated rows are repeated turns. Rows without a conv_id belong to no
conversation. A rebuilt conversation without turns ends at the root. Other columns are
ignored. Without conversations there is no node. One conversation's turns, however many,
are ordered in one task, which spills.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import join_by_share, written

HEAD_MODULUS = 9
#: Conversations share the head of the one whose id is the multiple of FAMILY below theirs.
FAMILY = 5
#: Bytes of a piece of a list of ends.
PIECE = 1 << 20


def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEAD_MODULUS).cast("int")


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos from 1, two hashes of (role, text), and bytes of the text, of every turn."""
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return turns.select(
        "conv_id", F.row_number().over(order).alias("pos"), F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit("other"), "text", "role").alias("b"), F.octet_length("text").cast("long").alias("bytes"))


def rebuilt_turns(placed: DataFrame) -> DataFrame:
    """Turns of all rebuilt conversations: conv_id, tail (own turns), pos, a, b, bytes."""
    ids = placed.where("pos = 1").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), head_length(F.col("conv_id")).alias("h"))
    heads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEAD_MODULUS)).withColumnRenamed("conv_id", "base")
    shared = ids.join(heads, "base").where("pos <= h").select("conv_id", F.lit(False).alias("tail"), "pos", "a", "b", "bytes")
    own = placed.where(F.col("pos") > head_length(F.col("conv_id"))).select("conv_id", F.lit(True).alias("tail"), "pos", "a", "b", "bytes")
    return shared.unionByName(own)


def prefix_keys(turns: DataFrame) -> DataFrame:
    """conv_id, d, key (k1, k2) of its first d turns, bytes of turn d; d from 1."""
    order = Window.partitionBy("conv_id").orderBy("tail", "pos")
    numbered = turns.withColumn("d", F.row_number().over(order))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered.select(
        "conv_id", "d", F.bit_xor(F.xxhash64("d", "a", "b")).over(so_far).alias("k1"),
        F.bit_xor(F.xxhash64(F.lit("other"), "b", "d", "a")).over(so_far).alias("k2"), "bytes")


def _runs(batches, columns):
    """(key, rows) of each run of equal (length, k1, k2), batch by batch."""
    for b in batches:
        keys = list(zip(*(b[c].to_pylist() for c in ("length", "k1", "k2"))))
        rows = list(zip(*(b[c].to_pylist() for c in columns)))
        start = 0
        for end in range(1, len(keys) + 1):
            if end == len(keys) or keys[end] != keys[start]:
                yield keys[start], rows[start:end]
                start = end


def _table(rows, schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), schema)], [n for n, _ in schema])


def collapse(ends: DataFrame) -> DataFrame:
    """length, k1, k2, seq (smallest member), weight and ends_sha256 of each distinct
    sequence of ``ends`` (conv_id, length, k1, k2)."""
    piece = [("length", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())]
    whole = [*piece[:3], ("seq", pa.int64()), ("weight", pa.int64()), ("ends_sha256", pa.string())]

    def pack(batches):
        key, first, n, parts, size, out = None, None, 0, [], 0, []
        for k, rows in _runs(batches, ["conv_id"]):
            for start in range(0, len(rows), 50_000):
                some = [r[0] for r in rows[start:start + 50_000]]
                if key is not None and (k != key or size > PIECE):
                    out.append((*key, first, n, b",".join(parts)))
                    key, parts, n, size = None, [], 0, 0
                if key is None:
                    key, first = k, some[0]
                parts.append(",".join(map(str, some)).encode())
                n, size = n + len(some), size + len(parts[-1])
            if len(out) >= 5_000 or size > PIECE and out:
                yield _table(out, piece)
                out = []
        if key is not None:
            out.append((*key, first, n, b",".join(parts)))
        if out:
            yield _table(out, piece)

    def digest(batches):
        key, first, weight, sha, out = None, None, 0, None, []
        for k, rows in _runs(batches, ["first", "n", "ids"]):
            for at, n, ids in rows:
                if k != key:
                    if key is not None:
                        out.append((*key, first, weight, sha.hexdigest()))
                    key, first, weight, sha = k, at, 0, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids)
                weight += n
            if len(out) >= 5_000:
                yield _table(out, whole)
                out = []
        if key is not None:
            out.append((*key, first, weight, sha.hexdigest()))
        if out:
            yield _table(out, whole)

    key = ["k1", "k2", "length"]
    ordered = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    pieces = ordered.select(*key, "conv_id").mapInArrow(pack, "length int, k1 long, k2 long, first long, n long, ids binary")
    return pieces.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(
        digest, "length int, k1 long, k2 long, seq long, weight long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    placed = written(placed_turns(conversations), "turns")
    paths = written(prefix_keys(rebuilt_turns(placed)), "paths")
    last = paths.groupBy("conv_id").agg(F.max_by(F.struct("d", "k1", "k2"), "d").alias("last"))
    ends = placed.where("pos = 1").select("conv_id").join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("last.d", F.lit(0)).alias("length"),
        F.coalesce("last.k1", F.lit(0).cast("long")).alias("k1"), F.coalesce("last.k2", F.lit(0).cast("long")).alias("k2"))
    seqs = written(collapse(ends), "sequences")

    of_seq = seqs.select("seq", "length", "weight", "ends_sha256")
    below = paths.join(of_seq, F.col("conv_id") == F.col("seq")).select("seq", "length", "weight", "ends_sha256", "d", "k1", "k2", "bytes")
    zero = F.lit(0).cast("long")
    rows = written(below.unionByName(of_seq.select("*", F.lit(0).alias("d"), zero.alias("k1"), zero.alias("k2"), zero.alias("bytes"))), "prefixes")

    proper = rows.where("d < length").select(F.col("d").alias("length"), "k1", "k2").distinct()
    leaves = seqs.join(proper, ["length", "k1", "k2"], "left_anti").select("seq", F.lit(1).alias("leaf"))
    nodes = written(rows.groupBy("d", "k1", "k2").agg(
        F.sum("weight").alias("n_convs"), F.min("seq").alias("node"), F.count(F.lit(1)).alias("__n")), "nodes")

    named = join_by_share(rows, nodes, ["d", "k1", "k2"], rows.count()).join(leaves, "seq", "left")
    owned = F.when(F.col("node") == F.col("seq"), (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0)
    deepest_first = Window.partitionBy("seq").orderBy(F.col("d").desc())
    summed = named.withColumn("owned", owned).select(
        "node", "d", "n_convs", "length", "ends_sha256", "leaf",
        F.sum("owned").over(deepest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("saved"),
        F.lead("node").over(deepest_first).alias("parent"),
        (F.lag("node").over(deepest_first) == F.col("seq")).alias("has_child"))
    return summed.groupBy(F.col("node").alias("conv_id"), F.col("d").cast("long").alias("depth")).agg(
        F.min("parent").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"), F.count_if("has_child").alias("n_children"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max(F.when(F.col("d") == F.col("length"), F.col("ends_sha256"))), F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
