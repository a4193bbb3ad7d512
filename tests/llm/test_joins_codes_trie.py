"""The n-gram join, vector codes and the prefix trie against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.llm import gram_join, product_codes, trie, word_hash
from cartwheel.llm.common import join_by_share
from cartwheel.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGE_ROWS, edge_conversations, edge_embeddings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}


# ---- n-gram join -----------------------------------------------------------------------
def gram_set(text):
    words = WORD.findall((text or "").translate(AZ))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 4]) for i in range(len(words) - 3)) if len(words) >= 4 else frozenset([tuple(words)])


def brute_components(rows):
    """Counter of (doc_id, size of the set, component) by comparing every two distinct sets."""
    sets = [gram_set(t) for _, t in rows]
    distinct = sorted(set(s for s in sets if s), key=lambda s: (len(s), sorted(s)))
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, x in enumerate(distinct):
        for y in distinct[i + 1:]:
            if 100 * len(x) < 85 * len(y):
                break
            n = len(x & y)
            if 100 * n >= 85 * (len(x) + len(y) - n):
                root[find(x)] = find(y)
    least = defaultdict(list)
    for (d, _), s in zip(rows, sets):
        if s and d is not None:
            least[find(s)].append(d)
    return Counter((d, len(s), d if not s else min(least[find(s)], default=None)) for (d, _), s in zip(rows, sets))


def found_components(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("table", ["small", "edge"])
def test_op11_gram_join(spark, edge_dir, small_rows, table):
    folder = SF_SMALL if table == "small" else edge_dir
    rows = [(r[0], r[1]) for r in (small_rows if table == "small" else EDGE_ROWS)]
    assert found_components(QUERIES["op11_gram_join"](spark, folder)) == brute_components(rows)


def near_copies(seed, families, members, words=60):
    """Families of texts that differ in a few words, some of them about at the threshold,
    which all hold one passage; and texts that are mostly that passage."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for f in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(words)] = f"x{rng.randrange(300)}"
            rows.append(" ".join(text + passage))
    rows += [" ".join(passage + [f"y{rng.randrange(40)}" for _ in range(rng.randrange(0, 7))]) for _ in range(members)]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [(20, 1 << 20), (4096, 900), (4096, 1 << 20)])
def test_columns_of_many_classes(spark, monkeypatch, block):
    """Groups of one block, and groups cut to pairs of blocks, lose no link."""
    rows = near_copies(block[0], 4, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = found_components(gram_join.gram_classes(docs, *block))
    want = brute_components(rows)
    assert got == want
    assert 4 < len({c for _, _, c in want}) < len(rows)


@pytest.mark.parametrize("seed", range(5))
def test_block_links_join_what_links(monkeypatch, seed):
    """Dense and light columns, any chunks: the components of the block, by few links."""
    monkeypatch.setattr(gram_join, "CHUNK", 7)
    monkeypatch.setattr(gram_join, "DENSE", (0, 50, 5000, 10**6, 10**6)[seed])
    rng = random.Random(seed)
    pool = [rng.sample(range(1000), 30) for _ in range(6)]
    sets = []
    for _ in range(150):
        s = set(rng.choice(pool))
        for _ in range(rng.randrange(0, 4)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randrange(1000, 3000))
        sets.append(np.array(sorted(s)))
    start = [rng.randrange(100) for _ in sets]
    links = gram_join.block_links(np.arange(150) + 500, np.array(start), sets)

    def joined(pairs):
        root = {p: p for p in start}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for i, j in pairs:
            root[find(start[i])] = find(start[j])
        groups = defaultdict(set)
        for p in start:
            groups[find(p)].add(p)
        return sorted(map(sorted, groups.values()))

    every = [(i, j) for i in range(150) for j in range(i)
             if 100 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - n)]
    assert joined([(a - 500, b - 500) for a, b in links]) == joined(every)
    assert len(links) < len(set(start)) < len(every)


def test_sizes_at_the_threshold(spark):
    """Sets of 17 and 20 n-grams that share 17: exactly 85 in 100."""
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words[:20])), (2, " ".join(words[:23])), (3, " ".join(words[:24])), (4, " ".join(words[:19]))]
    got = found_components(gram_join.gram_classes(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute_components(rows)


def test_bounds_of_sizes():
    for x in range(1, 120):
        for y in range(x, 120):
            least = min(n for n in range(0, x + y) if 100 * n >= 85 * (x + y - n))
            assert gram_join.least_overlap(x, y) == least
            if x < 6 and least <= x:
                assert x == y == least
        assert gram_join.beyond(x) == math.ceil(85 * x / 100 - 1e-9) - 1


def test_hot_texts_are_found(spark):
    """A third of all rows are one text; another third near copies of each other."""
    rng = random.Random(1)
    rows = [(i, "the same words again and again in every row of this group of texts") for i in range(200)]
    base = [f"w{i}" for i in range(80)]
    for i in range(200, 400):
        text = list(base)
        text[rng.randrange(80)] = f"z{i}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(f"q{rng.randrange(10**6)}" for _ in range(30))) for i in range(400, 600)]
    got = found_components(gram_join.gram_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)))
    assert got == brute_components(rows)


# ---- vector codes ----------------------------------------------------------------------
def brute_codes(rows):
    kept = [(v, x, label) for v, x, label in rows if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    kept = [(v, [math.floor(256 * float(np.float32(c))) for c in x], label, x) for v, x, label in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = next(len(r[1]) for r in order if len(r[1]) and len(r[1]) % 16 == 0)
    order = [r for r in order if len(r[1]) == width]
    per, out, digest = width // 16, [["", 0] for _ in order], []

    def nearest(book, s):
        return min((sum((a - b) ** 2 for a, b in zip(e, s)), k) for k, e in enumerate(book))

    for p in range(16):
        parts = [r[1][p * per:(p + 1) * per] for r in order]
        book = [list(s) for s in parts[:64]]
        for _ in range(2):
            groups = defaultdict(list)
            for s in parts:
                groups[nearest(book, s)[1]].append(s)
            book = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(book)]
        for o, s in zip(out, parts):
            d, k = nearest(book, s)
            o[0] += f"{k:02x}"
            o[1] += d
        digest += [str(c) for e in book for c in e]
    label_error = Counter()
    for r, o in zip(order, out):
        label_error[r[2]] += o[1]
    sha = hashlib.sha256(",".join(digest).encode()).hexdigest()
    got = Counter((r[0], o[0], o[1], label_error[r[2]], sha) for r, o in zip(order, out))
    others = [r for r in kept if len(r[1]) != width]
    return got + Counter((r[0], None, None, label_error[r[2]] if r[2] in label_error else None, sha) for r in others)


def found_codes(df):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


@pytest.mark.parametrize("table", ["small", "edge"])
def test_op12_vector_codes(spark, edge_dir, table):
    folder = SF_SMALL if table == "small" else edge_dir
    rows = edge_embeddings() if table == "edge" else [
        (r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert found_codes(QUERIES["op12_vector_codes"](spark, folder)) == brute_codes(rows)


def test_few_and_huge_vectors(spark):
    rows = [(i, [float(i)] * 16 if i % 2 else [3e38, -3e38] * 8, i % 2) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got, books = product_codes.quantise(df)
    found = {r.vec_id: (r.code, r.error) for r in got.collect()}
    # equal vectors fall to the lowest of their equal entries
    assert found == {0: ("00" * 16, 0), 2: ("00" * 16, 0), 4: ("00" * 16, 0), 1: ("01" * 16, 0), 3: ("03" * 16, 0)}
    assert books[0][0] == [256 * int(np.float32(3e38))]


@pytest.mark.parametrize("d", [1, 2, 4, 7])
def test_shortlists_keep_the_nearest(d):
    rng = np.random.default_rng(d)
    points = rng.integers(-200, 200, (1000, d))
    entries = rng.integers(-200, 200, (64, d))
    entries[40] = entries[3]
    blocks = product_codes.Blocks(points, np.argsort(product_codes.hilbert_keys(points), kind="stable"))
    index, distance = blocks.assign(entries)
    exact = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert d > 4 or blocks.shortlists(entries).mean() < 0.9
    sums, counts = np.zeros((64, d), dtype=np.int64), np.zeros(64, dtype=np.int64)
    blocks.add_up(entries, sums, counts)
    assert (counts == np.bincount(index, minlength=64)).all()
    assert (sums == [points[index == k].sum(axis=0) for k in range(64)]).all()


def test_hilbert_order_has_neighbours():
    """On a whole grid, each step of the curve goes to a neighbouring cell."""
    grid = np.array([(x, y) for x in range(256) for y in range(256)])
    path = grid[np.argsort(product_codes.hilbert_keys(grid))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# ---- prefix trie -----------------------------------------------------------------------
def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0, role or "", text or ""), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in own.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
        ends[seq].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    saved, leaves = Counter(), Counter()
    for p, members in nodes.items():
        own_saved = (len(members) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own_saved
            leaves[p[:d]] += children[p] == 0
    return Counter((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in nodes.items())


def found_trie(df):
    return Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in df.collect())


@pytest.mark.parametrize("table", ["small", "edge"])
def test_op13_prefix_trie(spark, edge_dir, table):
    folder = SF_SMALL if table == "small" else edge_dir
    rows = edge_conversations() if table == "edge" else [
        (r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    assert found_trie(QUERIES["op13_prefix_trie"](spark, folder)) == brute_trie(rows)


def test_list_of_ends_in_pieces(spark, monkeypatch):
    """A list of ends that is longer than a piece, and ordered over several tasks."""
    monkeypatch.setattr(trie, "PIECE", 64)
    rows = [(i * 7, 0, "user", "hello") for i in range(3000)]
    ends = spark.createDataFrame([(r[0], 1, 5, 6) for r in rows] + [(-1, 2, 5, 6)], "conv_id long, length int, k1 long, k2 long")
    got = {r.length: (r.seq, r.weight, r.ends_sha256) for r in trie.collapse(ends.repartition(4)).collect()}
    whole = hashlib.sha256(",".join(str(r[0]) for r in rows).encode()).hexdigest()
    assert got == {1: (0, 3000, whole), 2: (-1, 1, hashlib.sha256(b"-1").hexdigest())}


# ---- join by share ---------------------------------------------------------------------
def test_join_by_share(spark):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(["a"] * 50 + ["b"] * 5 + ["c", None, None])], "k string, i int")
    table = rows.groupBy("k").count().withColumnRenamed("count", "__n").selectExpr("k", "upper(k) AS u", "__n")
    got = {(r.k, r.i, r.u) for r in join_by_share(rows, table, ["k"], 58, most=4).collect()}
    assert got == {(r.k, r.i, r.k and r.k.upper()) for r in rows.collect()}



# ---- word hashes -----------------------------------------------------------------------
def test_word_hashes_follow_the_words(monkeypatch):
    """Equal words have equal hashes wherever they stand, different ones different ones; with
    windows of any size, slices and nulls."""
    rng = random.Random(4)
    alphabet = "aAbBzZ éÉ東 \t\n\x0b\x0c\r.,"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    texts += [None, "", "x" * 700, "x" * 700 + " y", "a " * 900, " " * 600 + "b"]
    for window in (64, 1 << 18):
        monkeypatch.setattr(word_hash, "WINDOW", window)
        hashes: dict[str, int] = {}
        for column in (pa.array(texts), pa.array(["zz zz", *texts]).slice(1), pa.array(texts, pa.large_string())):
            found = list(word_hash.word_hashes(column))
            assert len(found) == len(texts)
            for text, h in zip(texts, found):
                words = WORD.findall((text or "").translate(AZ))
                assert len(words) == len(h)
                for w, x in zip(words, h.tolist()):
                    assert hashes.setdefault(w, x) == x
        assert len(set(hashes.values())) == len(hashes) > 300


def test_key_counts_over_tasks(spark):
    """Counts of 48-bit keys that come in several packs and tasks."""
    rng = random.Random(8)
    values = [rng.randrange(40) * (2**48 // 40) + rng.randrange(3) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(6)

    def keys(batches):
        for b in batches:
            v = b["v"].to_numpy()
            for k in range(0, len(v), 100):
                yield np.sort(v[k:k + 100])

    for least in (1, 30):
        got = {r.key: r.n for r in gram_join.key_counts(df, keys, least, 20).collect()}
        assert got == {v: n for v, n in Counter(values).items() if n >= least}
