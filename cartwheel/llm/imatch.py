"""I-Match fingerprints.

The corpus' terms (words in lower case) within a band of document frequencies make the
lexicon: neither so common that every text has them nor so rare that they are typos. A
text is the sorted set of its terms in the lexicon. One hash of that set would change
with any term, so the lexicon is thinned at random to SUBSETS smaller ones, at RATES from
a quarter to a few hundredths of a percent, and each gives a hash of the text's terms in
it. Of two texts, the share of equal hashes, among those that either text has, tells how
much their terms have in common.

Document frequencies are counted over distinct texts: a text with copies is one. A group
of near copies can still lift its own terms above the band. So a fingerprint also has the
least hashes of all of the text's terms under SPARE orders, and where one of two texts has
fewer than FEW lexicon terms, the share of equal ones among those is their likeness.

The lexicon's size is bounded whatever the number of documents: a term must be in the
share LOW of the distinct texts, and a text has so many terms, so there can be no more
than (mean distinct terms of a text) / LOW. The terms that are counted exactly, before
that, are at most as many times more as there are rows to a distinct text.

Defined results: null is as the empty text. A text without any term has a hash of its
whole text for a fingerprint. Equal texts have equal fingerprints, and likeness 1.
The next document is the next in ascending order of (doc_id, hash of the text), null ids
last; after the last comes the first; a lone document follows itself. Repeated rows are
documents of their own. Only the named columns are read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from dataclasses import dataclass
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, remembers
from cartwheel.llm.word_hash import WINDOW, run_hashes

#: Band of document frequencies, as shares of the distinct texts.
LOW, HIGH = 0.001, 0.1
#: One lexicon in so many terms, for each of the thinned lexicons.
RATES = [4, 8, 16, 32, 64, 128, 256, 512]
EACH = 12
SUBSETS = len(RATES) * EACH
#: Subsets with terms that a likeness is read from, at least (where there are so many).
ENOUGH = 20
#: A text with fewer lexicon terms is compared by the least hashes of all its terms, of so many orders.
FEW, SPARE = 5, 64
#: Text bytes of a run of neighbouring documents, about, and the least number of runs.
RUN_BYTES, MIN_RUNS = 16 << 20, 64
#: Letters by code point: terms are runs of them.
LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
_NO_LETTER = re.compile(r"[\W\d_]")


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> tuple[str, ...]:
    """Terms within the band, sorted. Copies of a text count once.

    Counts over all rows are no lower than those over distinct texts. They choose the terms
    that may be in the band, and only the numbers of these are sent, by the text's hash.
    Counts and copies combine before the shuffles.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hashes = [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]
    n = docs.select(*hashes).distinct().count()
    terms = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    counts = (docs.where("text is not null").select(F.explode(terms).alias("term"))
              .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    least, most = max(1.0, low * n), max(1.0, high * n)
    maybe = sorted(r["term"] for r in counts.where((F.col("df") >= least) & (F.col("term") != "")).select("term").collect())
    shared = docs.sparkSession.sparkContext.broadcast(maybe)  # bounded, see above

    def number(batches):
        find = Numbers(shared.value).ascending
        packer = zstandard.ZstdCompressor(level=1)
        for b in batches:
            packed = []
            for t in b["text"].to_pylist():  # gaps between ascending numbers pack well
                ids = find(term_hashes(t)).astype("<u4")
                packed.append(packer.compress(np.diff(ids, prepend=ids.dtype.type(0)).tobytes()))
            yield pa.RecordBatch.from_arrays([b["h1"], b["h2"], pa.array(packed, pa.binary())], ["h1", "h2", "packed"])

    def count(batches):
        df = np.zeros(len(shared.value), dtype=np.int64)
        unpacker = zstandard.ZstdDecompressor()
        for b in batches:
            for packed in b["packed"].to_pylist():
                df[np.cumsum(np.frombuffer(unpacker.decompress(packed), dtype="<u4"))] += 1  # each term once
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(df[found], pa.int64())], ["term", "df"])

    once = (docs.select(*hashes, text.alias("text")).mapInArrow(number, "h1 long, h2 long, packed binary")
            .groupBy("h1", "h2").agg(F.first("packed").alias("packed")))
    exact = once.select("packed").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    band = exact.where((F.col("df") >= least) & (F.col("df") <= most))
    return tuple(sorted(maybe[r["term"]] for r in band.select("term").collect()))


def term_hashes(text: str) -> np.ndarray:
    """Sorted distinct hashes of the terms (runs of letters, in lower case) of a text."""
    text, out, start = text.lower(), [], 0
    while start < len(text):
        end = start + WINDOW
        if end < len(text):  # pieces end where no term does go on
            found = _NO_LETTER.search(text, end)
            end = found.start() if found else len(text)
        points = np.frombuffer(text[start:end].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        out.append(run_hashes(points, LETTER[points])[0])
        start = end
    return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=np.uint64)


class Numbers:
    """Terms of a lexicon by their hashes."""

    def __init__(self, terms: Sequence[str]):
        joined = np.frombuffer(" ".join(terms).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        hashes = np.concatenate([run_hashes(points, points != 32)[0] for points in pieces_at_blanks(joined)] or [np.zeros(0, np.uint64)])
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the terms with these hashes, in their order."""
        if not len(self.sorted):
            return np.zeros(0, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return self.order[at[self.sorted[at] == hashes]]

    def ascending(self, hashes: np.ndarray) -> np.ndarray:
        return np.sort(self.of(hashes))


def pieces_at_blanks(points: np.ndarray) -> Iterator[np.ndarray]:
    blanks, start = np.flatnonzero(points == 32), 0
    while start < len(points):
        k = int(np.searchsorted(blanks, start + WINDOW))
        end = int(blanks[k]) if k < len(blanks) else len(points)
        yield points[start:end]
        start = end + 1


class Fingerprinter:
    """Fingerprints against one lexicon.

    A term is in about 6 of the thinned lexicons; they are kept as lists, with the two halves
    of the term's hash, so that sums of hashes are exact in doubles.
    """

    def __init__(self, terms: tuple[str, ...]):
        self.numbers = Numbers(terms)
        rates = np.repeat(np.array(RATES, dtype=np.uint32), EACH)
        subsets, high, low, ends = [], [], [], [0]
        for t in terms:
            draws = np.frombuffer(hashlib.shake_128(t.encode()).digest(8 + 4 * SUBSETS), dtype="<u4")
            member = np.flatnonzero(draws[2:] % rates == 0)
            subsets.append(member.astype(np.uint8))
            high.append(np.full(len(member), draws[1], dtype=np.uint32))
            low.append(np.full(len(member), draws[0], dtype=np.uint32))
            ends.append(ends[-1] + len(member))
        empty = [np.zeros(0, dtype=np.uint32)]
        self.subsets, self.high, self.low = (np.concatenate(x or empty) for x in (subsets, high, low))
        self.start, self.size = np.array(ends[:-1], dtype=np.int64), np.diff(np.array(ends, dtype=np.int64))

    def hashes(self, terms: np.ndarray) -> np.ndarray:
        """One 16-bit hash (1 to 65535) per subset, 0 where the text has no term of it; none of fewer than FEW terms."""
        ids = self.numbers.of(terms)
        if len(ids) < FEW:
            return np.zeros(0, dtype=np.uint16)
        n = self.size[ids]
        at = np.arange(n.sum()) + np.repeat(self.start[ids] - (np.cumsum(n) - n), n)
        # equal sets of distinct terms, equal sums of their hashes (modulo 2 ** 64)
        high, low = (np.bincount(self.subsets[at], weights=x[at], minlength=SUBSETS).astype(np.uint64) for x in (self.high, self.low))
        sums = (high << np.uint64(32)) + low
        return np.where(sums == 0, 0, 1 + (sums >> np.uint64(40)) % np.uint64(65535)).astype(np.uint16)

    def fingerprint(self, text: str) -> str:
        """SPARE least hashes, then those of the thinned lexicons if there are FEW terms for them."""
        terms = term_hashes(text)
        if not len(terms):
            return "t" + xxhash.xxh3_128_hexdigest(text.encode())
        return np.concatenate([least_hashes(terms), self.hashes(terms)]).astype(">u2").tobytes().hex()


#: Orders of the terms: a hash is mixed with the one, then multiplied by the other, odd.
_MIX, _TIMES = np.frombuffer(hashlib.shake_128(b"orders").digest(16 * SPARE), dtype="<u8").reshape(2, SPARE).astype(np.uint64)
_TIMES = _TIMES | np.uint64(1)


def least_hashes(terms: np.ndarray) -> np.ndarray:
    """16 bits of the least hash of all terms (given by theirs) under each order: equal for two
    texts as often as the share of their terms that they have in common."""
    least = ((terms[:, None] ^ _MIX) * _TIMES).min(axis=0)
    return (least & np.uint64(0xFFFF)).astype(np.uint16)


@remembers
@lru_cache(maxsize=2)
def fingerprinter(terms: tuple[str, ...]) -> Fingerprinter:
    """One per Python worker and lexicon, whatever the number of tasks."""
    return Fingerprinter(terms)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes, about the share that the texts' terms have in common.

    From the thinnest lexicons to the fuller ones, until ENOUGH subsets have terms of
    either text: there a subset holds about one term, and its hash says whether both
    texts have it. Fuller ones would only ask whether all of many terms are the same.
    """
    if a == b:
        return 1.0
    if a[:1] == "t" or b[:1] == "t":
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(f), dtype=">u2") for f in (a, b))
    if min(len(x), len(y)) == SPARE:  # one of them has too few lexicon terms
        return float((x[:SPARE] == y[:SPARE]).mean())
    x, y = (f[SPARE:].reshape(len(RATES), EACH)[::-1] for f in (x, y))
    either = (x != 0) | (y != 0)
    used = int(np.searchsorted(np.cumsum(either.sum(axis=1)), ENOUGH)) + 1
    some = either[:used].sum()
    return float(((x == y) & either)[:used].sum() / some) if some else 0.0


def fingerprints(docs: DataFrame, terms: tuple[str, ...], into: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of the column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    at = docs.columns.index("text")
    schema = docs.select("*", F.lit("").alias(into)).schema

    def run(batches):
        maker = fingerprinter(shared.value)
        for b in batches:
            found = [maker.fingerprint(t or "") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string())], names=[*b.schema.names, into])

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Runs:
    """Borders between runs of documents in order: a run begins at its border."""

    borders: list[tuple[bool, int, int]]

    def of(self, key: tuple[bool, int, int]) -> int:
        return bisect.bisect_right(self.borders, key)


def find_runs(keys: DataFrame, runs: int) -> Runs:
    """Borders of about equal runs, from a sample of about 100 keys a run."""
    n = keys.count()
    part = keys if n <= 100 * runs else keys.sample(100 * runs / n, seed=1)
    got = sorted((r["none"], r["doc_id"] or 0, r["h"]) for r in part.collect())
    return Runs(sorted({got[i * len(got) // runs] for i in range(1, runs)}) if got else [])


def with_next(docs: DataFrame, each, columns: str, text_bytes: int) -> DataFrame:
    """Rows of ``each(state, doc_id, text, next text)`` over all documents in order.

    Documents are dealt to runs by sampled borders, one run to a task, and sorted inside each; the first
    document of a run is also sent, as its tail, to the run before. Texts travel packed.
    ``each`` makes a function of (doc_id, text, next text) in every task.
    """
    none, h = F.col("doc_id").isNull(), F.xxhash64("text")
    runs = find_runs(docs.select("doc_id", none.alias("none"), h.alias("h")),
                     max(MIN_RUNS, text_bytes // RUN_BYTES))

    def firsts(batches):
        least: dict[int, tuple] = {}
        for b in batches:
            for key in zip(b["none"].to_pylist(), [d or 0 for d in b["doc_id"].to_pylist()], b["h"].to_pylist()):
                run = runs.of(key)
                least[run] = min(key, least.get(run, key))
        yield pa.RecordBatch.from_pydict({
            "run": pa.array(list(least), pa.int32()), "none": pa.array([k[0] for k in least.values()], pa.bool_()),
            "id": pa.array([k[1] for k in least.values()], pa.int64()), "h": pa.array([k[2] for k in least.values()], pa.int64())})

    found = (docs.select("doc_id", none.alias("none"), h.alias("h"))
             .mapInArrow(firsts, "run int, none boolean, id long, h long")
             .groupBy("run").agg(F.min(F.struct("none", "id", "h")).alias("key")).collect())  # one row per run
    used = sorted(r["run"] for r in found)
    before = {run: used[i - 1] for i, run in enumerate(used)}  # of the first run: the last
    first = {r["run"]: tuple(r["key"]) for r in found}

    def deal(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("run", "tail", "none", "doc_id", "h", "packed")}
            for d, hash_, text in zip(b["doc_id"].to_pylist(), b["h"].to_pylist(), b["text"].to_pylist()):
                key = (d is None, d or 0, hash_)
                run = runs.of(key)
                packed = packer.compress((text or "").encode())
                for r, tail in ((run, False), (before[run], True)) if key == first[run] else ((run, False),):
                    for c, v in zip(out, (r, tail, d is None, d, hash_, packed)):
                        out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["run"], pa.int32()), pa.array(out["tail"], pa.bool_()), pa.array(out["none"], pa.bool_()),
                 pa.array(out["doc_id"], pa.int64()), pa.array(out["h"], pa.int64()), pa.array(out["packed"], pa.binary())],
                list(out))

    rows = (docs.select("doc_id", h.alias("h"), "text")
            .mapInArrow(deal, "run int, tail boolean, none boolean, doc_id long, h long, packed binary")
            .repartitionById(max(MIN_RUNS, text_bytes // RUN_BYTES), "run")
            .sortWithinPartitions("run", "tail", "none", "doc_id", "h"))

    def walk(batches):
        make, finish = each()
        unpacker = zstandard.ZstdDecompressor()
        run = waiting = None
        for b in batches:
            out = []
            for r, tail, d, packed in zip(b["run"].to_pylist(), b["tail"].to_pylist(), b["doc_id"].to_pylist(), b["packed"]):
                if waiting is None and tail and r == run:
                    continue  # a further copy of the tail
                state = make(d, unpacker.decompress(packed.as_py()).decode())
                if waiting is not None and r == run:
                    out.append(finish(waiting, state))
                run, waiting = r, None if tail else state
            yield out

    def run_all(batches):
        names = [c.split()[0] for c in columns.split(", ")]
        for out in walk(batches):
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)))))

    return rows.mapInArrow(run_all, columns)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(lexicon(docs))

    def each():
        maker = fingerprinter(shared.value)

        def make(doc_id, text):
            return doc_id, text, maker.fingerprint(text)

        def finish(doc, following):
            doc_id, text, own = doc
            changed = edited(text, following[1])
            other = own if changed == text else maker.fingerprint(changed)
            return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other,
                    likeness(own, other), likeness(own, following[2]))

        return make, finish

    return with_next(docs, each, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double", text_bytes)
