"""Exact token counts of every prefix of a text.

A dynamic program over prefixes (see ``pieces.py``) gives, for each character of a text,
how many tokens the text up to there has when encoded by itself. Blanks and line ends
cut a text into segments that do not influence each other, so segments are worked out
once and the counts of a text are the running sum over its segments. That array is
stored packed with its document; "how many tokens", "how many up to here" and "how much
fits" are answered from it, without the text.

Defined results: null is as the empty text, 0 tokens; a literal U+2581 counts as the
blank that the library takes it for; special strings are ordinary text; repeated rows
are counted each. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, written
from cartwheel.llm.pieces import SPACE, PieceModel, piece_model

LIMIT = 4096
#: Texts whose new segments are worked out together.
GROUP = 512


class PrefixCounter:
    """Prefix counts of texts, remembering the segments of earlier ones."""

    REMEMBER = 500_000
    #: Longer segments are worked out each time.
    SHORT = 48

    def __init__(self, model: PieceModel):
        self.model = model
        self.known: dict[str, bytes] = {}

    def learn(self, segments: set[str]) -> dict[str, bytes]:
        """Counts of new segments, those with a common beginning together."""
        if len(self.known) + len(segments) > self.REMEMBER:
            self.known = {}
        found = {}
        for s, counts, _, _ in self.model.prefixes(sorted(x.replace(" ", SPACE) for x in segments)):
            found[s.replace(SPACE, " ")] = np.array(counts[1:], dtype=np.int32).tobytes()
        self.known.update((k, v) for k, v in found.items() if len(k) <= self.SHORT)
        return found

    def cut(self, text: str | None) -> list[str]:
        # the library puts a blank before every text
        return self.model.segments.findall(" " + text.replace(SPACE, " ")) if text else []

    def many(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Tokens of text[:0], text[:1], ..., text, for each text: one number more than characters."""
        parts = [self.cut(t) for t in texts]
        fresh = set().union(*parts).difference(self.known)
        kept = self.known
        found = self.learn(fresh)
        for p in parts:
            if not p:
                yield np.zeros(1, dtype=np.int64)
                continue
            inside = np.frombuffer(b"".join([kept.get(x) or found[x] for x in p]), dtype=np.int32).astype(np.int64)
            sizes = np.fromiter(map(len, p), dtype=np.int64, count=len(p))
            ends = inside[np.cumsum(sizes) - 1]
            inside += np.repeat(np.cumsum(ends) - ends, sizes)
            inside[0] = 0  # that first blank
            yield inside


def fits(counts: np.ndarray, budget: int) -> int:
    """Most characters from the start that encode to at most ``budget`` tokens.

    A longer prefix can have fewer tokens (a merge at its end), so the last place at or
    below the budget is taken.
    """
    return int(np.flatnonzero(counts <= budget)[-1])


def pack(counts: np.ndarray) -> bytes:
    """All prefix counts of a text: steps from one to the next, in the fewest bytes that hold
    them, compressed. A step is small whatever the text's length."""
    steps = np.diff(counts)
    low, high = (int(steps.min()), int(steps.max())) if len(steps) else (0, 0)
    kind = next(k for k in ("<i1", "<i2", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return kind[1:].encode() + zstandard.ZstdCompressor(level=1).compress(steps.astype(kind).tobytes())


def unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[2:]), dtype=f"<{packed[:2].decode()}")
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def store_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """The columns of ``docs`` but its text, with n_chars, n_tokens and the packed counts of
    all prefixes (``prefix_counts``). Written once, it answers any question below without
    the text or the tokenizer."""
    at = docs.columns.index("text")
    rest = [c for c in docs.columns if c != "text"]
    extra = [F.lit(0).cast("long").alias("n_chars"), F.lit(0).cast("long").alias("n_tokens"), F.lit(b"").alias("prefix_counts")]
    schema = docs.select(*[F.col(f"`{c}`") for c in rest], *extra).schema

    def run(batches):
        counter = PrefixCounter(piece_model(model_path))
        for b in batches:
            chars, tokens, packed = [], [], []
            for start in range(0, b.num_rows, GROUP):
                for counts in counter.many(b.column(at).slice(start, GROUP).to_pylist()):
                    chars.append(len(counts) - 1)
                    tokens.append(int(counts[-1]))
                    packed.append(pack(counts))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in rest], pa.array(chars, pa.int64()), pa.array(tokens, pa.int64()), pa.array(packed, pa.binary())],
                names=[*rest, "n_chars", "n_tokens", "prefix_counts"])

    return docs.mapInArrow(run, schema)


def _answers(rows: DataFrame, ask: dict[str, tuple[str, object]]) -> DataFrame:
    """``rows`` (with the store's columns) without prefix_counts, and a column for each of
    ``ask``: its name, the column of the question and the function of (counts, question)."""
    rest = [c for c in rows.columns if c != "prefix_counts"]
    schema = rows.select(*[F.col(f"`{c}`") for c in rest], *[F.lit(None).cast("long").alias(n) for n in ask]).schema

    def run(batches):
        for b in batches:
            n, counts, last = b.num_rows, None, None
            out: dict[str, list] = {name: [] for name in ask}
            packed, sizes, tokens = b["prefix_counts"], b["n_chars"].to_pylist(), b["n_tokens"].to_pylist()
            questions = {name: b[column].to_pylist() for name, (column, _) in ask.items()}
            for k in range(n):
                for name, (_, answer) in ask.items():
                    q = questions[name][k]
                    if q is None or q < 0:
                        out[name].append(None)
                    elif name == "fitting_chars" and tokens[k] <= q:
                        out[name].append(sizes[k])
                    elif name == "cut_tokens" and q >= sizes[k]:
                        out[name].append(tokens[k])
                    else:
                        data = packed[k].as_py()
                        if data != last:  # questions about one document stand together
                            counts, last = unpack(data), data
                        out[name].append(answer(counts, q))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], *[pa.array(v, pa.int64()) for v in out.values()]],
                                             names=[*rest, *ask])

    return rows.mapInArrow(run, schema)


def answer_budgets(store: DataFrame, questions: DataFrame, key: str = "doc_id") -> DataFrame:
    """``questions`` (key, budget) with the most characters from the start that encode to at
    most ``budget`` tokens (``fitting_chars``; null if the budget is null or below 0)."""
    rows = questions.join(store.select(key, "n_chars", "n_tokens", "prefix_counts"), key)
    return _answers(rows, {"fitting_chars": ("budget", fits)}).select(*questions.columns, "fitting_chars")


def answer_cuts(store: DataFrame, questions: DataFrame, key: str = "doc_id") -> DataFrame:
    """``questions`` (key, cut) with the tokens of the first ``cut`` characters (``cut_tokens``)."""
    rows = questions.join(store.select(key, "n_chars", "n_tokens", "prefix_counts"), key)
    return _answers(rows, {"cut_tokens": ("cut", lambda counts, cut: int(counts[cut]))}).select(*questions.columns, "cut_tokens")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they are more than the limit, from stored counts."""
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    store = written(store_counts(docs, public_tokenizers.path("piece_bpe_32k.model")), "prefix_counts")
    found = _answers(store.withColumn("budget", F.lit(LIMIT).cast("long")), {"fitting_chars": ("budget", fits)})
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fitting_chars")
