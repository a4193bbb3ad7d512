"""Language of texts, and of the spans of mixed texts.

A word's script narrows the candidate languages; hashed character n-grams score the
word under each of them; Viterbi over the words of a text, with a penalty for every
change of language, labels its spans. The text's language is the one with most letters.

The model is a table of n-gram log probabilities by language, counted on a sample of
labelled rows: about ``PER_LANG`` texts of each language (all of them where there are
fewer), chosen by a hash of the text. It has BUCKETS x languages numbers, whatever the
size of the input.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is
everything if there was nothing to learn from. A letter of a script that no learned
language uses says nothing and takes the language around it; a text of such letters
alone gets score 0. Ties go to the language first in order. Repeated rows are labelled
each. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, forget_others, is_held_out, letter_words, letters_only

PER_LANG = 2000
BUCKETS = 1 << 17
GRAMS = (1, 2, 3, 4)
#: Log-likelihood lost by one change of language inside a text.
SWITCH = 12.0
#: A language uses a script if so much of its letters are of it.
SCRIPT_SHARE = 0.02
UNKNOWN = "und"
#: Texts that a task labels together.
GROUP = 256

LETTERS = re.compile(r"[^\W\d_]+")

# First code points of Unicode's larger blocks of letters, with their script.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "thaana"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_STARTS = np.array([s for s, _ in SCRIPT_STARTS])
_SCRIPT_AT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])


def script_of(first_letters: np.ndarray) -> np.ndarray:
    return _SCRIPT_AT[np.searchsorted(_STARTS, first_letters, side="right") - 1]


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of the words, ends marked."""
    points = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), dtype=np.uint32)
    edge = points == 0
    word_at = np.cumsum(edge) - 1
    numbers, buckets = [], []
    code = points.astype(np.uint64)
    for n in GRAMS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n, dtype=np.uint64)
        fine = np.ones(size, dtype=bool)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + code[k:k + size]
            if n == 1 or 0 < k < n - 1:
                fine &= ~edge[k:k + size]  # an edge only at the ends of a gram
        if n == 2:
            fine &= ~(edge[:size] & edge[1:1 + size])
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        numbers.append(word_at[:size][fine])
        buckets.append(((h >> np.uint64(40)) % np.uint64(BUCKETS))[fine].astype(np.int64))
    return np.concatenate(numbers), np.concatenate(buckets)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (languages, BUCKETS) log probabilities
    allowed: np.ndarray  # (scripts, languages) True where the language uses the script

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(words, languages) log-likelihood of each word, 0 where its script says nothing."""
        number, bucket = gram_buckets(words)
        out = np.stack([np.bincount(number, weights=row[bucket], minlength=len(words))
                        for row in self.table], axis=1) / len(GRAMS)
        can = self.allowed[script_of(np.array([ord(w[0]) for w in words]))]
        return np.where(can.any(axis=1)[:, None], np.where(can, out, -1e4), 0.0).astype(np.float32)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best labels (time, texts) for scores (time, texts, languages), padded with 0 at the end."""
    steps, texts, _ = scores.shape
    value = scores[0].astype(np.float64)
    stayed = np.ones(scores.shape, dtype=bool)
    best = np.zeros((steps, texts), dtype=np.int16)
    rows = np.arange(texts)
    for t in range(1, steps):
        top = value.argmax(axis=1)
        jump = value[rows, top] - switch
        best[t] = top
        stayed[t] = value >= jump[:, None]
        value = np.where(stayed[t], value, jump[:, None]) + scores[t]
    labels = np.zeros((steps, texts), dtype=np.int16)
    # padding adds 0 and never pays for a switch: the last label is that of the last word
    labels[-1] = value.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        labels[t - 1] = np.where(stayed[t, rows, labels[t]], labels[t], best[t])
    return labels


class Labeller:
    """Labels texts in blocks; remembers the scores of words between blocks."""

    REMEMBER = 200_000
    BLOCK_WORDS = 150_000
    #: Words whose n-grams are counted together.
    SCORED = 10_000

    def __init__(self, model: Model, switch: float = SWITCH):
        self.model, self.switch = model, switch
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs)), dtype=np.float32)

    def numbers(self, words: list[str]) -> np.ndarray:
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if len(self.known) + len(fresh) > self.REMEMBER:
            self.known, fresh = {}, list(dict.fromkeys(words))
            self.scores = self.scores[:0]
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.scores = np.concatenate([self.scores, *[
                self.model.word_scores(fresh[i:i + self.SCORED]) for i in range(0, len(fresh), self.SCORED)]])
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def label(self, texts: list[list[str]]) -> Iterator[tuple[int, np.ndarray]]:
        """(place, label of every word) of every text that has words."""
        order = sorted((i for i, w in enumerate(texts) if w), key=lambda i: len(texts[i]))
        while order:
            steps, block = len(texts[order[-1]]), []
            # one text, however long, or texts of like length that fill the block
            while order and (not block or steps * (len(block) + 1) <= self.BLOCK_WORDS):
                block.append(order.pop())
            lengths = np.array([len(texts[i]) for i in block])
            number = self.numbers([w for i in block for w in texts[i]])
            scores = np.zeros((steps, len(block), self.scores.shape[1]), dtype=np.float32)
            at, ends = 0, np.cumsum(lengths)
            for k, end in enumerate(ends):
                scores[:lengths[k], k] = self.scores[number[at:end]]
                at = end
            labels = viterbi(scores, lengths, self.switch)
            for k, i in enumerate(block):
                yield i, labels[:lengths[k], k]

    def summary(self, texts: Iterable[str | None]) -> list[tuple[str, float, int]]:
        """(language, score, number of spans) of every text."""
        texts = [letter_words(t) for t in texts]
        out: list[tuple[str, float, int]] = [(UNKNOWN, 0.0, 0)] * len(texts)
        if not self.model.langs:
            return out
        for i, labels in self.label(texts):
            size = np.fromiter(map(len, texts[i]), dtype=np.int64, count=len(labels))
            known = self.model.allowed[script_of(np.array([ord(w[0]) for w in texts[i]]))].any(axis=1)
            letters = np.bincount(labels, weights=size, minlength=len(self.model.langs))
            sure = np.bincount(labels, weights=size * known, minlength=len(self.model.langs))
            top = int(letters.argmax())
            out[i] = (self.model.langs[top], float(sure[top] / size.sum()), 1 + int((labels[1:] != labels[:-1]).sum()))
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, language) of the spans of one text, ends of words as borders."""
        found = [(m.start(), m.end(), m.group().lower()) for m in LETTERS.finditer(letters_only(text or ""))]
        if not found or not self.model.langs:
            return []
        (_, labels), = self.label([[w for _, _, w in found]])
        out: list[list] = []
        for (start, end, _), k in zip(found, labels):
            if out and out[-1][2] == self.model.langs[k]:
                out[-1][1] = end
            else:
                out.append([start, end, self.model.langs[k]])
        return [tuple(x) for x in out]


SAMPLE_COLUMNS = "text string, lang string, h long, h2 long"


def first_of_each(batches, seen: set):
    """The rows whose (h, h2, lang) has not been ``seen``; of a bounded sample."""
    for b in batches:
        fresh = []
        for key in zip(*(b[c].to_pylist() for c in ("h", "h2", "lang"))):
            fresh.append(key not in seen)
            seen.add(key)
        yield b.filter(pa.array(fresh, pa.bool_()))


def sampled(rows: DataFrame, per_lang: int = PER_LANG, tasks: int = 6) -> DataFrame:
    """Rows of about ``per_lang`` distinct texts of each language, by a hash of the text, in
    ``tasks`` partitions.

    Copies count once, so that a text with many rows cannot fill the sample, or be all of it:
    a task sends a text once, and what several tasks have sent meets in one partition.
    """
    h = F.xxhash64("text")
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(h, 0.02).alias("n")).collect()  # one row per language
    chance = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_lang / max(r["n"], 1)))]) \
        if counts else F.create_map(F.lit(""), F.lit(0.0))
    chosen = rows.where(F.pmod(h, F.lit(1_000_000)) < F.try_element_at(chance, F.col("lang")) * 1_000_000).select(
        "text", "lang", h.alias("h"), F.xxhash64(F.lit(1), "text").alias("h2"))

    def once(batches):
        forget_others()
        return first_of_each(batches, set())

    return chosen.mapInArrow(once, SAMPLE_COLUMNS).repartition(tasks, "h")


def training_sample(rows: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The distinct texts (text, lang) that a model learns from."""
    return sampled(rows, per_lang).mapInArrow(lambda batches: first_of_each(batches, set()), SAMPLE_COLUMNS).select("text", "lang")


def gram_sums(rows: DataFrame, langs: list[str], per_lang: int = PER_LANG, tasks: int = 6) -> DataFrame:
    """(lang, place, n): n-grams by number of the language and bucket, then letters by script, over
    the sample of (text, lang) rows. A row for each place that is used, whatever the number of tasks."""
    width, numbers = BUCKETS + len(SCRIPTS), {lang: i for i, lang in enumerate(langs)}

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in first_of_each(batches, set()):
            for text, lang in zip(b["text"].to_pylist(), b["lang"].to_pylist()):
                words = letter_words(text)
                if not words:
                    continue
                into = sums.setdefault(lang, np.zeros(width, dtype=np.int64))
                into[:BUCKETS] += np.bincount(gram_buckets(words)[1], minlength=BUCKETS)
                into[BUCKETS:] += np.bincount(script_of(np.array([ord(w[0]) for w in words])),
                                              weights=[len(w) for w in words], minlength=len(SCRIPTS)).astype(np.int64)
        for lang, into in sums.items():
            used = np.flatnonzero(into)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), numbers[lang], dtype=np.int32)),
                                              pa.array(used.astype(np.int32)), pa.array(into[used])], ["lang", "place", "n"])

    # the sums of the tasks meet in Spark: whole tables of every task would fill the driver
    return sampled(rows, per_lang, tasks).mapInArrow(count, "lang int, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))


def train(rows: DataFrame, per_lang: int = PER_LANG, tasks: int = 6) -> Model:
    """Count n-grams by language over a bounded sample of (text, lang) rows."""
    rows = rows.select("text", "lang").where("lang is not null and text is not null")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((len(SCRIPTS), 0), dtype=bool))
    table = np.zeros((len(langs), BUCKETS + len(SCRIPTS)))
    for b in gram_sums(rows, langs, per_lang, tasks).toArrow().to_batches():  # at most a row for each of the model's numbers
        table[b["lang"].to_numpy(), b["place"].to_numpy()] = b["n"].to_numpy()
    grams, scripts = table[:, :BUCKETS] + 0.05, table[:, BUCKETS:]
    return Model(langs, np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32),
                 (scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T)


def identify(docs: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score", spans: str = "n_spans") -> DataFrame:
    """``docs`` with the predicted language, its share of the letters and the number of spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    at = docs.columns.index("text")
    schema = docs.select("*", F.lit("").alias(pred), F.lit(0.0).alias(score), F.lit(0).alias(spans)).schema

    def run(batches):
        forget_others()
        labeller = Labeller(shared.value)
        for b in batches:
            for start in range(0, b.num_rows, GROUP):
                part = b.slice(start, GROUP)
                found = labeller.summary(part.column(at).to_pylist())
                cols = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                        pa.array([f[2] for f in found], pa.int32())]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, pred, score, spans])

    return docs.mapInArrow(run, schema)


def labelled_rows(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: labelled and not held out."""
    return docs.where(~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("text", "lang")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows that are not held out."""
    docs = documents(spark, sf_dir)
    model = train(labelled_rows(docs))
    rows = docs.select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held_out"))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score", "n_spans")
