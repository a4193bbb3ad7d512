"""Toxicity by a weighted lexicon.

Texts are folded (case, accents dropped, homoglyphs, digits for letters), then an
Aho-Corasick automaton finds every term of the lexicon in one pass. A term counts where
it begins a word, and a whole-word term where it is one; the longest term at a place
counts, and none counts inside an exception phrase. The summed weights, divided by the
length, go through a fitted logistic curve.

The lexicon is learned: words and beginnings of words whose share among toxic texts is
far above that among the others (a likelihood-ratio test guards against chance), with
their log odds as weights. Words that begin like a term but are no rarer in clean texts
become exceptions. Learning reads a sample of the labelled rows of at most about
``SAMPLE`` texts of each class, chosen by a hash of the text.

Defined results: null, empty and blank texts have no match and get the score of a text
without matches, as every text does if there was nothing to learn from. Repeated rows
are scored each; a row with several labels is learned from once per label. Only the
named columns are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, is_held_out

SAMPLE = 4000
#: Beginnings of words that may become terms.
PREFIXES = range(4, 9)
#: Least log-likelihood ratio (chance below about 1 in 10 million) and log odds of a term.
MIN_GAIN, MIN_ODDS = 15.0, 2.0

# Letters of other scripts that look like a Latin letter, and digits and
# signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ѡ": "w", "х": "x",
    "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ß": "s",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

#: A digit or sign stands for a letter between letters of a word, and one before two of them.
_DISGUISED = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|(?<![\w@$!])[0134578@$](?=[^\W\d_][^\W_])")
_DIGIT_MAP = str.maketrans(DIGITS)
_GLYPH_MAP = str.maketrans(HOMOGLYPHS)
_MARKS = re.compile("[̀-ͯ​-‏⁠﻿]")
_FOREIGN = re.compile(f"[{''.join(HOMOGLYPHS)}]")  # every letter that the map has
_WORDS = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case, compatibility forms, look-alikes and digits as the letters they stand for.

    An accented letter folds to the letter without its accents.
    """
    text = text.lower()
    if not text.isascii():
        # apart, so that accents are marks of their own; what is left is composed again (Hangul)
        text = unicodedata.normalize("NFKC", _MARKS.sub("", unicodedata.normalize("NFKD", text)))
        if _FOREIGN.search(text):
            text = text.translate(_GLYPH_MAP)
    return _DISGUISED.sub(lambda m: m.group().translate(_DIGIT_MAP), text)


def features(text: str) -> set[str]:
    """Whole words (marked by a final blank) and beginnings of words."""
    out = set()
    for w in set(_WORDS.findall(fold(text))):
        out.add(w + " ")
        out.update(w[:k] for k in PREFIXES if len(w) >= k)
    return out


@dataclass
class Lexicon:
    """Terms with weights (a final blank: whole words only), exception phrases, and the
    curve: score = 1 / (1 + exp(-(bias + slope * density)))."""

    terms: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    bias: float = -2.0
    slope: float = 1.0

    def automaton(self) -> ahocorasick.Automaton | None:
        found: dict[str, list] = {}
        for term, weight in self.terms.items():
            found.setdefault(term.rstrip(" "), [None, None, False])[term.endswith(" ")] = weight
        for phrase in self.exceptions:
            found.setdefault(fold(phrase), [None, None, False])[2] = True
        if not found:
            return None
        a = ahocorasick.Automaton()
        for key, value in found.items():
            a.add_word(key, (len(key), *value))
        a.make_automaton()
        return a


def matched(folded: str, automaton: ahocorasick.Automaton | None) -> float:
    """Summed weight of the terms in a folded text."""
    if automaton is None:
        return 0.0
    best: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, begins, whole, exception) in automaton.iter(folded):
        start = end + 1 - size
        if start and folded[start - 1].isalpha():
            continue
        closed = end + 1 == len(folded) or not folded[end + 1].isalpha()
        if exception and closed:
            spared.append((start, end))
        weight = whole if closed and whole is not None else begins
        if weight is not None and best.get(start, (0, 0.0))[0] <= size:
            best[start] = (size, weight)
    if spared:
        reach, at = -1, 0
        spared.sort()
        kept = 0.0
        for start in sorted(best):
            while at < len(spared) and spared[at][0] <= start:
                reach, at = max(reach, spared[at][1]), at + 1
            if start > reach:
                kept += best[start][1]
        return kept
    return sum(w for _, w in best.values())


def density(text: str | None, automaton: ahocorasick.Automaton | None) -> float:
    """log(1 + weight per 100 characters): long texts need more matches for the same score."""
    if not text:
        return 0.0
    return math.log1p(100.0 * matched(fold(text), automaton) / (len(text) + 20.0))


def sample_labels(labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """About ``per_class`` rows (doc_id, toxic) of each class, by a hash of the id."""
    labels = labels.select("doc_id", "toxic").where("toxic in (0, 1)").distinct()
    n = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}  # two rows
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / max(n.get(1, 0), 1))).otherwise(
        min(1.0, per_class / max(n.get(0, 0), 1)))
    return labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)


def labelled_texts(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """(text, toxic) of the sampled labels. The sample is bounded, so it is what is sent:
    the documents are scanned where they are."""
    return (docs.select("doc_id", "text").where("text is not null")
            .join(F.broadcast(sample_labels(labels, per_class)), "doc_id")
            .dropDuplicates(["doc_id", "text", "toxic"]).select("text", "toxic"))


def learn(rows: DataFrame, tasks: int = 6) -> Lexicon:
    """Lexicon and curve from a bounded sample of rows (text, toxic 0 or 1)."""
    chosen = rows.repartition(tasks).persist()
    try:
        n = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
        bad, good = n.get(1, 0), n.get(0, 0)
        if not bad or not good:
            return Lexicon({}, bias=5.0 if bad else -5.0)

        def count(batches):
            seen = (Counter(), Counter())
            for b in batches:
                for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                    seen[toxic].update(features(text))
            keys = list(seen[1])  # a feature of no toxic text is never a term
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()),
                 pa.array([0] * len(keys), pa.int64())], ["feature", "bad", "good"])
            keys = list(seen[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([0] * len(keys), pa.int64()),
                 pa.array([seen[0][k] for k in keys], pa.int64())], ["feature", "bad", "good"])

        counts = chosen.mapInArrow(count, "feature string, bad long, good long").groupBy("feature").agg(
            F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        b, g = F.col("bad"), F.col("good")
        odds = F.log((b + 0.5) / (bad - b + 0.5)) - F.log((g + 0.5) / (good - g + 0.5))
        q, p = b / (b + g), bad / (bad + good)
        gain = (b + g) * (q * F.log(q / p) + F.when(g > 0, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0))
        strong = counts.where(b > 0).where((odds >= MIN_ODDS) & (gain >= MIN_GAIN))
        terms = {r["feature"]: (r["bad"], r["good"], r["odds"])
                 for r in strong.select("feature", "bad", "good", odds.alias("odds")).collect()}
        # of a beginning and a longer one that explains nearly as much, the longer is meant
        names = sorted(terms)
        kept = dict(terms)
        for name in names:
            stem = name.rstrip(" ")
            for k in PREFIXES:
                short = stem[:k]
                if k < len(stem) or (k == len(stem) and name != stem):
                    if short in kept and short != name and terms[name][0] >= 0.98 * terms[short][0]:
                        kept.pop(short)
        lexicon = Lexicon({k: float(v[2]) for k, v in kept.items()})
        # whole words that begin like a term, and are as usual in clean texts as in toxic ones
        stems = sorted({k for k in kept if not k.endswith(" ")})
        if stems:
            word = F.rtrim(F.col("feature"))
            usual = counts.where(F.col("feature").endswith(" ") & (g >= 3) & (g * bad >= b * good)).select(
                word.alias("word"), F.explode(F.array(*[F.when(F.length(word) >= k, F.substring(word, 1, k)) for k in PREFIXES])).alias("stem"))
            known = chosen.sparkSession.createDataFrame([(s,) for s in stems], "stem string")
            lexicon.exceptions = [r["word"] for r in usual.join(known, "stem", "left_semi").select("word").distinct().collect()]

        def weigh(batches):
            automaton = lexicon.automaton()
            for b in batches:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([density(t, automaton) for t in b["text"].to_pylist()]), b["toxic"].cast(pa.int64())],
                    ["x", "y"])

        # one number and a label of every sampled text
        points = chosen.mapInArrow(weigh, "x double, y long").toPandas()
        lexicon.bias, lexicon.slope = logistic(points["x"].to_numpy(), points["y"].to_numpy())
        return lexicon
    finally:
        chosen.unpersist()


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> tuple[float, float]:
    """(bias, slope) of a logistic curve, classes weighted alike; a ridge keeps separable data finite."""
    weight = np.where(y == 1, 0.5 / max((y == 1).mean(), 1e-9), 0.5 / max((y == 0).mean(), 1e-9))
    a = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        slope = design.T @ (weight * (p - y)) / len(x) + ridge * 1e-2 * a
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design / len(x) + ridge * 1e-2 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        a = a - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(a[0]), float(a[1])


def score(docs: DataFrame, lexicon: Lexicon, into: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of the column ``text``."""
    at = docs.columns.index("text")
    schema = docs.select("*", F.lit(0.0).alias(into)).schema

    def run(batches):
        automaton = lexicon.automaton()
        for b in batches:
            x = np.array([density(t, automaton) for t in b.column(at).to_pylist()], dtype=float)
            found = 1 / (1 + np.exp(-np.clip(lexicon.bias + lexicon.slope * x, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], names=[*b.schema.names, into])

    return docs.mapInArrow(run, schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~is_held_out(F.col("doc_id")))
    lexicon = learn(labelled_texts(docs, labels))
    found = score(docs.select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held_out")), lexicon)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
