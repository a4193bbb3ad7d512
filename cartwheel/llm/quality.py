"""Quality rules with host verdicts.

Every document gets a few counts and the rules it breaks. Failures are then summed by
host; a host's failure rate under each rule is shrunk towards the rate of all hosts
with a beta prior fitted to the hosts themselves (empirical Bayes), so a host with few
documents is judged by the corpus and one with many by its own record. A host whose
shrunken rate exceeds the limit, and is at least WORSE times the rate of all other hosts'
documents, loses all its documents; the verdicts, one row per host, are joined back to the
documents. A lone host has no others to be worse than, and keeps its documents.

Defined results: a null or blank text has no words and breaks the length rule; a null
host is a host of its own; repeated rows count and are judged each; extra columns are
kept or ignored, whatever their names; an empty table gives an empty result.

DataFrame functions only. Sums by host are combined before the shuffle, so a host with
a third of all rows costs one partial row per task. The verdicts are written first, and their
size is read back: up to SENT_BYTES of bad hosts are broadcast, whatever the plan's estimate, so
documents stay where they are. More of them are joined by host, the documents of hosts with a
large share of the rows by broadcast still.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import BLANKS, documents, join_by_share, written

SYMBOLS = "#*$%&|<>"
#: A bad host fails so many times as often as the documents of all other hosts, at least.
WORSE = 2.0
#: The prior weighs as much as so many documents of a host, at least and at most.
STRENGTH = (20.0, 1e6)
WINDOW = 8
#: Most bytes of names of bad hosts, and 16 for each, that are broadcast.
SENT_BYTES = 8 << 20


@dataclass(frozen=True)
class Limits:
    """Rule limits; ``host_rate`` is the shrunken failure rate above which a host goes."""

    min_words: int = 20
    max_repeat_pct: int = 30
    max_symbol_pct: int = 10
    max_dup_line_pct: int = 30
    host_rate: float = 0.6


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def by_window(hashes: Column) -> Column:
    """(hash, position) of every window, sorted: equal windows stand side by side."""
    return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def repeated_places(sorted_windows: Column) -> Column:
    """Ascending positions of the windows with an equal neighbour in sorted order."""
    def twice(e: Column, i: Column) -> Column:
        # position -1 (before the first) gives null, as does the one after the last
        before = F.when(i > 0, F.get(sorted_windows, i - 1)["h"])
        return before.eqNullSafe(e["h"]) | F.get(sorted_windows, i + 1)["h"].eqNullSafe(e["h"])

    return F.array_sort(F.transform(F.filter(sorted_windows, twice), lambda e: e["i"]))


def covered(places: Column) -> Column:
    """Words in those windows: ``WINDOW`` for each, less its overlap with the next."""
    gaps = F.transform(places, lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)


def add_counts(docs: DataFrame, text: str = "text", prefix: str = "__q_") -> DataFrame:
    """Append the counts of every whole text as ``<prefix>n_words`` and so on."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    p = prefix
    df = docs.withColumns({
        f"{p}words": words,
        f"{p}word_chars": F.length(F.translate(t, BLANKS, "")).cast("long"),
        f"{p}n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        f"{p}lines": lines,
    })
    df = df.withColumns({
        f"{p}n_words": F.size(f"{p}words").cast("long"),
        f"{p}n_lines": F.size(f"{p}lines").cast("long"),
        f"{p}n_dup_lines": (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"),
        f"{p}windows": F.when(
            F.size(f"{p}words") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size(f"{p}words") - (WINDOW - 1)),
                        lambda i: F.xxhash64(F.slice(F.col(f"{p}words"), i, WINDOW)))),
    }).drop(f"{p}words", f"{p}lines")
    # every step that looks into an array by position reads it from a column, so that it
    # is built once; most texts repeat no window and stop at the first step
    df = df.withColumn(f"{p}sorted", F.when(
        F.size(F.array_distinct(f"{p}windows")) < F.size(f"{p}windows"), by_window(F.col(f"{p}windows"))))
    df = df.withColumn(f"{p}places", repeated_places(F.col(f"{p}sorted")))
    return df.withColumn(
        f"{p}n_repeat_words",
        F.when(F.col(f"{p}places").isNull(), F.lit(0)).otherwise(covered(F.col(f"{p}places"))).cast("long"),
    ).drop(f"{p}windows", f"{p}sorted", f"{p}places")


def rules(prefix: str = "__q_", limits: Limits = Limits()) -> dict[str, Column]:
    c = lambda name: F.col(prefix + name)
    return {
        "short": c("n_words") < limits.min_words,
        "repeats": 100 * c("n_repeat_words") > limits.max_repeat_pct * c("n_words"),
        "symbols": 100 * c("n_symbols") > limits.max_symbol_pct * c("word_chars"),
        "dup_lines": 100 * c("n_dup_lines") > limits.max_dup_line_pct * c("n_lines"),
    }


#: A document that breaks one of these goes by itself; the others only speak against its host.
BASE_RULES = ("short", "repeats")


def host_sums(judged: DataFrame, host: str, failed: dict[str, Column]) -> DataFrame:
    """One row per host: its documents and the failures of each rule."""
    return judged.groupBy(F.col(host).alias("__host")).agg(
        F.count(F.lit(1)).alias("__docs"),
        *[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(f"__f_{k}") for k, c in failed.items()])


def beta_priors(sums: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """Prior mean and strength of each rule, by the method of moments over all hosts.

    The largest STRENGTH stands for hosts that differ no more than chance would make
    them differ.
    """
    n, docs = F.col("__docs").cast("double"), F.sum(F.col("__docs").cast("double"))
    cols = [docs.alias("n"), F.count(F.lit(1)).alias("hosts"), F.sum(n * n).alias("n2")]
    for k in names:
        f = F.col(f"__f_{k}")
        cols += [F.sum(f).alias(f"f_{k}"), F.sum(f * f / n).alias(f"s_{k}")]
    row = sums.agg(*cols).first()  # one row of sums
    out = {}
    for k in names:
        total = row["n"] or 0.0
        if not total:
            out[k] = (0.0, STRENGTH[0])
            continue
        mean = row[f"f_{k}"] / total
        within = mean * (1 - mean)
        spread = max(row[f"s_{k}"] / total - mean * mean, 0.0)
        share = 1 - row["n2"] / (total * total)
        between = (spread - within * (row["hosts"] - 1) / total) / share if share > 1e-12 else 0.0
        strength = within / between - 1 if between > within / STRENGTH[1] else STRENGTH[1]
        out[k] = (mean, min(max(strength, STRENGTH[0]), STRENGTH[1]))
    return out


def bad_hosts(sums: DataFrame, priors: dict[str, tuple[float, float]], limits: Limits = Limits()) -> DataFrame:
    """``__host`` of every host whose shrunken failure rate is above the limit for some rule."""
    row = sums.agg(F.sum("__docs").alias("n"), *[F.sum(f"__f_{k}").alias(f"f_{k}") for k in priors]).first()  # one row of sums
    others, bad = F.lit(row["n"] or 0) - F.col("__docs"), F.lit(False)
    for k, (mean, strength) in priors.items():
        shrunk = (F.col(f"__f_{k}") + mean * strength) / (F.col("__docs") + strength)
        # multiplied out: a lone host has no others
        worse = (others > 0) & (shrunk * others >= WORSE * (F.lit(row[f"f_{k}"] or 0) - F.col(f"__f_{k}")))
        bad = bad | ((shrunk > limits.host_rate) & worse)
    return sums.where(bad).select("__host", F.lit(True).alias("__host_bad"))


def judge(docs: DataFrame, host: str = "source", keep: list[str] | None = None,
          limits: Limits = Limits()) -> DataFrame:
    """The columns ``keep`` (default: all), the counts ``__q_*``, ``__base_failed`` and ``__kept``.

    The counted documents are written once: host sums and the result both read them.
    """
    counted = add_counts(docs)
    failed = rules(limits=limits)
    base = F.lit(False)
    for k in BASE_RULES:
        base = base | failed[k]
    columns = list(docs.columns) if keep is None else list(keep)
    judged = written(counted.select(
        *columns, F.col(host).alias("__q_host"),
        *[f"__q_{c}" for c in COUNTS], base.alias("__base_failed"),
        *[failed[k].alias(f"__q_rule_{k}") for k in failed]), "quality")
    sums = host_sums(judged, "__q_host", {k: F.col(f"__q_rule_{k}") for k in failed})
    verdicts = written(bad_hosts(sums, beta_priors(sums, list(failed)), limits), "bad_hosts")
    same = F.col("__q_host").eqNullSafe(F.col("__host"))
    size = verdicts.agg(F.sum(16 + F.coalesce(F.octet_length("__host"), F.lit(0)))).first()[0] or 0
    if size <= SENT_BYTES:
        marked = judged.join(F.broadcast(verdicts), same, "left")
    else:
        # one row for each host, bad or not, with its share of the rows
        all_hosts = written(sums.select(F.col("__host").alias("__q_host"), F.col("__docs").alias("__n")).join(
            verdicts, same, "left").select("__q_host", "__n", "__host", "__host_bad"), "host_verdicts")
        marked = join_by_share(judged, all_hosts, ["__q_host"], judged.count())
    return (marked
            .withColumn("__kept", ~F.col("__base_failed") & F.col("__host_bad").isNull())
            .drop("__host", "__host_bad", "__q_host", *[f"__q_rule_{k}" for k in failed]))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base failure and final verdict of every document; hosts are the sources."""
    out = judge(documents(spark, sf_dir).select("doc_id", "text", "source"), keep=["doc_id"])
    return out.select(
        "doc_id", *[F.col(f"__q_{c}").alias(c) for c in
                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))
