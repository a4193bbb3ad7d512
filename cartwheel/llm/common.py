"""Helpers shared by the operators: table access, word pattern, held-out rows, scratch."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import scratch_path

#: Words are runs of characters other than these six blanks.
BLANKS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD_PATTERN)
#: Numbers that are neither digits nor letters (as ², ½, ①, Ⅷ), from Unicode's own properties:
#: what ``[^\W\d_]`` has beyond letters.
NUMERALS = re.compile("[" + "".join(
    c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isdecimal() and not c.isalpha()) + "]")
#: A quick look for them: the few below U+0900, and everything above.
_MAYBE_NUMERALS = re.compile("[" + "".join(c for c in map(chr, range(0x900)) if NUMERALS.match(c)) + "\u0900-\U0010ffff]")
_LETTERS = re.compile(r"[^\W\d_]+")
#: A-Z to a-z and nothing else.
LOWER_AZ = {c: c + 32 for c in range(65, 91)}


def letters_only(text: str) -> str:
    """The text with a blank in place of each numeral, so that the pattern finds letters alone."""
    return text if text.isascii() or not _MAYBE_NUMERALS.search(text) else NUMERALS.sub(" ", text)


def letter_words(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    return _LETTERS.findall(letters_only(text).lower()) if text else []


_REMEMBERING: list = []


def remembers(cached):
    """Registers a cached maker of something large that a Python worker keeps between tasks."""
    _REMEMBERING.append(cached)
    return cached


def forget_others() -> None:
    """Drops what earlier operators' tasks have left in this Python worker."""
    for cached in _REMEMBERING:
        cached.cache_clear()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def is_held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text is divisible by 5 (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage in columnar form: later readers take only the columns they need,
    and a lost executor costs a reread, not a recomputation.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_by_share(rows: DataFrame, table: DataFrame, keys: list[str], total: int, most: int = 4096) -> DataFrame:
    """Inner join of ``rows`` with the one row of ``table`` for each key (null equals null).

    ``table`` says in ``__n`` how many of the ``total`` rows have the key. Keys with more than
    total / most rows, fewer than ``most`` of them by counting, are broadcast; no other key
    is heavy, so those are joined as usual. Both inputs are read twice: write them first.
    """
    least = total // most + 1
    columns = [c for c in table.columns if c not in (*keys, "__n")]
    named = table.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *columns, "__n")
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    heavy, light = named.where(F.col("__n") >= least), named.where(F.col("__n") < least)
    kept = [*rows.columns, *columns]
    first = rows.join(F.broadcast(heavy), same).select(*kept)
    rest = rows.join(F.broadcast(heavy.select(*[f"__key_{k}" for k in keys])), same, "left_anti")
    return first.unionByName(rest.join(light, same).select(*kept))


def word_count(text: Column) -> Column:
    """Number of words, null counted as 0, without building the words."""
    # a word starts at each non-blank that follows a blank or the start of the text
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def with_package(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query or stage (its first argument is the session), with this package on the
    path of local Python workers.

    On a cluster the package is installed or sent with ``--py-files``; a local session
    started from another folder would not find it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        sc = spark.sparkContext
        if sc.master.startswith("local"):
            paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
            if root not in paths:
                sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)
        return query(spark, *args)

    return run
