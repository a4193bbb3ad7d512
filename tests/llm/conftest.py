"""Small tables for the operators: the given 200 documents, and a table of edge cases."""

import random

import pytest
from pyspark.sql import types as T

from cartwheel.llm.common import with_package
from tests.conftest import SF_SMALL

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("size", T.StringType()), T.StructField("score", T.StringType()), T.StructField("shard", T.StringType()),
    T.StructField("class", T.StringType()), T.StructField("run", T.StringType()), T.StructField("key", T.StringType())])

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
EDGE_ROWS = [
    (1, "the cat sat on the mat and the dog lay on the rug by the old green door of the house", "en", "a", 85),
    (2, None, "en", "a", None),
    (3, "", "en", None, 0),
    (4, " \t\n\x0b\x0c\r ", None, "b", 7),
    (5, "123 456 !!! ###", "en", "b", 15),
    (6, LONG, "en", "c", len(LONG)),
    (7, LONG + " and a little more", "en", None, len(LONG) + 18),
    (8, "one two three four", "en", "a", 18),
    (9, "one two three four", "fr", "b", 18),
    (9, "one two three four", "fr", "b", 18),
    (None, "one two three four", "fr", "b", 18),
    (None, None, None, None, None),
    (10, "x" * 40_000, "en", "c", 40_000),
    (11, "Grüße aus 東京 \U0001f600 a▁b <s> <|endoftext|> café café", "de", "z", 40),
    (12, "same line here\nsame line here\nsame line here\nother", "en", "a", 50),
    (13, "ONE two\x00three FOUR", "en", "a", 18),
    (-5, "one TWO three four five six seven eight nine ten one two three four five six seven eight nine ten", "en", "a", 99),
]


EMBEDDING_SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, values string, n string"
CONVERSATION_SCHEMA = "conv_id long, turn long, role string, text string, d string, k1 string, seq string, pos string, length string"


def edge_embeddings():
    """Vectors of 32 components: ties, repeated rows, nulls, non-finite, huge and odd ones."""
    rng = random.Random(5)
    rows = [(i, [round(rng.gauss(0, 0.2), 4) for _ in range(32)], i % 5 or None) for i in range(300)]
    rows += [(3, rows[3][1], 3), (3, rows[3][1], 3), (None, rows[9][1], 4), (500, rows[9][1], None), (501, None, 1)]
    rows += [(502, [0.5] * 31 + [None], 1), (503, [0.5] * 31 + [float("nan")], 1), (504, [float("-inf")] + [0.5] * 31, 1)]
    rows += [(505, [], 1), (506, [0.25] * 5, None), (507, [0.0] * 32, 2), (508, [-0.0] * 32, 2)]
    rows += [(509, [1e7, -1e7] + [0.1] * 30, 9), (-9, [0.1] * 5, 9)]
    return rows


def edge_conversations():
    rows = []
    for c in range(60):
        for t in range(c % 9):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t if c % 3 else (t, c % 4)}"))
    rows += [(100, None, "user", "first"), (100, 0, None, None), (100, 0, "user", None), (100, 0, None, "x"), (100, 0, None, "x")]
    rows += [(102, 1, "a", "y" * 50_000), (103, 1, "a", "Grüße \U0001f600"), (None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(204, t, "user", "same") for t in range(300)] + [(205, t, "user", "same") for t in range(300)]
    rows += [(c, 0, "user", "one greeting") for c in range(1000, 1040)]
    return rows


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("edge"))
    rows = [(*r, "s", "s", "s", "s", "s", "s") for r in EDGE_ROWS]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (6, 1, 1), (9, 0, 0), (None, 1, 1), (8, None, None)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(*r, "s", "s", "s", "s") for r in edge_embeddings()], EMBEDDING_SCHEMA).repartition(3).write.parquet(
        f"{folder}/embeddings.parquet")
    spark.createDataFrame([(*r, "s", "s", "s", "s", "s") for r in edge_conversations()], CONVERSATION_SCHEMA).repartition(
        3).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], EMBEDDING_SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], CONVERSATION_SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    with_package(lambda s, d: None)(spark, SF_SMALL)


@pytest.fixture(scope="session")
def small_rows(spark):
    """doc_id, text, lang, source of the given 200 documents, in order."""
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").select("doc_id", "text", "lang", "source").collect()
