"""Fingerprints where copies or near copies of a text hold a third of the rows."""

import random

import pytest

from cartwheel.llm import imatch


def corpus(kind, docs=300, hot=150):
    """Texts over a vocabulary of 3,000 words, then a third of copies of another text."""
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(draw.choices(letters, k=7)) for _ in range(3000)]
    texts = [" ".join(draw.choices(words, k=120)) for _ in range(docs)]
    base = draw.sample(words, 120)
    for i in range(hot):
        copy = list(base)
        if kind == "near":
            for k in draw.sample(range(120), 4):
                copy[k] = "".join(draw.choices(letters, k=9))
        texts.append(" ".join(copy))
    draw.shuffle(texts)
    return texts, " ".join(base)


@pytest.mark.parametrize("kind", ["exact", "near"])
def test_a_third_of_copies_keeps_the_method(spark, tmp_path, kind):
    texts, base = corpus(kind)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = imatch.op7_fingerprints(spark, str(tmp_path)).orderBy("doc_id").collect()
    hot = [i for i, t in enumerate(texts) if len(set(t.split()) & set(base.split())) > 100]
    assert len(hot) == 150
    follows = [i for i in hot if (i + 1) % len(texts) not in hot]
    assert sum(got[i].near_edited > 0 for i in follows) >= 0.95 * len(follows)  # a third of the terms is left
    assert sum(got[i].near_edited for i in follows) >= 0.15 * len(follows)
    assert sum(got[i].near_edited > got[i].near_next for i in follows) >= 0.95 * len(follows)
    pairs = [(got[i].fingerprint, got[j].fingerprint) for i, j in zip(hot, hot[1:])]
    assert sum(imatch.likeness(a, b) > 0.6 for a, b in pairs) >= 0.95 * len(pairs)


def test_copies_count_once(spark):
    texts, base = corpus("exact")
    once = spark.createDataFrame([(t,) for t in set(texts)], "text string")
    many = spark.createDataFrame([(t,) for t in texts], "text string")
    found = imatch.lexicon(many)
    assert found == imatch.lexicon(once)
    assert set(base.split()) <= set(found)


def test_texts_without_lexicon_terms_are_compared_by_all_their_terms():
    maker = imatch.Fingerprinter(("other",))
    a, b, c = (maker.fingerprint(t) for t in ("one two three four five six", "one two three four five seven", "eight nine ten"))
    assert imatch.likeness(a, b) > 0.4 > imatch.likeness(a, c)
    assert imatch.likeness(maker.fingerprint("1 2"), maker.fingerprint("1 3")) == 0
