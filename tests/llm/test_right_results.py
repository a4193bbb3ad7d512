"""Equal rows in the mix, letters that are none, copies in the language sample, memories."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cartwheel.llm import binary, encoding, language, mixing, ragged, token_counts
from cartwheel.llm.common import NUMERALS, letter_words
from cartwheel.llm.pieces import piece_model


@pytest.mark.parametrize("seed", range(4))
def test_equal_rows_across_a_partial_pass(spark, seed):
    """Three equal rows, of which the partial pass takes some: the mix gives what it takes."""
    long = " ".join(f"w{i}" for i in range(600))
    rows = [(1, long, "a")] * 3 + [(10 + i, " ".join(f"x{i}_{k}" for k in range(600)), "a") for i in range(6)]
    rows += [(100 + i, " ".join(f"y{i}_{k}" for k in range(450)), "b") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = mixing.written(mixing.sized(docs, mixing.F.lit(0).cast("long")), "sizes")
    plans = mixing.source_plans(sizes, seed)
    given = {"a": 0, "b": 0}
    for r in mixing.mixed_documents(docs, seed).collect():
        given[r.source] += len(r.text.split())
    for p in plans:
        assert abs(given[p.name] - p.target) <= 1, (given, plans)


def test_numerals_are_no_letters(spark):
    assert letter_words("½ ² ① Ⅷ x²y A½ 三一") == ["x", "y", "a", "三一"]
    assert letter_words(None) == [] and not NUMERALS.search("abc 123 éß東一")
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("le chat est la", "fr"), ("the cat is here", "en")] * 20)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = language.Labeller(model).summary(["½ ² ①", "the ² cat", "Ⅷ", "²le chat½"])
    assert [f[0] for f in found] == ["und", "en", "und", "fr"]
    assert language.Labeller(model).spans("½ the cat")[0][:2] == (2, 9)


def test_copies_do_not_fill_the_sample(spark):
    rows = [("the same text", "en")] * 3000 + [(f"text number {i}", "en") for i in range(500)] + [("un texte", "fr")] * 100
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    sample = language.training_sample(df, 100).collect()
    assert len({r.text for r in sample if r.lang == "en"}) == sum(r.lang == "en" for r in sample)
    assert 60 <= sum(r.lang == "en" for r in sample) <= 150
    assert [r.text for r in sample if r.lang == "fr"] == ["un texte"]


def test_memory_forgets_what_is_not_used():
    memory, asked = ragged.Memory(10, 5), []

    def learn(parts):
        asked.extend(parts)
        return {p: p.encode() for p in parts}

    rng = random.Random(2)
    for n in range(200):
        parts = sorted({"hot", "a", *(f"p{rng.randrange(10**6)}" for _ in range(3)), "long part"})
        assert memory.values(parts, learn) == [p.encode() for p in parts]
    assert asked.count("hot") == asked.count("a") == 1 and asked.count("long part") == 200
    assert len(memory) <= 20 and "hot" in memory


def random_texts(seed, n):
    rng = random.Random(seed)
    alphabet = "abé Zß×÷ɏɐ\n\t東,.1 ▁ﬀ😀   Ǿ's<|endoftext|>"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 50))) for _ in range(n)]


@pytest.mark.parametrize("size", [50, 1 << 21])
def test_word_ids_are_the_libraries(monkeypatch, size):
    """Groups and long texts cut at blanks, with a memory that overflows."""
    monkeypatch.setattr(binary, "GROUP_BYTES", size)
    monkeypatch.setattr(binary.WordEncoder, "REMEMBER", 100)
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = binary.WordEncoder(path), Tokenizer.from_file(path)
    texts = [*random_texts(1, 400), None, "", "word " * 60, "x" * 200]
    for text, ids in zip(texts, encoder.encode(pa.array(texts), 1), strict=True):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids + [1]


def test_segments_and_pieces_are_the_libraries(monkeypatch):
    monkeypatch.setattr(encoding.Encoder, "REMEMBER", 100)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = piece_model(path)
    encoder, decoder = encoding.Encoder(model), encoding.Decoder(model)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [*random_texts(2, 600), "", None, "\n", "   "]
    for column in (pa.array(texts), pa.array(["zz", *texts]).slice(1)):
        ids, ends = encoder.encode(encoding.plain(column))
        for text, start, end in zip(texts, [0, *ends], ends, strict=False):
            assert ids[start:end].tolist() == library.encode(text or "")
            assert decoder.decode(ids[start:end]).decode() == (text or "").replace("▁", " ")
    for text in texts:
        text = (text or "").replace("▁", " ")
        if text:
            data = np.frombuffer(text.encode(), np.uint8)
            assert encoding.cut_at(data, np.flatnonzero(encoding.segment_starts(data))).to_pylist() == model.segments.findall(text)
    odd = [model.byte_id[0xE6], model.byte_id[0x41], model.byte_id[0xFF]]
    assert decoder.decode(np.array([model.id_of["▁a"], *odd])).decode() == "a\ufffdA\ufffd"


def test_stored_counts_answer_budgets_and_cuts(spark, monkeypatch):
    """Any budget and any cut, from the stored counts alone, as the library counts prefixes."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, t, "s") for i, t in enumerate([*random_texts(5, 40), None, "", "the end of the words " * 30])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, budget string")
    store = token_counts.written(token_counts.store_counts(docs, path), "store")
    assert store.columns == ["doc_id", "budget", "n_chars", "n_tokens", "prefix_counts"]
    texts = {i: t or "" for i, t, _ in rows}
    counts = {i: [len(library.encode(t[:k])) for k in range(len(t) + 1)] for i, t in texts.items()}
    ask = [(i, q) for i in texts for q in (-1, 0, 1, 7, 10_000, None)]
    budgets = spark.createDataFrame(ask, "doc_id long, budget long")
    got = {(r.doc_id, r.budget): r.fitting_chars for r in token_counts.answer_budgets(store, budgets).collect()}
    assert got == {(i, q): None if q is None or q < 0 else max(k for k, n in enumerate(counts[i]) if n <= q) for i, q in ask}
    cuts = budgets.withColumnRenamed("budget", "cut")
    got = {(r.doc_id, r.cut): r.cut_tokens for r in token_counts.answer_cuts(store, cuts).collect()}
    assert got == {(i, q): None if q is None or q < 0 else counts[i][min(q, len(texts[i]))] for i, q in ask}


def test_packed_counts_of_any_step():
    for steps in ([], [1, 0, -30], [4] * 5, [1000, -1000], [2**40]):
        counts = np.concatenate([[0], np.cumsum(np.array(steps, dtype=np.int64))])
        assert (token_counts.unpack(token_counts.pack(counts)) == counts).all()


def test_rendezvous_with_unequal_weights(spark):
    """Every key's shard by brute force; shares follow the weights; a heavier or new shard only takes."""
    import hashlib
    import math
    from collections import Counter

    from cartwheel.llm import sharding

    keys = [f"={i}" for i in range(4000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")

    def chosen(weights):
        return {r.k: r.s for r in df.select("k", sharding.choose_shard(sharding.F.col("k"), weights).alias("s")).collect()}

    def brute(key, weights):
        def bid(i):
            u = (int(hashlib.md5(f"{key}@{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16.0**13
            return weights[i] / -math.log(u)

        return max(range(len(weights)), key=lambda i: (bid(i), -i))

    weights = [1.0, 2.0, 5.0]
    base = chosen(weights)
    assert base == {k: brute(k, weights) for k in keys}
    shares = Counter(base.values())
    assert all(abs(shares[i] / 4000 - w / 8) < 0.03 for i, w in enumerate(weights))
    for more, into in (([1.0, 2.0, 5.0, 2.0], 3), ([1.0, 4.0, 5.0], 1)):
        moved = {k: s for k, s in chosen(more).items() if s != base[k]}
        assert moved and set(moved.values()) == {into}
    with pytest.raises(ValueError, match="positive"):
        sharding.choose_shard(sharding.F.col("k"), [1.0, 0.0])
