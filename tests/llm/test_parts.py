"""Parts of the operators that the queries do not show."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from cartwheel.llm import encoding, language, mixing, quality, toxicity
from cartwheel.llm.pieces import piece_model
from cartwheel.llm.token_counts import PrefixCounter

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BITS = [" ", "  ", "▁", "\n", "a", "the", "ing", "é", "日", "\U0001f600", "\t", "<s>", "<0x0A>", "1", "23", "....",
        "     ", "aaaa", "A", "th", "er", "un", "tion", "\x00"]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_prefix_counts_are_those_of_every_prefix(pieces):
    counter = PrefixCounter(piece_model(PIECES))
    draw = random.Random(7)
    texts = ["".join(draw.choices(BITS, k=draw.randint(0, 25))) for _ in range(150)]
    for text, counts in zip(texts, counter.many(texts)):
        assert counts.tolist() == [len(pieces.encode(text[:k])) for k in range(len(text) + 1)]


@pytest.mark.parametrize("size", [32, 48])
def test_chunked_encoding_equals_the_library(pieces, size):
    encoder = encoding.Encoder(piece_model(PIECES))
    decoder = encoding.Decoder(piece_model(PIECES))
    draw = random.Random(size)
    for i in range(60):
        text = "".join(draw.choices(BITS if i % 2 else ["a", "t", "h", "e", "tion", "in"], k=60))
        whole = encoding.normal(text)
        chunks = [encoder.chunk(whole, k, size) for k in range(-(-len(whole) // size))]
        matrices = [c.matrix() for c in chunks]
        states = encoding.states_of_best_path(matrices)
        ids = [x for c, i, j in zip(chunks, states, states[1:]) for x in c.trace(i, j).tolist()]
        assert ids == pieces.encode(text)
        assert decoder.decode(np.array(ids)).decode() == text.replace("▁", " ")
        # blocks of three: combined, scanned, handed down
        cut = [matrices[k:k + 3] for k in range(0, len(matrices), 3)]
        borders = encoding.states_of_best_path([encoding.combined(m) for m in cut])
        inside = [encoding.states_inside(m, i, j)[:-1] for m, i, j in zip(cut, borders, borders[1:])]
        assert [x for part in inside for x in part] + borders[-1:] == states
        # products combine in any order
        if len(matrices) > 2:
            left = encoding.product(encoding.combined(matrices[:2]), encoding.combined(matrices[2:]))
            assert (left == encoding.combined(matrices)).all()


def test_permutation_and_exact_targets():
    for n in (1, 2, 5, 16, 17, 1000):
        p = mixing.permute(np.arange(n), n, 5)
        assert sorted(p) == list(range(n))
        assert (mixing.permute(p, n, 5, back=True) == np.arange(n)).all()
    for words in (1, 511, 512, 513, 5000):
        for part in (0, 0.1, 0.99, 1, 2.5, 3):
            plan = mixing.SourcePlan("s", words, part * words, 3)
            draws = np.arange(plan.draws())
            assert (plan.slots(draws)[2].sum() if len(draws) else 0) == round(part * words)


def test_targets_stop_at_three_times_a_size():
    assert mixing.water_fill([10, 100, 1000], [1, 2, 3]) == [30.0, 300.0, 780.0]
    assert mixing.water_fill([0, 5], [1, 2]) == [0.0, 5.0]
    assert mixing.water_fill([], []) == []


def test_shards_draw_all_slots():
    plans = [mixing.SourcePlan(s, w, t, 16 * i) for i, (s, w, t) in enumerate([("a", 90_000, 30_000), ("b", 9000, 27_000), ("c", 3, 9)])]
    dealt = mixing.deal(plans, 1, slots_per_shard=16)
    for k, p in enumerate(plans):
        draws = sorted(d for _, s, first, n in dealt if s == k for d in range(first, first + n))
        assert draws == list(range(p.draws()))


def test_mixed_texts_hold_the_taken_words(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{i}_{k}" for k in range(40 + i)), "en", f"s{i % 4}", 0) for i in range(30)]
        + [(30, "a b c", "en", "s0", 0)] * 3, "doc_id long, text string, lang string, source string, n_chars long")
    plans = mixing.source_plans(mixing.sized(docs, mixing.F.lit(0)), 20_240_601)
    got = mixing.mixed_documents(docs).collect()
    for p in plans:
        words = [w for r in got if r.source == p.name for w in r.text.split()]
        assert len(words) == round(p.target)
    own = {r.doc_id: set(r.text.split()) for r in docs.collect()}
    assert all(set(r.text.split()) <= own[r.doc_id] and r.n_chars == len(r.text) for r in got)


def test_folding():
    assert toxicity.fold("1D10T $tupid m0r0n the$$$ 3 a!") == "idiot stupid moron the$$$ 3 a!"
    assert toxicity.fold("id1ot") == "idiot"
    assert toxicity.fold("іdіоt") == "idiot"
    assert toxicity.fold("2024 100") == "2024 100"


def test_exceptions_and_whole_words():
    lex = toxicity.Lexicon({"scun": 2.0, "lose": 1.0, "loser ": 3.0}, ["scunthorpe"])
    a = lex.automaton()
    assert toxicity.matched("scunthorpe is fine", a) == 0
    assert toxicity.matched("scunner", a) == 2
    assert toxicity.matched("a loser, losers; closer", a) == 4
    assert toxicity.density("", a) == toxicity.density(None, a) == 0


def test_language_spans(spark):
    rows = [("the house and the garden of the old man were quiet that evening", "en"),
            ("la maison et le jardin du vieil homme étaient calmes ce soir là", "fr"),
            ("дом и сад старого человека были тихими в тот вечер", "ru")] * 5
    model = language.train(spark.createDataFrame(rows, "text string, lang string"))
    labeller = language.Labeller(model, switch=4.0)
    text = "the old man and the garden, le vieil homme et la maison, дом и сад"
    spans = labeller.spans(text)
    assert [s[2] for s in spans] == ["en", "fr", "ru"]
    assert text[spans[2][0]:spans[2][1]] == "дом и сад"
    assert labeller.summary(["中文", "дом", None]) == [("en", 0.0, 1), ("ru", 1.0, 1), ("und", 0.0, 0)]


def test_a_bad_host_loses_its_documents(spark):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(i, f"{good} {i}", "fine") for i in range(200)]
    rows += [(1000 + i, f"{good} {i}" if i % 5 == 0 else "too short", "bad") for i in range(100)]
    rows += [(2000, "too short", "rare"), (2001, f"{good} x", "rare")]
    got = {r.doc_id: r for r in quality.judge(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i]["__kept"] for i in range(200))
    assert not any(got[1000 + i]["__kept"] for i in range(100))
    assert got[2001]["__kept"] and not got[2000]["__kept"]  # one failure of two says little of a host
