"""A toxic vocabulary of more than 200 beginnings of words."""

from cartwheel.llm import toxicity


def test_exceptions_of_every_stem(spark):
    letters = "abcdefghijklmnop"
    stems = [f"{a}{b}zqwxkv" for a in letters for b in letters][:240]
    toxic = [(" ".join(s + ("er" if i % 2 else "ing") for s in stems), 1) for i in range(80)]
    clean = [("a quiet day in the garden" + (f" {stems[-1]}al {stems[0]}al" if i % 10 == 0 else ""), 0) for i in range(80)]
    lexicon = toxicity.learn(spark.createDataFrame(toxic + clean, "text string, toxic int"))
    assert sum(not k.endswith(" ") for k in lexicon.terms) > 200
    assert sorted(lexicon.exceptions) == sorted([f"{stems[0]}al", f"{stems[-1]}al"])
    assert toxicity.matched(f"{stems[-1]}al", lexicon.automaton()) == 0
    assert toxicity.matched(f"{stems[-1]}er", lexicon.automaton()) > 0
