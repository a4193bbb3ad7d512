"""Every letter of the look-alike map folds by itself, and so do accented letters."""

from cartwheel.llm import toxicity


def test_every_lookalike_folds_alone():
    assert all(toxicity.fold(k) == v for k, v in toxicity.HOMOGLYPHS.items())
    assert toxicity.fold("mørøn") == toxicity.fold("moron") == "moron"


def test_accented_letters_fold_to_their_letter():
    assert toxicity.fold("ídíót") == toxicity.fold("ídiot") == "idiot"
    assert toxicity.fold("한국어") == "한국어"
