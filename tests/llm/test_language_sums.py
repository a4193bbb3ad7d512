import numpy as np

from cartwheel.llm import language


def test_what_reaches_the_driver_does_not_grow_with_the_tasks(spark):
    rows = spark.createDataFrame(
        [(f"{stem} und{i} mehr{i % 7} worte", lang) for i in range(60) for stem, lang in (("haus", "de"), ("house", "en"))], "text string, lang string")
    few, many = (language.gram_sums(rows, ["de", "en"], tasks=n).toPandas().sort_values(["lang", "place"]) for n in (2, 60))
    assert not many.duplicated(["lang", "place"]).any()  # one sum of all tasks, not one of each
    assert np.array_equal(few.to_numpy(), many.to_numpy())
    assert np.array_equal(language.train(rows, tasks=2).table, language.train(rows, tasks=60).table)


def test_nothing_countable(spark):
    rows = spark.createDataFrame([("123", "de"), (None, "en"), ("", "de")], "text string, lang string")
    model = language.train(rows)
    assert model.langs == ["de"] and not model.allowed.any()
