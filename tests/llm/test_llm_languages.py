"""Languages beyond the bound are an error, not silently unknown; texts without a letter are unknown."""

import pytest

from newsmart.llm import langid


def test_more_languages_than_the_bound(spark):
    docs = spark.createDataFrame([(i, f"some text {i}", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        langid.learn(docs, langid.Profiles(languages=2))
    assert set(langid.learn(docs, langid.Profiles(languages=3))) == {"l0", "l1", "l2"}


@pytest.mark.parametrize("text", ["½ ² Ⅷ ①", "٣ 12 _", "🙂!", "", "\u0301"])
def test_no_letter_no_language(text):
    distances = langid.Distances({"en": langid.grams("some words")[0].tolist()}, 300)
    assert distances.nearest(text) == ("und", 0.0)
    assert distances.nearest(text + "ª")[0] == "en"
