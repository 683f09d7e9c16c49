"""Texts longer than any usual limit of tokens."""

from types import SimpleNamespace

from chatloom.catalog import tokens


def test_preferences_count_all_tokens(spark):
    text = " ".join(["word"] * 6000)
    docs = spark.createDataFrame([(1, text, "en", "a"), (2, "one two", "en", "a")], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in tokens.preferences(SimpleNamespace(documents=docs)).collect()}
    short, long = got[2], got[1]
    assert long.n_chosen - short.n_chosen == 5998 and long.chosen_trainable - short.chosen_trainable == 5998
    assert long.rejected_trainable == short.rejected_trainable
