"""Entropy candidates start at one window, and only word-like shapes without digits are let off."""

from folioflow.llm import op6_secrets


def test_short_and_letters_only_keys(spark):
    short, letters = "q7Zp2LxV9bTn4KcR8mWy", "qwZpXLxVjbTnHKcRvmWydHSg"
    words = ["internationalisierungsmassnahmen", "THEQUICKBROWNFOXJUMPSOVER", "TheQuickBrownFoxJumpsOver", "the-quick-Brown-fox-jumps", "q7Zp2LxV9bTn4KcR8mW"]
    texts = [f"see {short} here", f"see {letters} here", *[f"see {w} here" for w in words]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(x.start, x.end) for x in r.entropy] for r in op6_secrets.secrets(df).collect()}
    assert got == {0: [(4, 24)], 1: [(4, 28)]} | {i: [] for i in range(2, len(texts))}
