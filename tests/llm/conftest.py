import random

import pytest

CLASHING = "size copies kept score lang_pred n_words component fp key part ids start target text_ _key".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def prose(seed: int, words: int) -> str:
    made = random.Random(seed)
    return " ".join("".join(made.choice("aeiou") + made.choice("bdgklmnrst") for _ in range(made.randint(1, 4)))
                    for _ in range(words))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, other columns."""
    long = prose(1, 40_000)
    near = prose(2, 200)
    texts = [
        (1, prose(3, 120), "en", "a"), (2, prose(3, 120), "en", "a"), (2, prose(3, 120), "en", "a"),
        (3, None, "en", "a"), (4, "", None, "a"), (5, " \n\t ", "fr", None), (6, long, "en", "b"),
        (None, prose(4, 80), "en", "b"), (None, None, None, None), (7, near, "fr", "b"),
        (8, near.replace(near.split()[100], "changed", 1), None, None), (9, "one two", "fr", "b"),
        (10, "### $$ %% 12 34", "en", "c"), (11, prose(5, 60) + "\n" + prose(5, 60), "en", "c"),
        (12, "ÀÉ ﬁ \x00 日本 \U0001F600 <|endoftext|>  x", "fr", "c")]
    return spark.createDataFrame(
        [(i, t, la, s, None, *("x" for _ in CLASHING)) for i, t, la, s in texts], SCHEMA).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
