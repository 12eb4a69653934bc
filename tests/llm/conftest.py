import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, words string, size int, measures int, copies string, fp int"


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, null ids and groups, ties, repeated rows, a very long text, odd characters."""
    rng = random.Random(5)
    syllables = ["tho", "re", "an", "ti", "sh", "ed", "nd", "ou", "é", "ß", "🙂"]

    def prose(n):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))

    passage, other = prose(60), prose(80)
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "Two WORDS", prose(34), passage, passage, f"{prose(50)} {passage}\n{prose(20)}",
        f"{other}\n{other}\n{other}", "ab " * 300, prose(20_000), prose(40) + " ### $$$ ***", "x\x1cy z 　 q " * 12,
        "Ḫ é <|endoftext|> I'LL don't " * 9, other, other + " end", "same line\n" * 30,
    ]
    rows = [
        (i, t, ["en", "de", None][i % 3], ["a", "b", None, "Z", "ä"][i % 5], None if t is None else len(t), "w", 1, 2, "c", 3)
        for i, t in enumerate(texts)
    ]
    return [*rows, rows[6], rows[6], (None, passage, None, None, None, None, None, None, None, None), (None, None, "en", "a", 0, "", 0, 0, "", 0)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
