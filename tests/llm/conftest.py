import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, alphabet: str = "abcdefgh") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, extra=False, langs=None):
        rows = [(i, t, (langs[i] if langs else "en"), "s", len(t) if t else 0) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOC)
        return df.selectExpr("*", "'x' AS extra", "1 AS n") if extra else df

    return make


@pytest.fixture(scope="session")
def awkward():
    """Texts that every operator on documents has to bear: null, empty, blank, one word, repeats, very long, odd characters."""
    base = words(1, 120)
    long = words(2, 30_000)
    return [None, "", "   \n\t", "word", base, base, base + " end", long, long, "é ß😀 \x00\x01", "a" * 5000, "▁ ▁▁x  y", None, "word"]
