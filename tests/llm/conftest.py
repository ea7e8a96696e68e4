import pytest

WORDS = "the of and to in a is that it for on was be with as by this had not are but from or have an they which one you were all her she there would".split()


def words(n, seed=0):
    x = seed * 7919 + 17
    out = []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + (str((x >> 16) % 50) if x % 3 == 0 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, copies, and columns with names that operators use."""
    long = words(30_000, 5)
    rows = [
        (1, words(300, 1)),
        (2, words(300, 1)),
        (3, words(300, 1) + " changed"),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, long),
        (8, "x " + long),
        (9, words(50, 2)),
        (9, words(50, 2)),
        (10, "short"),
        (None, words(120, 3)),
        (None, words(120, 1)),
        (11, "a" * 5000),
        (12, "é▁日本語 🎉 " * 40),
        (2**60 + 1, words(200, 4)),
    ]
    rows = [(i, t, "en", "src0", len(t or ""), 0.5, "s", 3, 7) for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, n_words int, pieces int").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
