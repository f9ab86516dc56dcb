import pytest

from tests.llm.texts import BASE, NEAR, prose


@pytest.fixture(scope="session")
def messy(spark):
    """NULLs in every column, empty, blank, short, very long and odd texts,
    copies, a near copy, a repeated row, and columns with clashing names."""
    rows = [
        (1, None, "en", None), (2, "", None, 1), (3, " \n\t ", "en", 2), (4, "short", "en", 3),
        (5, "\n".join(prose(100 + k, 50) for k in range(600)), "en", 4),
        (6, BASE, "en", 5), (7, BASE, "de", 6), (8, NEAR, "en", 7), (None, BASE, "en", 8),
        (6, BASE, "en", 5), (9, "日本語 テキスト İ ΑΣ ½ <|endoftext|> a\x00b \x85 ▁x  y", None, None),
        (10, "MIT License\n" * 3, "en", 1), (11, "x " * 400, "en", 1),
    ]
    return spark.createDataFrame(
        [(i, t, lang, n, f"k{n}", n, "z", n, "q", n) for i, t, lang, n in rows],
        "doc_id long, text string, lang string, n_chars long, key string, node long, "
        "ids string, n_removed long, __text string, __gone long")


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
