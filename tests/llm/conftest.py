import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row long, fp string, word string, digest string, n long, row_ string, gone_ string, gone string, of string, text_ string, found_ string, found string, stay_key string, stay_key_ string, stay_id string, stay_digest string, n_lines string, n_gone string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and further columns with names the operators use."""
    long_text = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog today\nand a second line of words here", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog today\nand a second line of words here", "en", None),
        (2, "the quick brown fox jumps over the lazy dog today\nand a second line of words here", "en", None),
        (3, None, None, "b"),
        (4, "", "en", "b"),
        (5, "   \n\t ", "fr", "b"),
        (6, long_text, "en", "a"),
        (7, "x" * 200_000, "en", "a"),
        (None, "a text without an id but with several words in it", "en", None),
        (None, None, None, None),
        (8, "éàü ß Ünï 中文字 😀   nbsp em", "de", "c"),
        (9, "short", "es", "c"),
    ]
    return spark.createDataFrame([(*r, len(r[1]) if r[1] else None, "k", 1, "f", "w", "d", 2, *[f"own {k}" for k in range(13)]) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
