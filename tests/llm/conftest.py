import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing extra columns."""
    words = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, words, "en", "a", 1), (2, words, "en", "a", 1), (2, words, "en", "a", 1), (3, None, None, None, None),
        (4, "", "en", "a", 0), (None, words + " tail", "en", None, 3), (None, None, None, None, None),
        (5, "short", "en", "a", 5), (6, "  \n\t ", "en", "a", 5), (7, " ".join(["long"] * 30000), "en", "a", 9),
        (8, "ünïcode ß 漢字 " * 30, "de", "b", 9), (9, "you idiot , you clown.\nHe said: idiot", "en", "b", 9),
    ]
    extra = "row string, codes string, spans string, low int, w string, score string, held_out string, cid string, copy_id int, leak_id int"
    n = len(extra.split(","))
    data = [r + ("x",) * 3 + (1,) + ("x",) * (n - 6) + (1, 2) for r in rows]
    return spark.createDataFrame(data, f"{DOCS}, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
