import pytest

SF = "/root/testdata/sf0.001"

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sig tau ups".split()


def prose(start: int, n: int) -> str:
    return " ".join(f"{WORDS[(start * 7 + i * i) % 20]}{(start * 31 + i) % 97}" for i in range(n))


MESSY = [
    (1, prose(1, 60), "x", 7), (2, prose(1, 60), "x", 7), (2, prose(1, 60), "x", 7),  # equal texts, a repeated row
    (3, prose(1, 60).replace("alpha", "alphq", 1), None, None),  # near copy
    (4, None, "x", 1), (5, "", "x", 1), (6, "   \n\t ", "x", 1),  # no words
    (7, "one two", None, 2), (8, "ONE  two", None, 2),  # fewer words than a shingle
    (None, prose(9, 40), "y", 3), (None, None, None, None),
    (10, prose(10, 4000), "y", 4),  # long
    (11, "é漢字 " * 30 + "\U0001f600", "z", 5),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns
    that clash with names the operators use."""
    return spark.createDataFrame(
        [(*r, 1, 2, "k", 3) for r in MESSY],
        "doc_id long, text string, source string, n_chars long, node long, score int, key string, word int")


@pytest.fixture(scope="session")
def empty_docs(messy):
    return messy.where("false")
