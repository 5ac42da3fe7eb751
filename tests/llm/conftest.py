import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Nulls, empty and long texts, copies, near copies, repeated rows and clashing extra columns."""
    base = " ".join(f"word{k}" for k in range(60))
    near = base.replace("word59", "other")
    shared = "This very line stands in many documents."
    rows = [
        (0, None, "a"), (1, "", "a"), (2, base, "a"), (3, base.upper(), None), (4, near, "b"),
        (5, f"one\n{shared}\nalpha", "b"), (6, f"two\n  {shared}\t\nbeta", "b"), (7, f"{shared.lower()}\ngamma", "c"),
        (8, "x " * 40_000, "c"), (9, "Mail bob.b@mail.example.org or 10.1.2.3 now", "a"), (9, "Mail bob.b@mail.example.org or 10.1.2.3 now", "a"),
        (11, "four words only here", "a"), (12, "four words only here", "a"), (13, "one two three four five", "c"),
        (14, " ".join(f"lone{k}" for k in range(30)), None),
    ]
    rows = [(i, t, s, None if i == 2 else i, "extra") for i, t, s in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines long, row string")


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("doc_id < -1")
