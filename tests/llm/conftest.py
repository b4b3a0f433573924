import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the columns of the table and one whose name clashes with what operators add."""

    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score int")

    return make


#: Null, empty, blank, short and long texts, and repeated rows.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (6, "One two three"), (7, "a " * 60_000), (8, "é" * 70_000),
    (9, "same text in two rows of the table"), (9, "same text in two rows of the table"), (None, "no id but a text of eight words"),
]
