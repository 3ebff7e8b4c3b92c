import pytest

#: Names that the operators use inside; a table may have them too.
CLASHING = "words h rid key t label row item_id base found p rate whole __row __text stamp n_lines".split()


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows with further columns of awkward names, some null."""

    def make(rows, parts=3):
        extra = ", ".join(f"`{c}` string" for c in CLASHING)
        full = [(i, t, None if n % 2 else "x", "s", None, *[None] * len(CLASHING)) for n, (i, t) in enumerate(rows)]
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


LONG = " ".join(f"word{i % 977} the {i}" for i in range(9000))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, blanks, a very long text, repeated rows and equal ids."""
    return [
        (None, "The text of no one, by the way, in ten words or more."),
        (1, None),
        (2, ""),
        (3, " \n\t\r "),
        (4, LONG),
        (5, "Twice the same row, it is said, by the people of the town."),
        (5, "Twice the same row, it is said, by the people of the town."),
        (6, "É ñ 漢字 😀 the end of the tale, as it was told to us in the hall."),
    ]
