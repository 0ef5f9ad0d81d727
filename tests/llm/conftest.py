import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text = row[:2]
            source = row[2] if len(row) > 2 else "a"
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Texts that every operator has to take: nothing, blanks, marks, repeats, one very long.
ODD = [
    None, "", " ", "\n\n", "word", "a b c d", "été ÅÅ 日本語 🙂", "x" * 5000, "the cat sat " * 3000,
    "same text of some words here", "same text of some words here", "    \x1c",
]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of([*ODD, (None, "a row without an id"), (3, "an id that is there twice")])


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with columns that operators might use themselves."""
    from pyspark.sql import functions as F

    names = "row size hash kept spans score text_2 bucket rank judged component_id copies start".split()
    return odd.withColumns({n: F.lit(n) for n in names})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
