import pytest

#: Rows every operator has to stand: nulls, empty and blank texts, one very long text, repeated rows, a null id.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the old grey house.\nIt was late in the year."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "word " * 60_000 + "end."),
    (6, "Licensed under the Apache License, Version 2.0. GNU General Public License version 3! CC BY cc by MIT License"),
    (6, "Licensed under the Apache License, Version 2.0. GNU General Public License version 3! CC BY cc by MIT License"),
    (None, "A text without an id, ÄÖÜ ß ñ 你好 🙂 <|endoftext|> 12.50"),
    (8, "!!! *** ### $$$ %%% | | |\n!!! *** ### $$$ %%% | | |"),
    (9, "The quick brown fox jumps over the lazy dog and runs away from the old grey house.\nIt was late in the year."),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd rows, with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en" if n % 3 else None, "src0", len(t or ""), n, "x", 1.5, n) for n, (i, t) in enumerate(TEXTS)]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, row long, key string, score double, number int"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)
