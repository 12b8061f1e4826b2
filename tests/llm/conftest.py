import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls in every column, empty, blank and long texts, ties and repeats, and columns named like inner ones."""
    long_text = " ".join(f"word{k % 977} of the long text number {k}." for k in range(12_000))
    rows = [
        (1, "The cat sat on the mat and it was a good day for all of the cats in the house, as it is.", "en", "a", 90), (2, "", "en", "a", 0), (3, None, None, None, None), (None, "Nobody knows the number of this text.", "en", "b", 37), (None, None, None, None, None),
        (4, " \t\n ", "en", "b", 4), (5, long_text, "en", "a", len(long_text)), (6, long_text, "en", None, len(long_text)), (7, "Der Hund und die Katze sind in dem Haus.\nDer Hund und die Katze sind in dem Haus.", "de", "a", 80), (7, "Der Hund und die Katze sind in dem Haus.\nDer Hund und die Katze sind in dem Haus.", "de", "a", 80),
        (8, "12345 !!! ???", "en", "c", 13), (9, "ÉTÉ À LA PLAGE avec les enfants \x00   😀 dans la maison", "fr", "c", 40), (-5, "x", "es", "c", 1),
    ]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    names = "key fp h size rank digest repeated base edge mix_copy mix_source _key _m_times _n_key _q_words _q_m_n_words _d_key _s_rank dedup_removed item_id words _hw _i unit kept Order count".split()
    return odd.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
