import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(texts, start=0):
    return [(start + i, t, ("en", "de", None)[i % 3], ("src0", "src1", "src2", None)[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    return lambda rows: spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, a column whose name clashes."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [*rows_of([None, "", " \n\t", "a", "same words here and there again", "same words here and there again", long, "x" * 50_000, "línea ßß\nlínea ßß\n\n"]), (None, "null id", None, None, None), (4, "same words here and there again", "de", "src0", 31), (4, "same words here and there again", "de", "src0", 31)]
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(7) for c in ("n_lines", "rank", "_epoch2", "host2", "cls", "length")})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
