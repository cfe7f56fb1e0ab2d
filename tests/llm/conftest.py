import pytest

from .brute import AWKWARD


@pytest.fixture(scope="session")
def shipped(spark):
    from tierforge.llm.queries import ship

    return ship(spark)


@pytest.fixture(scope="session")
def awkward(shipped):
    """Nulls, empty and long texts, repeated rows, and extra columns named like the operators' own."""
    rows = [(i, t, "en" if k % 3 else None, None if k % 4 == 0 else f"s{k % 3}", 7, "x", 1.0, "clash") for k, (i, t) in enumerate(AWKWARD)]
    schema = "doc_id long, text string, lang string, source string, size long, kept string, score double, fp string"
    return shipped.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def docs(shipped):
    return shipped.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
