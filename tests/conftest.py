import pytest

from tablework.session import fresh_database, local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests", 4)


@pytest.fixture
def db(spark):
    return fresh_database(spark, "test")


def rows(df, *cols):
    """Rows as a sorted list of tuples, nulls first."""
    data = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(data, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
