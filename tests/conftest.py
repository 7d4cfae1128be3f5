import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores=8, shared=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by all columns unless an order is given."""
    if order:
        return [tuple(r) for r in df.orderBy(*order).collect()]
    return sorted((tuple(r) for r in df.collect()), key=repr)
