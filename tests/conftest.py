import pytest

from catalog_star.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=8, memory="6g", app="catalog-star-tests", checkpoint=str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()
