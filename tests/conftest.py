import pytest

from freshet.session import local_session, use_folder_if_unset


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, app="freshet-tests")
    use_folder_if_unset(session, str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
