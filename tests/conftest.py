import pytest

from stratiform.session import local_session


@pytest.fixture(scope="session")
def spark():
    # Few partitions: the frames are tiny, and every partition would become a file.
    session = local_session(4, "stratiform-tests", **{"spark.default.parallelism": "2"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def rows():
    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture
def new_name():
    import uuid

    return lambda label: f"spark_catalog.default.{label}_{uuid.uuid4().hex}"
