import pathlib
import sys
from contextlib import contextmanager

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from claimstrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set SQL settings for one test and put the old ones back."""

    @contextmanager
    def change(values):
        before = {key: spark.conf.get(key, None) for key in values}
        for key, value in values.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)

    return change


@pytest.fixture
def wire_lines(spark, tmp_path):
    """Write text lines to a file and read them as documents."""
    from claimstrata.sources import read_documents

    def read(*lines):
        path = tmp_path / "documents.json"
        path.write_text("\n".join(lines) + "\n")
        return read_documents(spark, str(path))

    return read
