from __future__ import annotations

import tempfile

import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, memory="6g")


@pytest.fixture
def folder():
    """A new folder for the test's files; left behind for inspection."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    def collected(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return collected
