import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sluice.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session("local[4]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_checkpoint_dir=f"file://{shared}", spark_driver_memory="3g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
