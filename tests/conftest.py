import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session, work_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=4,
        **{
            "spark.driver.memory": "8g",
            "spark.default.parallelism": "2",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def folder(spark):
    return work_folder(spark, "test")


@pytest.fixture
def conf(spark):
    """Session settings for one test."""
    before = {}

    def set_conf(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_conf
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows_of(df):
    """Rows as sorted tuples, so that frames compare as bags."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
