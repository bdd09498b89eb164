import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shopgrain.session import local_session

    scratch = str(tmp_path_factory.mktemp("scratch"))
    return local_session(8, "tests", **{"spark.checkpoint.dir": scratch})


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def shop(spark, folder):
    from shopgrain.sources.roles import role_shop

    return role_shop(spark, folder)


@pytest.fixture(scope="session")
def star(spark, folder):
    from __spark_entry__ import STAR_TABLES, star_tables

    stored = star_tables(spark, folder)
    return {name: stored.read(name) for name in STAR_TABLES}


def rows(df):
    """All rows as tuples, in a fixed order that tolerates NULL."""
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
