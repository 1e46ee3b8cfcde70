import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark():
    from silostar import session

    spark = session.build("local[4]", 4)
    # The tables of the tests are tiny: compiling a plan costs more than running it.
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def frame(spark):
    """A small frame from literal rows."""

    def make(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make
