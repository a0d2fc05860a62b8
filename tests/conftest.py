from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from textgraph.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    # Tables of a few rows run faster than their code compiles.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """``<docid, line>`` of a list of lines."""

    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "docid bigint, line string")

    return make
