import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import SMALL, Maker  # noqa: E402
from wardmill.session import local_session  # noqa: E402
from wardmill.sources.starmap import StarClinic  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})


@pytest.fixture(scope="session")
def clinic(spark):
    return StarClinic(spark, SMALL)


@pytest.fixture(scope="session")
def make(spark):
    return Maker(spark)
