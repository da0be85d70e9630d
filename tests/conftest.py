import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ripplelog.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A zone with an offset and daylight saving time: no result may depend on it.
    spark = session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__sql__session__timeZone="America/New_York",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()
