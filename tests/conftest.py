import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from releasecat.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        os.environ.get("TEST_MASTER", "local[8]"),
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        # Compiling a plan takes longer than running it on tables this small.
        spark__sql__codegen__wholeStage="false",
        spark__sql__codegen__factoryMode="NO_CODEGEN",
        spark__driver__memory="8g",
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1 -XX:+UseSerialGC",
        spark__sql__execution__arrow__pyspark__enabled="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
