import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tools"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from abonara.session import local_session
    session = local_session("4", "tests")
    session.sparkContext.setLogLevel("ERROR")
    # The tables are tiny: compiling each stage would take far longer than running it.
    # tools/compare.py runs the same comparisons with compiled stages.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF


@pytest.fixture(scope="session")
def duck(folder):
    import compare
    return compare.connect(folder)
