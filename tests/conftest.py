import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from tephra.session import local_session

    # on a handful of rows compiling generated code costs more than running it; tools/check_oracle.py runs compiled
    session = local_session("tests", cpus=4, **{"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
                                                "spark.sql.shuffle.partitions": "2"})
    yield session
    session.stop()
