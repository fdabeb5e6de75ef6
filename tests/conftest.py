import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def make_session(cpus: int = 4) -> SparkSession:
    import tempfile

    from assay.session import tune

    folder = tempfile.mkdtemp(prefix="assay-test-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("assay-tests")
             .config("spark.ui.enabled", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g")
             .config("spark.checkpoint.dir", f"{folder}/checkpoints")
             .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
