from __future__ import annotations

import pytest
from frames import sample_frame, segmented_frame
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[8]").appName("tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.showConsoleProgress", "false")
         # tiny tables: interpreting beats compiling a class per stage
         .config("spark.sql.codegen.wholeStage", "false").config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample(spark):
    return spark.createDataFrame(sample_frame()).cache()


@pytest.fixture(scope="session")
def segmented(spark):
    return spark.createDataFrame(segmented_frame()).cache()
