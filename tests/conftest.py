import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def normal(rows):
    """Rows of either engine as sorted tuples of text, numbers rounded."""
    def cell(x):
        if x is None or str(x) in ("<NA>", "nan", "NaT"):
            return "NULL"
        if isinstance(x, float):
            return str(round(x, 6)) if x != int(x) else str(int(x))
        return str(x)

    return sorted(tuple(cell(x) for x in r) for r in rows)
