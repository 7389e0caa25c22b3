import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_data import CLASHING, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def frame(spark):
    """Rows to a documents DataFrame; ``extra`` adds columns with clashing names."""
    def build(rows, extra=False):
        df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA)
        if extra:
            df = df.select("*", *(F.lit("own").alias(c) for c in CLASHING))
        return df
    return build
