import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(rows, schema=SCHEMA):
        return spark.createDataFrame(rows, schema).repartition(3)
    return make


@pytest.fixture
def folder(spark, tmp_path):
    """Write tables as an input folder for the registered queries."""
    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return write
