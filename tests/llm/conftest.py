import pathlib

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not pathlib.Path(DATA).exists():
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
