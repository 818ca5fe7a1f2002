import uuid

import pytest

from strata.session import build_session, streaming_session


@pytest.fixture(scope="session")
def base_spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    spark = build_session("strata-tests", "local[4]", {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(root / "warehouse"),
        "spark.checkpoint.dir": str(root / "shared"),
        "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "5000",
        "spark.sql.streaming.noDataMicroBatches.enabled": "true",
    })
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def spark(base_spark):
    return streaming_session(base_spark, state_partitions=2)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
