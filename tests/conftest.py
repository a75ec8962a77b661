from dataclasses import replace

import pytest

from fraudspark.config import PipelineConfig
from fraudspark.operators.clean import clean
from fraudspark.operators.cluster import cluster
from fraudspark.operators.features import add_features
from fraudspark.session import build_session, materialize
from fraudspark.sources.transactions import read_transactions

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return PipelineConfig()


@pytest.fixture(scope="session")
def small_cfg(cfg):
    return replace(cfg, tree_counts=(5, 20))


@pytest.fixture(scope="session")
def raw(spark):
    return read_transactions(spark, FOLDER)


@pytest.fixture(scope="session")
def cleaned(raw):
    return materialize(clean(raw), "cleaned")


@pytest.fixture(scope="session")
def featured(cleaned):
    return add_features(cleaned)


@pytest.fixture(scope="session")
def clustering(featured, cfg):
    return cluster(featured, cfg)
