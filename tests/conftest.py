import importlib
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    """The smallest set of driver tables."""
    return str(TESTDATA / "sf0.001")


@pytest.fixture
def table(spark, sf):
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet")


@pytest.fixture
def boats_csv(tmp_path):
    """Three boats, two in one harbour; every column reads as text."""
    path = tmp_path / "boats.csv"
    path.write_text("hull,title,harbour\n17,Petrel,Bergen\n23,Tern,Bergen\n31,Heron,Cork\n")
    return str(path)


@pytest.fixture(autouse=True)
def own_presets(monkeypatch):
    """Presets that a test registers are gone after it."""
    presets = importlib.import_module("sluiceway.sources.presets")
    monkeypatch.setattr(presets, "_registered", dict(presets._registered))
