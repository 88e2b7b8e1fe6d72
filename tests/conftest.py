from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from costmart import Config, build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("costmart-tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return Config(as_of=date(2024, 1, 31))


@pytest.fixture(scope="session")
def tables(spark, cfg):
    """One full build over the small data set, shared by the tests that only read."""
    from costmart.plans import marts
    from costmart.session import scratch_path
    from costmart.sources.adapter import Inputs

    inputs = Inputs(spark, DATA)
    sources = marts.Sources(
        inputs.metering(), inputs.queries(), inputs.storage(), inputs.department_map(), inputs.budget(),
        inputs.attribution(), inputs.clustering(),
    )
    return marts.build(sources, cfg, marts.store_under(scratch_path(spark, "test-build")))
