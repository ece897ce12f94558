from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

FIXTURES = ROOT / "tests" / "fixtures"


@pytest.fixture(scope="session")
def spark():
    from storefront_etl.session import local_session
    from storefront_etl.sources.parquet import drop_scratch

    session = local_session(cores=4, shuffle_partitions=8)
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def fixtures() -> Path:
    return FIXTURES
