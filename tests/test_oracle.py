"""Every query beside its SQL twin on the smallest tables."""

import pytest

import check
from tradepulse import catalog


@pytest.fixture(scope="module")
def duck(sf):
    return check.connect(sf)


BATCH = sorted(n for n in catalog.QUERIES if not n.startswith("stream_"))
STREAM = sorted(n for n in catalog.QUERIES if n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_batch(spark, duck, sf, name):
    result = check.compare(spark, duck, sf, name)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", STREAM)
def test_stream(spark, duck, sf, name):
    result = check.compare(spark, duck, sf, name)
    assert result.startswith("ok"), result


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
