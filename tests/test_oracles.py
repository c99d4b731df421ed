"""Every query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
import check_oracles
from workload.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return check_oracles.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf, name):
    ok, note = check_oracles.compare(spark, con, name, sf)
    # A few groups are empty at this scale; then the oracle must be empty too.
    assert ok or note == "0 rows", note


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["crawl_id", "platform", "city", "restaurant_count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
