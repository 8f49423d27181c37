"""Every query against its SQL counterpart, over whole tables."""

from __future__ import annotations

import pytest
from comparison import connect, differences
from conftest import SMALL

from tidemart.plans.registry import load_entries

ENTRIES = load_entries()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("key", [key for key, entry in ENTRIES.items() if entry.sql])
def test_matches_sql(spark, sf, duck, key):
    assert differences(ENTRIES[key].run(spark, sf), duck, ENTRIES[key].sql) == []


@pytest.mark.parametrize("key", [key for key, entry in ENTRIES.items() if not entry.sql])
def test_runs(spark, sf, key):
    assert ENTRIES[key].run(spark, sf).count() > 0
