"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as entry
from linkhoard.plans.oracles import all_oracles
from linkhoard.plans.queries import all_queries
from linkhoard.sources import tables

from .compare import difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", list(all_queries()))
def test_query_matches_its_sql(spark, key):
    assert difference(all_queries()[key](spark, SF_DIR), SF_DIR, all_oracles()[key]) is None


@pytest.mark.parametrize("key", ["limit_per_source", "limit_nulls", "redirect_chain", "crawl_urls", "crawl_bodies", "archive_rules"])
def test_plans_for_large_tables_give_the_same_rows(spark, key, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_ROWS", -1)
    assert difference(all_queries()[key](spark, SF_DIR), SF_DIR, all_oracles()[key]) is None


def test_every_query_has_an_oracle():
    assert all_queries().keys() == all_oracles().keys()
    assert all_queries().keys() <= entry.queries().keys() and all_oracles().keys() <= entry.oracle_sql().keys()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
