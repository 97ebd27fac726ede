"""A part of the registered queries against their SQL at the smallest scale."""

import duckdb
import pytest

from check import normal
from massloom.catalog.inputs import TABLES
from massloom.catalog.registry import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
SOME = [
    "best_match_summary", "w01_best_psm", "a06_search_summary", "p08_rt_seconds", "p15_unimod_to_mass", "w06_psm_id",
    "a03_site_fractions", "a05_mods_to_maps", "j02_match_mods", "a10_spectrum_stats", "a12_composite", "a13_w12_reporter_peaks",
    "p18_instrument", "x01_digest", "j13_candidates", "a02_taxon_weights", "g02_factors", "a25_goodness",
    "j03_reconcile_taxids", "p22_protocol_facts", "a14_event_summary", "a21_batch_stats", "t03_stream_sessions", "s03_k01_psm_tsv",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, con, name):
    got, want = queries()[name](spark, FOLDER).toPandas(), con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
