import pytest

from conftest import SMALL
from oracle_check import compare, duck

FAST = ["pairwise_candidates", "A3_other_group_evidence", "A7_family_presence", "A17_frequency_bins", "A16_rescue_filter",
        "W2_family_rank", "A23_islands", "M3_fisher_exact", "J9_linkage_fraction", "M20_hypergeometric_overlap", "M9_dollo",
        "J5_record_match", "S11_protein_positions", "X1_stream_intake"]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as entry
    n, _, problem = compare(spark, con, SMALL, name, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None


def test_entry_and_registry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() == 44
    assert set(entry.oracle_sql()) <= set(entry.queries())
