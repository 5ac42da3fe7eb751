import pytest

from checks.catalog import CHECKS
from checks.verify import compare, connect

SAMPLE = [
    "sales_monthly", "customer_perf", "stock_mgmt", "returns_analysis", "gold_fait_retours", "rejects_summary",
    "sample_seeded", "sk_stable", "events_roundtrip", "report_store", "recon_gold",
]


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, connection, folder, name):
    verdict, _, _ = compare(spark, connection, name, folder)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert [n for n, c in CHECKS.items() if c.sql is None] == []


@pytest.mark.parametrize(
    "table, key", [("stock", "stock_sk"), ("lignes_commandes", "ligne_commande_sk"), ("ventes", "vente_sk"), ("retours", "retour_sk")]
)
def test_gold_facts_carry_their_line_keys(spark, connection, folder, table, key):
    """The keys that SQL gives, not only as many."""
    assert key in CHECKS[f"gold_fait_{table}"].types
    verdict, _, _ = compare(spark, connection, f"gold_fait_{table}", folder)
    assert verdict.startswith("ok"), verdict
