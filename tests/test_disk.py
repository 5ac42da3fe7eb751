"""What a query leaves on disk while it runs: shuffles of parts that follow one another, and what the rows of a shuffle carry."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.operators import quality
from bazaarlake.operators.references import Link, audit_links
from bazaarlake.plans import dashboard, insights, warehouse
from bazaarlake.sources import events
from bazaarlake.sources.tables import Lake, in_turn
from bazaarlake.streaming.events import SALE_EVENT, nest_sales, parse
from checks import faults, written
from checks.landing import Retailer


def plan(df, which="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


@pytest.fixture(scope="module")
def gold(spark):
    rows = {
        "dim_magasin": ([(1, "M1", "Store A", "V", "R", 10), (2, "M2", "Store B", "W", "R", 20)],
                        "magasin_sk long, magasin_nk string, nom string, ville string, region string, surface_m2 int"),
        "dim_fournisseur": ([(1, "Slow", 12), (2, "Fast", 2)], "fournisseur_sk long, nom string, delai_livraison_jours int"),
        "dim_produit": ([(1, "P1", "x", "PROMO", "s", 1), (2, "P2", "y", "OTHER", "s", 2)],
                        "produit_sk long, produit_nk string, nom string, categorie string, sous_categorie string, fournisseur_sk long"),
        "fait_stock": ([(1, 1, 5, Decimal("10.00"), False), (2, 2, 0, Decimal("0.00"), True)],
                       "produit_sk long, magasin_sk long, quantite_en_stock int, valeur_stock_ht decimal(12,2), en_rupture boolean"),
        "fait_ventes": ([(1, 1, 2, Decimal("30.00")), (1, 2, 1, Decimal("10.00")), (2, 1, 1, Decimal("60.00"))],
                        "magasin_sk long, produit_sk long, quantite int, montant_ttc decimal(12,2)"),
        "fait_retours": ([("late", 1, 1, 1, Decimal("4.00")), ("late", 1, 2, 2, Decimal("6.00")), ("torn", 2, 1, 1, Decimal("1.00"))],
                         "motif string, produit_sk long, magasin_sk long, quantite_retournee int, montant_rembourse decimal(12,2)"),
    }
    out = {n: spark.createDataFrame(*r) for n, r in rows.items()}
    out["fait_ventes"] = out["fait_ventes"].withColumns({c: F.col("montant_ttc") for c in ("montant_ht", "marge_brute_total")})
    return out


def test_parts_are_stored_in_turn(spark):
    seen = []

    def part(n):
        seen.append(n)
        return spark.range(n).groupBy((F.col("id") % 3).alias("k")).count()

    both = in_turn(part(n) for n in (4, 6))
    assert seen == [4, 6] and "Aggregate" not in plan(both)
    assert sorted(r["count"] for r in both.collect()) == [1, 1, 2, 2, 2, 2]


def test_alerts_and_return_figures_do_not_hold_the_facts_together(gold):
    alerts = insights.alerts(gold, "PROMO", 10)
    assert "Join" not in plan(alerts)
    got = {r["code"]: (r["subject"], r["amount"]) for r in alerts.collect()}
    assert got == {"delai_fournisseur": ("Slow", 12.0), "remboursements_categorie": ("PROMO", 10.0), "equilibre_magasins": ("2", 60.0)}
    figures = dashboard.return_figures(gold)
    assert "Join" not in plan(figures)
    row = figures.first()
    assert (row["total_retours"], row["motif_principal"], row["taux_retour_pct"]) == (3, "late", Decimal("100.00"))


def test_rules_of_the_row_are_judged_before_the_joins(spark):
    rows = spark.createDataFrame(
        [(1, "a", "x", None), (2, "z", None, None), (3, "z", "x", None), (4, "a", "x", "long"), (5, None, "x", None), (6, "a", None, "long")],
        "id int, k string, note string, more string",
    )
    parents = {"dim_client": spark.createDataFrame([("a",)], "client_nk string")}
    reference = contract.Reference("k", "dim_client", "client_nk", "no parent")
    late = [quality.Rule("more_too_long", "coalesce(length(more) > 3, false)", "late")]
    done = quality.assess(rows, quality.missing("early", "note"), (reference,), parents, late)
    got = {r["id"]: r["rule"] for r in done.frame.select("id", done.rule_id.alias("rule")).collect()}
    assert got == {1: None, 2: "note_null", 3: "k_orphan", 4: "more_too_long", 5: "k_orphan", 6: "note_null"}
    lines = plan(done.frame.groupBy(quality.VERDICT).count()).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert "AS _own" in "".join(lines[join:]) and "length(more" not in "".join(lines[:join])


def test_verdicts_are_counted_table_by_table(spark, folder):
    assert "Join" not in plan(faults.verdicts(Retailer(spark, folder)))


def test_lines_of_a_ticket_meet_as_they_are(spark):
    day = dt.datetime(2024, 1, 2, 3, 4, 5)
    rows = [("t", day, "m", "c", "p1", 1, Decimal("2.00"), Decimal("2.00")), ("t", day, "m", None, "p2", 2, Decimal("3.00"), Decimal("6.00"))]
    lines = spark.createDataFrame(
        rows, "ticket_nk string, timestamp_vente timestamp, magasin_nk string, client_nk string, produit_nk string, quantite int, "
        "prix_unitaire_ttc decimal(12,2), montant_ttc decimal(12,2)",
    )
    nested = nest_sales(lines)
    tree = plan(nested, "sparkPlan").splitlines()
    shuffle = next(i for i, line in enumerate(tree) if "Exchange" in line or "RepartitionByExpression" in line)
    assert all("collect_list" not in line for line in tree[shuffle:])
    event = parse(nested, SALE_EVENT).first()
    assert (event["magasin_nk"], event["client_nk"], event["montant_total_ttc"], len(event["lignes"])) == ("m", None, 8.0, 2)


def test_audit_reads_its_tables_in_turn(spark):
    tables = {
        "s.child": spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string"),
        "s.parent": spark.createDataFrame([("a",), ("a",)], "p string"),
    }
    audit = audit_links(tables, [Link("s.child", "k", "s.parent", "p")])
    assert "Generate" in plan(audit) and "explode(array(struct(target" not in plan(audit)
    assert [tuple(r) for r in audit.collect()] == [("s.child", "k", "s.parent", 1, 2, 1)]


def test_stock_is_dealt_once_by_product(spark, folder):
    tree = plan(Retailer(spark, folder).bronze["fait_stock"], "executedPlan")
    assert "hashpartitioning(date_snapshot" not in tree and "hashpartitioning(l_partkey" in tree


def test_orphan_keys_meet_the_rows_instead_of_the_parents(spark, monkeypatch, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "z"), (3, None), (4, "z")], "id int, k string")
    parents = {"dim_client": spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "client_nk string")}
    lake = Lake(spark, f"file://{tmp_path}")
    for few in (100, 0):
        monkeypatch.setattr(warehouse, "FEW_ORPHANS", few)
        for optional, expected in ((True, {1: None, 2: 1, 3: None, 4: 1}), (False, {1: None, 2: 1, 3: 1, 4: 1})):
            reference = contract.Reference("k", "dim_client", "client_nk", "no parent", optional)
            settle = lambda keys, column: warehouse._settled(lake, keys, "t", column)
            done = quality.assess(rows, [], (reference,), parents, settle=settle).frame
            assert {r["id"]: r[quality.VERDICT] for r in done.collect()} == expected
            assert [r["k"] for r in spark.read.parquet(f"{tmp_path}/staging/orphelins_t_k").collect()] == ["z"]


def test_a_fact_goes_to_gold_in_slices(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    silver = spark.range(0, 90, 1, 6).selectExpr("cast(20240101 + id % 3 as int) as date_sk", "cast(id as string) as ticket_nk")
    lake.write(silver, "silver", "fait_ventes")
    slices = lake.slices("silver", "fait_ventes", 1)
    assert len(slices) == 6 and sorted(r["ticket_nk"] for s in slices for r in s.collect()) == sorted(str(i) for i in range(90))
    assert len(lake.slices("silver", "fait_ventes")) == 1
    days = spark.createDataFrame([(20240101,), (20240102,)], "temps_sk int")
    stored = warehouse._store_fact(lake, "fait_ventes", slices, days, True)
    assert sorted(r["vente_sk"] for r in stored.collect()) == list(range(1, 61))
    assert lake.rejects("gold").count() == 30
    assert {r["table_name"]: r["nb_lignes"] for r in lake.counts("gold").collect()} == {"fait_ventes": 60}
    assert not any(lake.exists("staging_gold", f"fait_ventes_{i}") for i in range(6))


def test_slices_without_kept_rows_come_first_or_alone(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    days = spark.createDataFrame([(20240101,)], "temps_sk int")
    parts = [spark.createDataFrame([(d, "t")], "date_sk int, ticket_nk string") for d in (20250101, 20240101, 20250101)]
    assert [r["vente_sk"] for r in warehouse._store_fact(lake, "fait_ventes", parts, days, True).collect()] == [1]
    assert lake.rejects("gold").count() == 2


def test_a_backlog_of_event_files_is_several_batches(spark, monkeypatch, tmp_path):
    for i in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.txt").write_text("{}\n")
    monkeypatch.setattr(events, "BATCH_BYTES", 1)
    seen = []
    stream = events.event_stream(spark, "text", f"{tmp_path}/in")
    query = stream.writeStream.foreachBatch(lambda rows, _: seen.append(rows.count())).option("checkpointLocation", f"{tmp_path}/c")
    query.trigger(availableNow=True).start().awaitTermination(120)
    assert seen == [1, 1, 1]


def test_landed_tables_go_once_silver_stands(spark, folder):
    lake = written.silver_copy(Retailer(spark, folder))
    assert lake.exists("silver", "fait_ventes") and not lake.exists("bronze", "fait_ventes")
