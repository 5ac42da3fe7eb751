import os

import pytest
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.operators import calendar as cal
from bazaarlake.plans import dashboard, gold, silver, views, warehouse
from bazaarlake.sources import files, jdbc
from bazaarlake.sources.sql import register_views, run_query
from bazaarlake.sources.tables import Lake, write_table
from checks import written
from checks.landing import Retailer


@pytest.fixture(scope="module")
def built(spark, folder, tmp_path_factory):
    """CSV files to bronze, silver and gold, all through files."""
    root = str(tmp_path_factory.mktemp("lake"))
    shop = Retailer(spark, folder)
    for name in contract.TABLES:
        shop.bronze[name].coalesce(1).write.option("header", True).csv(f"{root}/csv/{name}.csv")
    lake = Lake(spark, root)
    metrics = files.ingest_csv(spark, f"{root}/csv", lake)
    diff = warehouse.run_silver(lake)
    match = warehouse.run_gold(lake, calendar=cal.calendar(shop.day_bounds()))
    return lake, metrics, diff, match


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_ingest_counts(built):
    _, metrics, _, _ = built
    counts = as_dict(metrics, "table_name", "nb_lignes")
    assert counts["fait_ventes"] == 6184 and counts["dim_magasin"] == 26


def test_silver_volumes_and_rejects(built):
    lake, _, diff, _ = built
    silver = as_dict(diff, "table_name", "nb_silver")
    assert silver["fait_ventes"] == 5670
    assert silver["TOTAL"] == sum(v for k, v in silver.items() if k != "TOTAL")
    rejects = lake.rejects()
    assert rejects.count() == 280
    assert as_dict(rejects.groupBy("reason").count(), "reason", "count") == {
        contract.REJECT_REASONS["fait_ventes"]: 224,
        "client_nk fantome inexistant": 56,
    }
    assert rejects.where(F.col("record_data").contains("DATE_INVALIDE")).count() == 63


def test_gold_matches_and_keys_are_dense(built):
    lake, _, _, match = built
    assert set(as_dict(match, "table_name", "statut").values()) == {"MATCH"}
    sales = lake.read("gold", "fait_ventes")
    assert sales.agg(F.min("vente_sk"), F.max("vente_sk"), F.count_distinct("vente_sk")).first()[:] == (1, 5670, 5670)
    assert "annee_mois" in sales.columns
    before = lake.read("silver", "fait_ventes").agg(F.sum("montant_ttc")).first()[0]
    assert sales.agg(F.sum("montant_ttc")).first()[0] == before


def test_views_on_files_equal_views_on_plans(spark, folder, built):
    gold = built[0].read_layer("gold")
    lazy = Retailer(spark, folder).gold
    for build in (views.monthly_sales, views.store_performance):
        a, b = build(gold), build(lazy)
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_year_filter_prunes_partitions(built):
    gold = built[0].read_layer("gold")
    months = views.monthly_sales(gold, year=1997, ordered=False)
    plan = months._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan[plan.index("PartitionFilters"):][:200]
    assert "annee_mois" in partition_filters and "199701" in partition_filters
    assert "ticket_nk" not in plan[plan.index("ReadSchema"):][:300]
    assert months.count() == views.monthly_sales(gold, ordered=False).where("annee = 1997").count()


def test_sql_surface(spark, built):
    gold = built[0].read_layer("gold")
    assert len(register_views(gold)) == 7
    got = run_query(spark, "SELECT COUNT(*) AS n FROM vue_ventes_mensuelles WHERE annee = :year", year=1998).first().n
    assert got == views.monthly_sales(gold).where("annee = 1998").count() > 0
    with pytest.raises(Exception):
        run_query(spark, "SELECT * FROM no_such_view").count()


def test_filters_are_values_not_text(built):
    gold = built[0].read_layer("gold")
    assert dashboard.monthly(gold, store="x' OR '1'='1").count() == 0
    assert dashboard.top_products(gold, 3, contract.ALL_CATEGORIES).count() == 3
    empty = {**gold, "fait_ventes": gold["fait_ventes"].where(F.lit(False))}
    assert [r[0] for r in dashboard.available_years(empty).collect()] == [contract.DEFAULT_YEAR]
    assert dashboard.kpis(empty).first().total_transactions == 0


def test_unsold_products_come_last(built):
    ranked = views.product_performance(built[0].read_layer("gold")).collect()
    assert ranked[-1].chiffre_affaires_ttc is None and ranked[0].chiffre_affaires_ttc is not None


def test_rerun_replaces_and_keeps_keys(built):
    lake = built[0]
    before = as_dict(lake.read("gold", "dim_client"), "client_nk", "client_sk")
    warehouse.run_silver(lake)
    assert lake.rejects().count() == 280 and lake.read("silver", "fait_ventes").count() == 5670
    gone = lake.read("silver", "dim_client").where("client_nk <> '5'")
    lake.write(lake.hand_off(gone, "tmp", "dim_client"), "silver", "dim_client")
    warehouse.run_gold(lake, calendar=lake.hand_off(lake.read("gold", "dim_temps"), "tmp", "dim_temps"), keep_keys=True)
    after = as_dict(lake.read("gold", "dim_client"), "client_nk", "client_sk")
    assert "5" not in after and all(before[k] == v for k, v in after.items())


def test_a_dying_refresh_leaves_the_old_layer(built, monkeypatch):
    lake = built[0]
    before, version = sorted(map(tuple, lake.read("gold", "fait_ventes").collect()), key=repr), lake.version("gold")

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(gold, "build_returns", die)
    with pytest.raises(RuntimeError, match="lost"):
        warehouse.run_gold(lake)
    assert lake.version("gold") == version
    assert sorted(map(tuple, lake.read("gold", "fait_ventes").collect()), key=repr) == before


def test_versions_and_ledger(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.write(spark.range(5), "bronze", "t", mode="append")
    lake.write(spark.range(3), "bronze", "t", mode="append")
    assert as_dict(lake.counts("bronze"), "table_name", "nb_lignes") == {"t": 8}
    lake.write(spark.range(2), "bronze", "t")
    assert as_dict(lake.counts("bronze"), "table_name", "nb_lignes") == {"t": 2} and lake.version("bronze") is None
    for n in (4, 6, 7):
        with lake.refresh("gold", keep=2) as out:
            out.write(spark.range(n), "gold", "t")
            assert out.read("gold", "t").count() == n
    assert lake.read("gold", "t").count() == 7 and len(lake.versions("gold")) == 2
    assert as_dict(lake.counts("gold"), "table_name", "nb_lignes") == {"t": 7}


def test_gold_keeps_or_quarantines_every_sale(built):
    """The published calendar begins after all sales of the given tables."""
    lake = built[0]
    days = cal.warehouse_calendar(lake.spark)
    warehouse.run_gold(lake, calendar=days, audit=False)
    assert lake.read("gold", "fait_ventes").count() == 0
    rejects = as_dict(lake.rejects("gold").groupBy("table_name").count(), "table_name", "count")
    silver = as_dict(lake.counts("silver"), "table_name", "nb_lignes")
    assert all(rejects[t] == silver[t] for t in ("fait_ventes", "fait_retours", "fait_stock", "fait_commandes", "fait_lignes_commandes"))
    reasons = {r[0] for r in lake.rejects("gold").where("table_name = 'fait_lignes_commandes'").select("reason").distinct().collect()}
    assert reasons == {contract.ORDER_IN_QUARANTINE}
    report = as_dict(warehouse.run_gold(lake, audit=False), "table_name", "statut")
    assert set(report.values()) == {"MATCH"} and lake.rejects("gold").count() == 0


def test_rows_stay_where_the_key_check_dealt_them(spark, folder):
    """Parents of the business key are joined last, so dropping copies and gold's lookup of the key need no shuffle of their own."""
    shop = Retailer(spark, folder)
    merge = silver.Options(join_strategy="merge")
    parents = {n: shop.cleaned[n].valid for n in ("dim_magasin", "dim_produit", "dim_client")}
    cleaned = silver.clean_sales(shop.bronze["fait_ventes"], parents, merge)
    looked_up = gold.KeyMaps({"dim_produit": shop.gold["dim_produit"]}, "merge").attach(cleaned.rows, "dim_produit")
    plan = looked_up._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(ticket_nk" not in plan and plan.count("WindowGroupLimit") >= 1
    plain = silver.clean_sales(shop.bronze["fait_ventes"], parents)
    assert cleaned.rows.exceptAll(plain.rows).isEmpty() and looked_up.count() == plain.rows.count() == 5670
    reasons = lambda c: sorted(map(tuple, c.rejects.groupBy("reason", "rule_id").count().collect()))
    assert reasons(cleaned) == reasons(plain)


def test_layer_runs_leave_no_staging_and_no_shuffles(built):
    lake = built[0]
    warehouse.run_silver(lake)
    warehouse.run_gold(lake)
    for layer in ("staging", "staging_gold"):
        assert not any(lake.exists(layer, name) for name in contract.TABLES)
    # The reports come from the ledger, which keeps the counts of what was staged.
    assert as_dict(lake.counts("staging"), "table_name", "nb_lignes")["fait_ventes"] == 6184
    assert lake.spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_a_write_drops_its_shuffles(spark, tmp_path):
    import glob

    local = spark.conf.get("spark.local.dir", os.environ.get("SPARK_LOCAL_DIRS", "/tmp"))
    files = lambda: set(glob.glob(f"{local}/blockmgr-*/**/shuffle_*.data", recursive=True))
    start = files()
    spark.range(1000).repartition(3, "id").write.format("noop").mode("overwrite").save()
    before = files()
    assert before - start  # a plain query leaves its files
    assert write_table(spark.range(1000).repartition(3, "id"), str(tmp_path / "t")) == 1000
    assert not files() - before


def test_silver_copies_need_no_gold(spark, folder):
    lake = written.built(Retailer(spark, folder), "silver")
    assert lake.exists("silver", "fait_retours")
    again = written.built(Retailer(spark, folder), "bronze")
    assert again is lake and as_dict(lake.counts("bronze"), "table_name", "nb_lignes")["fait_ventes"] == 6184


def test_refresh_drops_months_that_are_gone(spark, tmp_path):
    path = str(tmp_path / "months")
    two = spark.createDataFrame([(1, 202401), (2, 202402)], "v int, annee_mois int")
    write_table(two, path, partition_by="annee_mois")
    write_table(two.where("v = 2"), path, partition_by="annee_mois")
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [2]


def test_empty_write_reports_zero(spark, tmp_path):
    assert write_table(spark.range(3).where("id > 5"), str(tmp_path / "t")) == 0


def test_csv_is_text_and_checked(spark, tmp_path):
    path = tmp_path / "dim_magasin.csv"
    path.write_bytes("﻿magasin_nk,nom,extra\n007,Été,1\n8,,2\n".encode("utf-8"))
    read = files.read_csv_text(spark, str(path))
    got = files.select_required(read, ["magasin_nk", "nom"]).collect()
    assert [tuple(r) for r in got] == [("007", "Été"), ("8", None)]
    with pytest.raises(ValueError, match="ville"):
        files.select_required(read, ["magasin_nk", "ville"])
    with pytest.raises(Exception):
        files.read_csv_text(spark, str(tmp_path / "none.csv"))


def test_jdbc_options():
    read = jdbc.jdbc_read_options("jdbc:x", "t", "id", 1, 100, 8, user="u")
    assert read["numPartitions"] == "8" and read["partitionColumn"] == "id" and read["user"] == "u"
    assert "partitionColumn" not in jdbc.jdbc_read_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc.jdbc_read_options("jdbc:x", "t", "id")
    assert jdbc.jdbc_write_options("jdbc:x", "t")["batchsize"] == "10000"
