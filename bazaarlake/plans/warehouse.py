"""Whole-layer runs over a table store: bronze to silver, silver to gold."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions.dates import month_of_key
from bazaarlake.functions.text import row_document
from bazaarlake.operators import quality
from bazaarlake.operators.dedup import keep_first
from bazaarlake.plans import gold, silver
from bazaarlake.plans.reconcile import layer_diff, layer_match
from bazaarlake.plans.silver import Cleaned, Options
from bazaarlake.sources.tables import Lake, write_table

# Orphan keys up to this many are broadcast to the rows; more of them meet the rows as Spark sees fit.
FEW_ORPHANS = 100_000


def _store(lake: Lake, cleaned: Cleaned, audit: bool) -> DataFrame:
    """Runs the checks once, into a staging table split by outcome, then fills both targets.

    The accepted rows and the rejects both start from that table, so neither the source nor
    the reference joins are evaluated twice, and a lost executor costs only its own tasks. It
    goes once both stand, so never more than one table is staged.
    """
    name = cleaned.table.name
    failed = F.col(quality.VERDICT).isNotNull()
    staged = cleaned.assessed.frame.select(
        *cleaned.table.names,
        F.when(failed, cleaned.document).alias("record_data"),
        cleaned.assessed.reason.alias("reason"),
        cleaned.assessed.rule_id.alias("rule_id"),
        failed.alias("rejected"),
    )
    lake.write(staged, "staging", name, partition_by="rejected", rebalance=False)
    stage = lake.spark.read.schema(staged.schema).parquet(lake.path("staging", name))
    rows = keep_first(stage.where(~F.col("rejected")).select(*cleaned.table.names), list(cleaned.key))
    if audit:
        rows = rows.withColumn("cleaned_at", F.current_timestamp())
    lake.write(rows, "silver", name)
    rejects = stage.where("rejected").select(
        F.lit(name).alias("table_name"), "record_data", "reason", "rule_id"
    )
    lake.add_rejects(rejects, name)
    lake.drop("staging", name)
    for ref in cleaned.table.references:
        lake.drop("staging", f"orphelins_{name}_{ref.column}")
    return lake.read("silver", name)


def _settled(lake: Lake, orphans: DataFrame, table: str, column: str) -> DataFrame:
    """The orphan keys of a reference, written beside the staged table and read back."""
    path = lake.path("staging", f"orphelins_{table}_{column}")
    few = write_table(orphans, path) <= FEW_ORPHANS
    listed = lake.spark.read.schema(orphans.schema).parquet(path)
    return F.broadcast(listed) if few else listed


def with_stream(lake: Lake, landed: DataFrame, table: str) -> DataFrame:
    """The landed rows and those that a stream has landed beside them."""
    if not lake.exists("bronze", f"{table}_flux"):
        return landed
    streamed = lake.read("bronze", f"{table}_flux")
    return landed.unionByName(streamed.select(*[F.col(c).cast("string").alias(c) for c in landed.columns]))


def run_silver(lake: Lake, options: Options = silver.DEFAULTS, audit: bool = True) -> DataFrame:
    """Cleans every bronze table into silver; returns the bronze to silver report.

    Full refresh: silver and its rejects are written as a new version, which replaces the old one at the end. Sales, the largest
    table, are staged while the least else is written.
    """
    with lake.refresh("staging", keep=1) as lake_out, lake_out.refresh("silver") as out:
        options = replace(options, settle=lambda orphans, table, column: _settled(out, orphans, table, column))
        bronze = lake.read_layer("bronze")
        for name in ("fait_ventes", "fait_retours"):
            bronze[name] = with_stream(lake, bronze[name], name)
        suppliers = _store(out, silver.clean_suppliers(bronze["dim_fournisseur"], options), audit)
        dims = {
            "dim_magasin": _store(out, silver.clean_stores(bronze["dim_magasin"], options), audit),
            "dim_fournisseur": suppliers,
            "dim_produit": _store(out, silver.clean_products(bronze["dim_produit"], suppliers, options), audit),
            "dim_client": _store(out, silver.clean_customers(bronze["dim_client"], options), audit),
            "dim_temps": _store(out, silver.clean_calendar(bronze["dim_temps"], options), audit),
        }
        _store(out, silver.clean_sales(bronze["fait_ventes"], dims, options), audit)
        _store(out, silver.clean_stock(bronze["fait_stock"], dims, options), audit)
        orders = _store(out, silver.clean_orders(bronze["fait_commandes"], dims, options), audit)
        lines = silver.clean_order_lines(bronze["fait_lignes_commandes"], dims, orders, options)
        _store(out, lines, audit)
        _store(out, silver.clean_returns(bronze["fait_retours"], dims, options), audit)
    # What was staged is what was read, streamed rows included.
    return layer_diff(lake.counts("staging"), lake.counts("silver"))


def _store_fact(lake: Lake, name: str, facts: Iterable[DataFrame], days: DataFrame, line_keys: bool) -> DataFrame:
    """Stages a fact with its verdicts, then writes what is kept to gold and the rest to gold's quarantine.

    ``facts`` are the slices of its rows. They follow one another, and line keys go on from slice to slice, so that what is staged
    and shuffled at a time is one slice.
    """
    number, day, written = line_keys and name in gold.LINE_KEYED, gold.PARTITION_DATE.get(name), 0
    for i, fact in enumerate(facts):
        slice_name = f"{name}_{i}"
        path = lake.path("staging_gold", slice_name)
        staged, rows = gold.stage(gold.judged(fact, name, days), path)
        lake.record("staging_gold", name, rows, "append" if i else "overwrite")
        kept = gold.number_lines(staged, name, path, written + 1) if number else staged
        kept = kept.where(~F.col("rejected")).drop("reason", "rejected")
        if day:
            kept = kept.withColumn("annee_mois", month_of_key(F.col(day)))
        mode = "append" if written else "overwrite"
        written += lake.write(kept, "gold", name, mode=mode, partition_by="annee_mois" if day else None)
        rejects = staged.where("rejected").select(
            F.lit(name).alias("table_name"), row_document(fact.columns).alias("record_data"), "reason"
        )
        lake.add_rejects(rejects, name, replace=not i, layer="gold")
        lake.drop("staging_gold", slice_name)
    return lake.read("gold", name)


def run_gold(
    lake: Lake,
    calendar: DataFrame | None = None,
    line_keys: bool = True,
    audit: bool = True,
    keep_keys: bool = False,
) -> DataFrame:
    """Builds gold from silver; returns the silver to gold report.

    Without ``calendar`` the days are those of the facts' years. Facts on days that the calendar lacks go to gold's quarantine.
    ``keep_keys`` keeps the surrogate keys of dimension rows that gold already holds. Gold is written as a new version,
    which replaces the old one at the end.
    """
    with lake.refresh("staging_gold", keep=1) as staging, staging.refresh("gold") as out:
        source = lake.read_layer("silver")
        known = {}
        if keep_keys:
            for table in contract.DIMENSIONS[:-1]:
                known[table.name] = lake.read("gold", table.name).select(*table.key, gold.SURROGATE[table.name])
        built = gold.build_dimensions(source, calendar, known, audit)
        dims = {"dim_fournisseur": out.hand_off(built["dim_fournisseur"], "gold", "dim_fournisseur")}
        products = gold.build_products(
            source["dim_produit"], dims["dim_fournisseur"], known.get("dim_produit"), audit
        )
        dims["dim_produit"] = out.hand_off(products, "gold", "dim_produit")
        for name in ("dim_magasin", "dim_client", "dim_temps"):
            dims[name] = out.hand_off(built[name], "gold", name)

        keys, days = gold.KeyMaps(dims), dims["dim_temps"]
        orders = _store_fact(out, "fait_commandes", [gold.build_orders(source["fait_commandes"], keys)], days, line_keys)
        builders = {
            "fait_ventes": lambda rows: gold.build_sales(rows, keys),
            "fait_stock": lambda rows: gold.build_stock(rows, keys),
            "fait_lignes_commandes": lambda rows: gold.build_order_lines(rows, keys, orders, "left"),
            "fait_retours": lambda rows: gold.build_returns(rows, keys),
        }
        for name, build in builders.items():
            _store_fact(out, name, map(build, lake.slices("silver", name)), days, line_keys)
    return layer_match(lake.counts("silver"), lake.counts("gold"))
