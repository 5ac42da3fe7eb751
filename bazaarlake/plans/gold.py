"""Silver to gold: the star schema with surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions.dates import date_key
from bazaarlake.operators.calendar import calendar, fitted_bounds
from bazaarlake.operators.joins import Lookup, flag_orphans
from bazaarlake.operators.keys import dense_keys, extend_keys, number_written
from bazaarlake.sources.tables import write_table

# Surrogate key of each gold table; the calendar's key is the date itself.
SURROGATE = {
    "dim_magasin": "magasin_sk",
    "dim_fournisseur": "fournisseur_sk",
    "dim_produit": "produit_sk",
    "dim_client": "client_sk",
    "dim_temps": "temps_sk",
    "fait_stock": "stock_sk",
    "fait_commandes": "commande_sk",
    "fait_lignes_commandes": "ligne_commande_sk",
    "fait_ventes": "vente_sk",
    "fait_retours": "retour_sk",
}
# Date key a fact is partitioned by when written.
PARTITION_DATE = {
    "fait_stock": "date_snapshot_sk",
    "fait_ventes": "date_sk",
    "fait_retours": "date_retour_sk",
}
# Stores are few whatever the sales, so they are broadcast without waiting for their measured size.
FEW_ROWS = ("dim_magasin",)


class KeyMaps:
    """Natural to surrogate key lookups, shared by all facts. ``one_row`` is for dimensions that are computed, not read, and known to
    have one row per key (see ``Lookup``)."""

    def __init__(self, dims: Mapping[str, DataFrame], strategy: str | None = None, one_row: bool = False):
        self._lookups = {
            name: Lookup(
                df, contract.TABLES[name].key[0], [SURROGATE[name]],
                strategy=strategy or ("broadcast" if name in FEW_ROWS else None), one_row=one_row,
            )
            for name, df in dims.items()
            if name != "dim_temps"
        }

    def attach(self, fact: DataFrame, table: str, how: str = "inner") -> DataFrame:
        return self._lookups[table].attach(fact, how)


def _dimension(silver: DataFrame, table: contract.Table, known: DataFrame | None, audit: bool) -> DataFrame:
    natural, surrogate = table.key[0], SURROGATE[table.name]
    rows = silver.select(*table.names)
    if known is None:
        keyed = dense_keys(rows, [natural], surrogate)
    else:
        keyed = rows.join(extend_keys(known, rows, natural, surrogate), natural)
        keyed = keyed.select(surrogate, *table.names)
    if audit:
        keyed = keyed.withColumns({"est_actif": F.lit(True), "date_creation": F.current_timestamp()})
    return keyed


def build_stores(silver: DataFrame, known: DataFrame | None = None, audit: bool = False) -> DataFrame:
    return _dimension(silver, contract.STORES, known, audit)


def build_suppliers(silver: DataFrame, known: DataFrame | None = None, audit: bool = False) -> DataFrame:
    return _dimension(silver, contract.SUPPLIERS, known, audit)


def build_products(
    silver: DataFrame,
    suppliers: DataFrame,
    known: DataFrame | None = None,
    audit: bool = False,
) -> DataFrame:
    """The supplier's natural key is replaced by its surrogate, NULL when unknown."""
    keyed = _dimension(silver, contract.PRODUCTS, known, audit)
    lookup = Lookup(suppliers, "fournisseur_nk", ["fournisseur_sk"])
    joined = lookup.attach(keyed, "left")
    order = [c if c != "fournisseur_nk" else "fournisseur_sk" for c in keyed.columns]
    return joined.select(*order)


def build_customers(silver: DataFrame, known: DataFrame | None = None, audit: bool = False) -> DataFrame:
    return _dimension(silver, contract.CUSTOMERS, known, audit)


# The days of each fact, from which the calendar takes its range.
FACT_DAYS = {
    "fait_stock": ["date_snapshot"],
    "fait_commandes": ["date_commande", "date_livraison_prev"],
    "fait_ventes": ["date_vente"],
    "fait_retours": ["date_vente_originale", "date_retour"],
}


def build_calendar(silver: Mapping[str, DataFrame]) -> DataFrame:
    """All days of the years that the facts touch. Days before ``EARLIEST_DAY`` or after ``LATEST_DAY`` are errors and leave no
    trace in the calendar; facts on such days go to the quarantine of gold."""
    facts = {name: (silver[name], days) for name, days in FACT_DAYS.items()}
    return calendar(fitted_bounds(facts, contract.EARLIEST_DAY, contract.LATEST_DAY))


def build_dimensions(
    silver: dict[str, DataFrame],
    days: DataFrame | None = None,
    known: dict[str, DataFrame] | None = None,
    audit: bool = False,
) -> dict[str, DataFrame]:
    """``days`` replaces the calendar fitted to the facts; ``known`` holds earlier key maps."""
    known = known or {}
    suppliers = build_suppliers(silver["dim_fournisseur"], known.get("dim_fournisseur"), audit)
    if days is None:
        days = build_calendar(silver)
    return {
        "dim_magasin": build_stores(silver["dim_magasin"], known.get("dim_magasin"), audit),
        "dim_fournisseur": suppliers,
        "dim_produit": build_products(
            silver["dim_produit"], suppliers, known.get("dim_produit"), audit
        ),
        "dim_client": build_customers(silver["dim_client"], known.get("dim_client"), audit),
        "dim_temps": days,
    }


def build_stock(silver: DataFrame, keys: KeyMaps) -> DataFrame:
    joined = keys.attach(keys.attach(silver, "dim_produit"), "dim_magasin")
    return joined.select(
        date_key(F.col("date_snapshot")).alias("date_snapshot_sk"),
        "produit_sk",
        "magasin_sk",
        "quantite_en_stock",
        "valeur_stock_ht",
        "seuil_reapprovisionnement",
        "en_rupture",
    )


def build_orders(silver: DataFrame, keys: KeyMaps, numbered: bool = True) -> DataFrame:
    """Order headers; their surrogate key is needed by the order lines."""
    joined = keys.attach(keys.attach(silver, "dim_fournisseur"), "dim_magasin")
    headers = joined.select(
        "commande_nk",
        "fournisseur_sk",
        "magasin_sk",
        date_key(F.col("date_commande")).alias("date_commande_sk"),
        date_key(F.col("date_livraison_prev")).alias("date_livraison_prev_sk"),
        "statut",
        "montant_total_ht",
    )
    return dense_keys(headers, ["commande_nk"], "commande_sk") if numbered else headers


def build_order_lines(silver: DataFrame, keys: KeyMaps, orders: DataFrame, how: str = "inner") -> DataFrame:
    """``how="left"`` keeps lines whose order gold does not have, for ``judged`` to reject."""
    numbered = Lookup(orders, "commande_nk", ["commande_sk"]).attach(silver, how)
    return keys.attach(numbered, "dim_produit").select(
        "commande_sk", "produit_sk", "quantite_commandee", "prix_unitaire_achat", "montant_ligne_ht"
    )


def build_sales(silver: DataFrame, keys: KeyMaps) -> DataFrame:
    joined = keys.attach(keys.attach(silver, "dim_magasin"), "dim_produit")
    return keys.attach(joined, "dim_client", "left").select(
        "ticket_nk",
        "timestamp_vente",
        date_key(F.col("date_vente")).alias("date_sk"),
        "magasin_sk",
        "client_sk",
        "produit_sk",
        "quantite",
        "prix_unitaire_ht",
        "tva_pct",
        "prix_unitaire_ttc",
        "montant_ht",
        "montant_ttc",
        "marge_brute_unit",
        "marge_brute_total",
    )


def build_returns(silver: DataFrame, keys: KeyMaps) -> DataFrame:
    joined = keys.attach(keys.attach(silver, "dim_produit"), "dim_magasin")
    return keys.attach(joined, "dim_client", "left").select(
        "retour_nk",
        "ticket_nk",
        "produit_sk",
        "magasin_sk",
        "client_sk",
        date_key(F.col("date_vente_originale")).alias("date_vente_originale_sk"),
        date_key(F.col("date_retour")).alias("date_retour_sk"),
        "quantite_retournee",
        "montant_rembourse",
        "motif",
    )


# Gold facts whose rows carry a number of their own; orders are numbered by their natural key, which their lines need.
LINE_KEYED = ("fait_stock", "fait_lignes_commandes", "fait_ventes", "fait_retours")


def judged(fact: DataFrame, table: str, known_days: DataFrame) -> DataFrame:
    """``fact`` with ``rejected`` and ``reason``: rows with a day that the calendar lacks or, for order lines, whose order is
    itself in quarantine."""
    days = [c for c, parent, _, _ in contract.GOLD_REFERENCES[table] if parent == "dim_temps"]
    flagged, columns = fact, fact.columns
    for i, day in enumerate(days):
        flagged = flag_orphans(flagged, day, known_days, "temps_sk", f"_outside_{i}")
    outside = reduce(lambda a, b: a | b, [F.col(f"_outside_{i}") | F.col(c).isNull() for i, c in enumerate(days)], F.lit(False))
    reason = F.when(outside, contract.OUTSIDE_CALENDAR)
    if table == "fait_lignes_commandes":
        reason = F.when(F.col("commande_sk").isNull(), contract.ORDER_IN_QUARANTINE)
    return flagged.select(*columns, reason.alias("reason")).withColumn("rejected", F.col("reason").isNotNull())


def stage(fact: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Writes a fact once, where its rows are, and returns it as read back, with the row count.

    What is kept, what is rejected and the rows' numbers all start from these files, so the joins run once. A judged
    fact is written split by verdict.
    """
    rows = write_table(fact, path, partition_by="rejected" if "rejected" in fact.columns else None, rebalance=False)
    return fact.sparkSession.read.schema(fact.schema).parquet(path), rows


def number_lines(staged: DataFrame, table: str, path: str, start: int = 1) -> DataFrame:
    """The kept rows of a staged fact with its own dense surrogate key from ``start`` on. The views count rows and do not need it."""
    kept = "NOT rejected" if "rejected" in staged.columns else None
    return number_written(staged.sparkSession, path, staged.schema, SURROGATE[table], start, where=kept)


# Columns that identify a row of each of these facts.
LINE_KEYS = {
    "fait_stock": ["date_snapshot_sk", "produit_sk", "magasin_sk"],
    "fait_lignes_commandes": ["commande_sk", "produit_sk"],
    "fait_ventes": ["ticket_nk", "produit_sk"],
    "fait_retours": ["retour_nk"],
}


def key_lines(staged: DataFrame, table: str) -> DataFrame:
    """The rows of a staged fact with a dense surrogate key that follows from their keys alone, whatever file they lie in: a rebuilt fact
    has the same numbers. Unlike ``number_lines`` it shuffles the rows once."""
    return dense_keys(staged, LINE_KEYS[table], SURROGATE[table])
