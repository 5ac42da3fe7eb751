"""Alerts and insights as a table: (level, code, subject, amount, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.contract import LONG_LEAD_TIME_DAYS
from bazaarlake.functions.amounts import percent
from bazaarlake.operators.ranking import highest
from bazaarlake.plans import dashboard, views
from bazaarlake.plans.views import Gold
from bazaarlake.sources.tables import in_turn


def _entry(rows: DataFrame, level: str, code: str, subject: Column, amount: Column, message: Column) -> DataFrame:
    return rows.select(
        F.lit(level).alias("level"),
        F.lit(code).alias("code"),
        subject.cast("string").alias("subject"),
        amount.cast("double").alias("amount"),
        message.alias("message"),
    )


def _thousands(value: Column) -> Column:
    return F.format_number(F.round(value.cast("decimal(38,2)"), 0), 0)


def long_lead_times(gold: Gold, days: int = LONG_LEAD_TIME_DAYS) -> DataFrame:
    """Suppliers slower than ``days``, named together with the longest lead time."""
    # The stock view repeats a supplier per product and store; distinct names come first.
    stock = views.stock_management(gold, ordered=False)
    slow = stock.where(F.col("delai_livraison_jours") > days)
    named = slow.groupBy("fournisseur_nom").agg(F.max("delai_livraison_jours").alias("d"))
    found = named.agg(
        F.array_join(F.array_sort(F.collect_list("fournisseur_nom")), ", ").alias("noms"),
        F.max("d").alias("delai_max"),
    ).where(F.col("delai_max").isNotNull())
    message = F.concat(
        F.lit("Délai Approvisionnement Élevé : "), "noms", F.lit(" ("), F.col("delai_max").cast("string"), F.lit(" jours)")
    )
    return _entry(found, "warning", "delai_fournisseur", F.col("noms"), F.col("delai_max"), message)


def category_refunds(gold: Gold, category: str) -> DataFrame:
    """Refunds of one category, with its main return reason."""
    rows = views.returns_analysis(gold, ordered=False).where(F.col("categorie_produit") == F.lit(category))
    by_reason = rows.groupBy("motif").agg(F.sum("total_retours").alias("n"))
    main = highest(by_reason, "n", "motif").select("motif")
    found = rows.agg(F.sum("total_montant_rembourse").alias("montant")).where(F.col("montant").isNotNull())
    found = found.select("montant", main.scalar().alias("motif"))
    message = F.concat(
        F.lit(f"Impact Financier SAV : {category} totalise "),
        _thousands(F.col("montant")),
        F.lit(" MAD de remboursements (motif dominant : "),
        "motif",
        F.lit(")"),
    )
    return _entry(found, "critical", "remboursements_categorie", F.lit(category), F.col("montant"), message)


def store_balance(gold: Gold) -> DataFrame:
    """Smallest and largest share of sales of a store that sells."""
    stores = views.store_performance(gold, ordered=False).where(F.col("chiffre_affaires_ttc").isNotNull())
    total = stores.agg(F.sum("chiffre_affaires_ttc").alias("t"))
    shares = stores.select(percent(F.col("chiffre_affaires_ttc"), total.scalar()).alias("part"))
    found = shares.agg(
        F.count(F.lit(1)).alias("n"), F.min("part").alias("bas"), F.max("part").alias("haut")
    ).where(F.col("n") > 0)
    message = F.concat(
        F.lit("Équilibre des Magasins : "),
        F.col("n").cast("string"),
        F.lit(" magasins, de "),
        F.col("bas").cast("decimal(6,2)").cast("string"),
        F.lit("% à "),
        F.col("haut").cast("decimal(6,2)").cast("string"),
        F.lit("% du volume national"),
    )
    return _entry(found, "info", "equilibre_magasins", F.col("n"), F.col("haut"), message)


def leading_store(gold: Gold) -> DataFrame:
    top = highest(views.store_performance(gold, ordered=False), "chiffre_affaires_ttc", "magasin_nk")
    message = F.concat(
        F.lit("Leader Régional : "),
        "magasin_nom",
        F.lit(" ("),
        "ville",
        F.lit("), "),
        _thousands(F.col("chiffre_affaires_ttc")),
        F.lit(" MAD, taux de marge "),
        F.round("taux_marge_pct", 1).cast("decimal(6,1)").cast("string"),
        F.lit("%"),
    )
    return _entry(top, "insight", "magasin_leader", F.col("magasin_nom"), F.col("chiffre_affaires_ttc"), message)


def category_drivers(gold: Gold) -> DataFrame:
    """The category that sells most, its share of sales, and the one with the best margin."""
    figures = dashboard.category_figures(gold).where(F.col("categorie_leader").isNotNull())
    message = F.concat(
        F.lit("Moteur de Revenu & Marge : "),
        "categorie_leader",
        F.lit(" "),
        _thousands(F.col("ca_leader")),
        F.lit(" MAD ("),
        F.round("part_leader_pct", 1).cast("decimal(6,1)").cast("string"),
        F.lit("% du CA), meilleure marge "),
        "categorie_meilleure_marge",
        F.lit(" "),
        F.round("meilleure_marge_pct", 1).cast("decimal(6,1)").cast("string"),
        F.lit("%"),
    )
    return _entry(
        figures, "insight", "categorie_leader", F.col("categorie_leader"), F.col("ca_leader"), message
    )


def main_return_reason(gold: Gold) -> DataFrame:
    top = highest(dashboard.returns_by_reason(gold, ordered=False), "total_retours", "motif")
    message = F.concat(
        F.lit("Qualité & SAV : « "), "motif", F.lit(" » avec "), _thousands(F.col("total_retours")), F.lit(" retours")
    )
    return _entry(top, "insight", "motif_principal", F.col("motif"), F.col("total_retours"), message)


def alerts(gold: Gold, category: str, lead_days: int = LONG_LEAD_TIME_DAYS) -> DataFrame:
    """Each alert is computed in turn when this is called: they read different facts, whose shuffles need not lie on disk together."""
    return in_turn([long_lead_times(gold, lead_days), category_refunds(gold, category), store_balance(gold)])


def insights(gold: Gold) -> DataFrame:
    return reduce(DataFrame.unionByName, [leading_store(gold), category_drivers(gold), main_return_reason(gold)])
