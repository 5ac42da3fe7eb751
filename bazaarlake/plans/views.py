"""The seven analytic views over gold.

Facts are summed on their own keys before dimension attributes are joined, so the joins
see one row per group, not one per sale line. ``vente_sk`` and ``retour_sk`` are unique
and never NULL, hence counting them is counting rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.amounts import percent, quotient, ratio, zero_if_null
from bazaarlake.operators.distinct import distinct_counts
from bazaarlake.operators.joins import Lookup

Gold = dict[str, DataFrame]


def _sales_measures():
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("quantite").alias("articles"),
        F.sum("montant_ttc").alias("ttc"),
        F.sum("montant_ht").alias("ht"),
        F.sum("marge_brute_total").alias("marge"),
    ]


def _resum(*extra):
    return [F.sum(c).alias(c) for c in ("n", "articles", "ttc", "ht", "marge", *extra)]


def kpi_overview(gold: Gold) -> DataFrame:
    """One row of company-wide figures."""
    sales = gold["fait_ventes"]
    totals = distinct_counts(
        sales,
        {"clients_actifs": "client_sk", "total_magasins": "magasin_sk", "total_produits_vendus": "produit_sk"},
        {
            "n": F.lit(1),
            "articles": F.col("quantite"),
            "ttc": F.col("montant_ttc"),
            "ht": F.col("montant_ht"),
            "marge": F.col("marge_brute_total"),
        },
    ).withColumn("n", F.coalesce("n", F.lit(0)))
    return totals.select(
        F.col("n").alias("total_transactions"),
        F.col("articles").alias("total_articles_vendus"),
        F.round("ttc", 2).alias("chiffre_affaires_ttc"),
        F.round("ht", 2).alias("chiffre_affaires_ht"),
        F.round("marge", 2).alias("marge_brute_totale"),
        percent(F.col("marge"), F.col("ht")).alias("taux_marge_pct"),
        ratio(F.col("ttc"), F.col("n")).alias("panier_moyen_ttc"),
        "clients_actifs",
        "total_magasins",
        "total_produits_vendus",
    )


def monthly_sales(
    gold: Gold, year: int | None = None, store: str | None = None, ordered: bool = True
) -> DataFrame:
    """Sales per month and store. ``year`` becomes a date-key range on the fact scan."""
    sales = gold["fait_ventes"]
    calendar, stores = gold["dim_temps"], gold["dim_magasin"]
    if year is not None:
        sales = sales.where(F.col("date_sk").between(year * 10000 + 101, year * 10000 + 1231))
        if "annee_mois" in sales.columns:
            sales = sales.where(F.col("annee_mois").between(year * 100 + 1, year * 100 + 12))
        calendar = calendar.where(F.col("annee") == year)
    if store is not None:
        stores = stores.where(F.col("nom") == store)
    daily = sales.groupBy("date_sk", "magasin_sk").agg(*_sales_measures())
    days = calendar.select(F.col("temps_sk").alias("date_sk"), "annee", "mois_num", "mois_nom", "trimestre")
    dated = Lookup(days, "date_sk", ["annee", "mois_num", "mois_nom", "trimestre"]).attach(daily)
    shops = stores.select(
        "magasin_sk", F.col("nom").alias("magasin_nom"), F.col("ville").alias("magasin_ville")
    )
    placed = Lookup(shops, "magasin_sk", ["magasin_nom", "magasin_ville"]).attach(dated)
    group = ["annee", "mois_num", "mois_nom", "trimestre", "magasin_sk", "magasin_nom", "magasin_ville"]
    view = placed.groupBy(*group).agg(*_resum()).select(
        *group,
        F.col("n").alias("total_transactions"),
        F.col("articles").alias("articles_vendus"),
        F.round("ttc", 2).alias("chiffre_affaires_ttc"),
        F.round("ht", 2).alias("chiffre_affaires_ht"),
        F.round("marge", 2).alias("marge_brute_totale"),
        ratio(F.col("ttc"), F.col("n")).alias("panier_moyen"),
    )
    return view.orderBy("annee", "mois_num", "magasin_nom") if ordered else view


def store_performance(gold: Gold, ordered: bool = True) -> DataFrame:
    """Every store, also one without sales, with its returns."""
    sold = gold["fait_ventes"].groupBy("magasin_sk").agg(*_sales_measures())
    returned = gold["fait_retours"].groupBy("magasin_sk").agg(
        F.count(F.lit(1)).alias("retours"), F.sum("montant_rembourse").alias("rembourse")
    )
    joined = gold["dim_magasin"].join(sold, "magasin_sk", "left").join(returned, "magasin_sk", "left")
    n, returns = zero_if_null(F.col("n")), zero_if_null(F.col("retours"))
    view = joined.select(
        "magasin_sk",
        "magasin_nk",
        F.col("nom").alias("magasin_nom"),
        "ville",
        "region",
        "surface_m2",
        n.alias("total_transactions"),
        F.col("articles").alias("total_articles_vendus"),
        F.round("ttc", 2).alias("chiffre_affaires_ttc"),
        F.round("ht", 2).alias("chiffre_affaires_ht"),
        F.round("marge", 2).alias("marge_brute_totale"),
        percent(F.col("marge"), F.col("ht")).alias("taux_marge_pct"),
        ratio(F.col("ttc"), n).alias("panier_moyen_ttc"),
        ratio(F.col("ttc"), F.col("surface_m2")).alias("ca_par_m2"),
        returns.alias("total_retours"),
        zero_if_null(F.round("rembourse", 2)).alias("montant_retours_rembourse"),
        percent(returns, n).alias("taux_retour_pct"),
    )
    return view.orderBy(F.desc_nulls_last("chiffre_affaires_ttc"), "magasin_nk") if ordered else view


def product_performance(gold: Gold, category: str | None = None, ordered: bool = True) -> DataFrame:
    """Every product, sold or not. ``category`` narrows the products before the join."""
    products = gold["dim_produit"]
    if category is not None:
        products = products.where(F.col("categorie") == category)
    sold = gold["fait_ventes"].groupBy("produit_sk").agg(*_sales_measures())
    suppliers = gold["dim_fournisseur"].select("fournisseur_sk", F.col("nom").alias("fournisseur_nom"))
    supplied = Lookup(suppliers, "fournisseur_sk", ["fournisseur_nom"]).attach(products, "left")
    view = supplied.join(sold, "produit_sk", "left").select(
        "produit_sk",
        "produit_nk",
        F.col("nom").alias("produit_nom"),
        "categorie",
        "sous_categorie",
        "prix_vente_ttc",
        F.col("marge_brute_ht").alias("marge_unitaire"),
        "fournisseur_nom",
        zero_if_null(F.col("n")).alias("total_transactions"),
        F.col("articles").alias("total_quantite_vendue"),
        F.round("ttc", 2).alias("chiffre_affaires_ttc"),
        F.round("marge", 2).alias("marge_brute_totale"),
        percent(F.col("marge"), F.col("ht")).alias("taux_marge_pct"),
    )
    return view.orderBy(F.desc_nulls_last("chiffre_affaires_ttc"), "produit_nk") if ordered else view


def customer_behaviour(gold: Gold, ordered: bool = True) -> DataFrame:
    """Every customer, with purchases, spend and first and last purchase day."""
    days = gold["dim_temps"].select(F.col("temps_sk").alias("_sk"), "date_complete")
    known = gold["fait_ventes"].where(F.col("client_sk").isNotNull())
    # Date keys sort like days, so the calendar meets one row for each customer.
    bought = known.groupBy("client_sk").agg(
        *_sales_measures(), F.min("date_sk").alias("_premier"), F.max("date_sk").alias("_dernier")
    )
    for end in ("premier", "dernier"):
        named = days.select(F.col("_sk").alias(f"_{end}"), F.col("date_complete").alias(f"date_{end}_achat"))
        bought = Lookup(named, f"_{end}", [f"date_{end}_achat"]).attach(bought, "left")
    n, spent = zero_if_null(F.col("n")), zero_if_null(F.col("ttc"))
    view = gold["dim_client"].join(bought, "client_sk", "left").select(
        "client_sk",
        "client_nk",
        "nom",
        "prenom",
        F.col("ville").alias("client_ville"),
        "segment",
        n.alias("nb_achats"),
        zero_if_null(F.col("articles")).alias("total_articles_achetes"),
        F.round(spent, 2).alias("depense_totale_ttc"),
        ratio(spent, n).alias("panier_moyen"),
        F.round(zero_if_null(F.col("marge")), 2).alias("marge_totale_generee"),
        "date_premier_achat",
        "date_dernier_achat",
    )
    return view.orderBy(F.desc_nulls_last("depense_totale_ttc"), "client_nk") if ordered else view


def stock_management(gold: Gold, ordered: bool = True) -> DataFrame:
    """Average stock, its value and stock-outs per product and store name."""
    held = gold["fait_stock"].groupBy("produit_sk", "magasin_sk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quantite_en_stock").alias("quantite"),
        F.sum("valeur_stock_ht").alias("valeur"),
        F.count_if("en_rupture").alias("ruptures"),
    )
    suppliers = gold["dim_fournisseur"].select(
        "fournisseur_sk", F.col("nom").alias("fournisseur_nom"), "delai_livraison_jours"
    )
    products = Lookup(suppliers, "fournisseur_sk", ["fournisseur_nom", "delai_livraison_jours"]).attach(
        gold["dim_produit"].select(
            "produit_sk", F.col("nom").alias("produit_nom"), "categorie", "sous_categorie", "fournisseur_sk"
        ),
        "left",
    )
    attributes = ["produit_nom", "categorie", "sous_categorie", "fournisseur_nom", "delai_livraison_jours"]
    named = Lookup(products, "produit_sk", attributes).attach(held)
    shops = gold["dim_magasin"].select(
        "magasin_sk", F.col("nom").alias("magasin_nom"), F.col("ville").alias("magasin_ville")
    )
    placed = Lookup(shops, "magasin_sk", ["magasin_nom", "magasin_ville"]).attach(named)
    group = [
        "produit_sk", "produit_nom", "categorie", "sous_categorie",
        "magasin_nom", "magasin_ville", "fournisseur_nom", "delai_livraison_jours",
    ]
    summed = placed.groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in ("n", "quantite", "valeur", "ruptures")]
    )
    view = summed.select(
        *group,
        quotient(F.col("quantite"), F.col("n")).alias("stock_moyen"),
        ratio(F.col("valeur"), F.col("n")).alias("valeur_stock_moyenne_ht"),
        F.col("ruptures").alias("nb_occurrences_rupture"),
        percent(F.col("ruptures"), F.col("n")).alias("taux_rupture_pct"),
    )
    if not ordered:
        return view
    return view.orderBy(F.desc("nb_occurrences_rupture"), "produit_sk", "magasin_nom", "magasin_ville")


def returns_analysis(gold: Gold, ordered: bool = True) -> DataFrame:
    """Returns per reason, product category and store name."""
    returned = gold["fait_retours"].groupBy("motif", "produit_sk", "magasin_sk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quantite_retournee").alias("quantite"),
        F.sum("montant_rembourse").alias("rembourse"),
    )
    products = gold["dim_produit"].select("produit_sk", F.col("categorie").alias("categorie_produit"))
    named = Lookup(products, "produit_sk", ["categorie_produit"]).attach(returned)
    shops = gold["dim_magasin"].select(
        "magasin_sk", F.col("nom").alias("magasin_nom"), F.col("ville").alias("magasin_ville")
    )
    placed = Lookup(shops, "magasin_sk", ["magasin_nom", "magasin_ville"]).attach(named)
    group = ["motif", "categorie_produit", "magasin_nom", "magasin_ville"]
    view = placed.groupBy(*group).agg(
        F.sum("n").alias("total_retours"),
        F.sum("quantite").alias("total_quantite_retournee"),
        F.round(F.sum("rembourse"), 2).alias("total_montant_rembourse"),
    )
    return view.orderBy(F.desc("total_retours"), *group) if ordered else view


# The published view names.
VIEWS: dict[str, Callable[[Gold], DataFrame]] = {
    "vue_kpis_globaux": kpi_overview,
    "vue_ventes_mensuelles": monthly_sales,
    "vue_performance_magasins": store_performance,
    "vue_performance_produits": product_performance,
    "vue_segmentation_clients": customer_behaviour,
    "vue_gestion_stocks": stock_management,
    "vue_analyse_retours": returns_analysis,
}
