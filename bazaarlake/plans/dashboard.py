"""The dashboard's queries: filtered KPIs, roll-ups, rankings and page figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions.amounts import percent, quotient, ratio, vat_amount, vat_share
from bazaarlake.functions.text import month_label, quarter_label, without
from bazaarlake.operators.joins import matched_rows
from bazaarlake.operators.ranking import ascending, at_highest, at_lowest, descending, highest, top_n
from bazaarlake.plans import views
from bazaarlake.plans.views import Gold
from bazaarlake.sources.tables import stored

# --- filters -------------------------------------------------------------------------


def chosen(value: str | None, everything: str) -> str | None:
    """The filter value, or None when nothing or the "all" entry is chosen."""
    return None if not value or value == everything else value


def only_store(view: DataFrame, store: str | None, column: str = "magasin_nom") -> DataFrame:
    name = chosen(store, contract.ALL_STORES)
    return view if name is None else view.where(F.col(column) == F.lit(name))


# --- queries ---------------------------------------------------------------------------


def available_years(gold: Gold) -> DataFrame:
    """Years with sales, latest first; the default year when there are none."""
    used = gold["fait_ventes"].select(F.col("date_sk").alias("temps_sk")).distinct()
    years = gold["dim_temps"].join(used, "temps_sk", "left_semi").select("annee").distinct()
    found = years.agg(F.sort_array(F.collect_set("annee"), asc=False).alias("y"))
    default = F.array(F.lit(contract.DEFAULT_YEAR))
    listed = found.select(F.explode(F.when(F.size("y") > 0, F.col("y")).otherwise(default)).alias("annee"))
    return listed.orderBy(F.desc("annee"))


def kpis(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    """Company figures, or those of one year and/or store, from the monthly view."""
    if year is None and store is None:
        return views.kpi_overview(gold)
    name = chosen(store, contract.ALL_STORES)
    months = views.monthly_sales(gold, year or None, name, ordered=False)
    totals = months.agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("articles_vendus").alias("total_articles_vendus"),
        F.round(F.sum("chiffre_affaires_ttc"), 2).alias("chiffre_affaires_ttc"),
        F.round(F.sum("chiffre_affaires_ht"), 2).alias("chiffre_affaires_ht"),
        F.round(F.sum("marge_brute_totale"), 2).alias("marge_brute_totale"),
        F.count_distinct("magasin_sk").alias("total_magasins"),
    )
    return totals.select(
        "total_transactions",
        "total_articles_vendus",
        "chiffre_affaires_ttc",
        "chiffre_affaires_ht",
        "marge_brute_totale",
        percent(F.col("marge_brute_totale"), F.col("chiffre_affaires_ht")).alias("taux_marge_pct"),
        ratio(F.col("chiffre_affaires_ttc"), F.col("total_transactions")).alias("panier_moyen_ttc"),
        "total_magasins",
        active_customers(gold, year or None, name).scalar().alias("clients_actifs"),
    )


def active_customers(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    """Customers with a sale in the year and store: one row, counted from the fact."""
    sales = gold["fait_ventes"]
    if year is not None:
        sales = sales.where(F.col("date_sk").between(year * 10000 + 101, year * 10000 + 1231))
        if "annee_mois" in sales.columns:  # prunes the partitions of the written table
            sales = sales.where(F.col("annee_mois").between(year * 100 + 1, year * 100 + 12))
    if store is not None:
        shops = gold["dim_magasin"].where(F.col("nom") == store)
        sales = matched_rows(sales, "magasin_sk", shops, "magasin_sk")
    return sales.agg(F.count_distinct("client_sk").alias("clients_actifs"))


def monthly(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    months = views.monthly_sales(gold, year or None, chosen(store, contract.ALL_STORES), ordered=False)
    return months.orderBy("annee", "mois_num", "magasin_nom")


def store_ranking(gold: Gold) -> DataFrame:
    return views.store_performance(gold)


def store_ranking_ascending(gold: Gold) -> DataFrame:
    return ascending(views.store_performance(gold, ordered=False), "chiffre_affaires_ttc", "magasin_nk")


def top_products(gold: Gold, limit: int = 50, category: str | None = None) -> DataFrame:
    name = chosen(category, contract.ALL_CATEGORIES)
    products = views.product_performance(gold, name, ordered=False)
    return top_n(products, "chiffre_affaires_ttc", limit, "produit_nk")


def categories(gold: Gold, ordered: bool = True) -> DataFrame:
    """Category roll-up; the margin rate is on gross sales without the flat tax."""
    grouped = views.product_performance(gold, ordered=False).groupBy("categorie").agg(
        F.count_distinct("produit_sk").alias("nb_references"),
        F.sum("total_quantite_vendue").alias("quantite_vendue"),
        F.sum("chiffre_affaires_ttc").alias("ca_ttc"),
        F.sum("marge_brute_totale").alias("marge_totale"),
    )
    # marge / (ttc / 1.20), with the constant moved to the numerator.
    divisor = F.lit(contract.NET_FROM_GROSS_DIVISOR).cast("decimal(3,2)")
    view = grouped.withColumn("marge_pct", percent(F.col("marge_totale") * divisor, F.col("ca_ttc")))
    return descending(view, "ca_ttc", "categorie") if ordered else view


def segments(gold: Gold, ordered: bool = True) -> DataFrame:
    """Segment roll-up; the basket is the plain mean of the customers' baskets."""
    grouped = views.customer_behaviour(gold, ordered=False).groupBy("segment").agg(
        F.count("client_sk").alias("nb_clients"),
        F.sum("nb_achats").alias("total_achats"),
        F.sum("depense_totale_ttc").alias("ca_total_ttc"),
        F.sum("panier_moyen").alias("_baskets"),
        F.count("panier_moyen").alias("_buyers"),
        F.sum("marge_totale_generee").alias("marge_totale"),
    )
    view = grouped.select(
        "segment",
        "nb_clients",
        "total_achats",
        "ca_total_ttc",
        ratio(F.col("_baskets"), F.col("_buyers")).alias("panier_moyen_segment"),
        "marge_totale",
    )
    return descending(view, "ca_total_ttc", "segment") if ordered else view


def cities(gold: Gold) -> DataFrame:
    grouped = views.customer_behaviour(gold, ordered=False).groupBy("client_ville").agg(
        F.count("client_sk").alias("nb_clients"),
        F.sum("depense_totale_ttc").alias("ca_total_ttc"),
        F.sum("panier_moyen").alias("_baskets"),
        F.count("panier_moyen").alias("_buyers"),
    )
    view = grouped.select(
        F.col("client_ville").alias("ville"),
        "nb_clients",
        "ca_total_ttc",
        ratio(F.col("_baskets"), F.col("_buyers")).alias("panier_moyen_ville"),
    )
    return descending(view, "ca_total_ttc", "ville")


def top_customers(gold: Gold, limit: int = 20) -> DataFrame:
    return top_n(views.customer_behaviour(gold, ordered=False), "depense_totale_ttc", limit, "client_nk")


def stock(gold: Gold) -> DataFrame:
    return views.stock_management(gold)


def returns(gold: Gold) -> DataFrame:
    return views.returns_analysis(gold)


# --- page: overview and sales ---------------------------------------------------------------


def network_trend(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    """All stores together, per month, with the label "month year"."""
    months = views.monthly_sales(gold, year or None, chosen(store, contract.ALL_STORES), ordered=False)
    trend = months.groupBy("annee", "mois_num", "mois_nom").agg(
        F.sum("chiffre_affaires_ttc").alias("chiffre_affaires_ttc"),
        F.sum("marge_brute_totale").alias("marge_brute_totale"),
        F.sum("total_transactions").alias("total_transactions"),
    )
    labelled = trend.withColumn("mois_affichage", month_label(F.col("mois_nom"), F.col("annee")))
    return labelled.orderBy("annee", "mois_num")


def quarters(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    months = views.monthly_sales(gold, year or None, chosen(store, contract.ALL_STORES), ordered=False)
    grouped = months.groupBy("trimestre").agg(
        F.sum("chiffre_affaires_ttc").alias("chiffre_affaires_ttc"),
        F.sum("marge_brute_totale").alias("marge_brute_totale"),
        F.sum("total_transactions").alias("total_transactions"),
    )
    return grouped.withColumn("trimestre_label", quarter_label(F.col("trimestre"))).orderBy("trimestre")


def monthly_basket(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    """Average basket per month of the year; several years share a month without a year filter."""
    months = views.monthly_sales(gold, year or None, chosen(store, contract.ALL_STORES), ordered=False)
    grouped = months.groupBy("mois_num", "mois_nom").agg(
        F.sum("chiffre_affaires_ttc").alias("chiffre_affaires_ttc"),
        F.sum("total_transactions").alias("total_transactions"),
    )
    basket = quotient(F.col("chiffre_affaires_ttc"), F.col("total_transactions"))
    return grouped.withColumn("panier_moyen", basket).orderBy("mois_num")


def month_synthesis(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    months = views.monthly_sales(gold, year or None, chosen(store, contract.ALL_STORES), ordered=False)
    summed = ["total_transactions", "articles_vendus", "chiffre_affaires_ht", "chiffre_affaires_ttc"]
    grouped = months.groupBy("annee", "mois_num", "mois_nom").agg(
        *[F.sum(c).alias(c) for c in (*summed, "marge_brute_totale")]
    )
    margin = quotient(F.col("marge_brute_totale"), F.col("chiffre_affaires_ht")) * 100.0
    return grouped.select(
        "*",
        margin.alias("taux_marge"),
        quotient(F.col("chiffre_affaires_ttc"), F.col("total_transactions")).alias("panier_moyen"),
    ).orderBy("annee", "mois_num")


def tax_figures(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    """Net, tax, gross and the tax share of the filtered KPIs."""
    gross, net = F.col("chiffre_affaires_ttc"), F.col("chiffre_affaires_ht")
    return kpis(gold, year, store).select(
        "chiffre_affaires_ht",
        vat_amount(gross, net).alias("montant_tva"),
        vat_share(gross, net).alias("part_tva_pct"),
        "chiffre_affaires_ttc",
        "total_articles_vendus",
        "total_transactions",
    )


# --- page: stores ---------------------------------------------------------------------------------


def store_benchmark(gold: Gold, prefix: str = "") -> DataFrame:
    """Leading store, mean sales and surface per store, best margin, lowest return rate: one row."""
    stores = views.store_performance(gold, ordered=False)
    name = without(F.col("magasin_nom"), prefix) if prefix else F.col("magasin_nom")
    return stores.agg(
        quotient(F.sum("ca_par_m2"), F.count("ca_par_m2")).alias("ca_par_m2_moyen"),
        quotient(F.sum("surface_m2"), F.count("surface_m2")).alias("surface_moyenne_m2"),
        at_highest(name, "chiffre_affaires_ttc", "magasin_nk").alias("magasin_leader"),
        F.max("chiffre_affaires_ttc").alias("ca_leader"),
        at_highest(name, "taux_marge_pct", "magasin_nk").alias("magasin_meilleure_marge"),
        F.max("taux_marge_pct").alias("meilleur_taux_marge_pct"),
        at_lowest(name, "taux_retour_pct", "magasin_nk").alias("magasin_moins_de_retours"),
        F.min("taux_retour_pct").alias("plus_faible_taux_retour_pct"),
    )


# --- page: products ----------------------------------------------------------------------------------


def category_shares(gold: Gold) -> DataFrame:
    """Categories with their share of sales."""
    rows = categories(gold, ordered=False)
    total = rows.agg(F.sum("ca_ttc").alias("t"))
    shares = rows.withColumn("part_ca_pct", percent(F.col("ca_ttc"), total.scalar()))
    return descending(shares, "ca_ttc", "categorie")


def category_figures(gold: Gold) -> DataFrame:
    """Catalogue totals with the leading category by sales and by margin rate: one row."""
    rows = categories(gold, ordered=False)
    totals = rows.agg(
        F.sum("nb_references").alias("total_references"),
        F.sum("ca_ttc").alias("total_ca_ttc"),
        F.sum("quantite_vendue").alias("total_quantite"),
        at_highest("categorie", "ca_ttc", "categorie").alias("categorie_leader"),
        F.max("ca_ttc").alias("ca_leader"),
        at_highest("categorie", "marge_pct", "categorie").alias("categorie_meilleure_marge"),
        F.max("marge_pct").alias("meilleure_marge_pct"),
    )
    share = percent(F.col("ca_leader"), F.col("total_ca_ttc")).alias("part_leader_pct")
    return totals.select(
        "total_references", "total_ca_ttc", "total_quantite", "categorie_leader", "ca_leader", share,
        "categorie_meilleure_marge", "meilleure_marge_pct",
    )


# --- page: customers ------------------------------------------------------------------------------------


def customer_figures(gold: Gold) -> DataFrame:
    """Customer base, leading segment and its share, mean basket, purchases per customer: one row."""
    rows = segments(gold, ordered=False)
    totals = rows.agg(
        F.sum("nb_clients").alias("total_clients"),
        F.sum("ca_total_ttc").alias("total_ca_ttc"),
        F.sum("total_achats").alias("total_achats"),
        quotient(F.sum("panier_moyen_segment"), F.count("panier_moyen_segment")).alias("panier_moyen_global"),
        at_highest("segment", "ca_total_ttc", "segment").alias("segment_leader"),
        F.max("ca_total_ttc").alias("ca_leader"),
    )
    return totals.select(
        "total_clients",
        "total_ca_ttc",
        "panier_moyen_global",
        ratio(F.col("total_achats"), F.col("total_clients"), 0).alias("achats_par_client"),
        "segment_leader",
        "ca_leader",
        percent(F.col("ca_leader"), F.col("total_ca_ttc")).alias("part_leader_pct"),
    )


# --- page: inventory --------------------------------------------------------------------------------------


def inventory_figures(gold: Gold, store: str | None = None) -> DataFrame:
    """Stock value and stock-outs of the store; suppliers and lead time of the whole network: one row."""
    rows = views.stock_management(gold, ordered=False)
    name = chosen(store, contract.ALL_STORES)
    shown = F.lit(True) if name is None else F.col("magasin_nom") == name
    return rows.agg(
        F.sum(F.when(shown, F.col("valeur_stock_moyenne_ht"))).alias("valeur_stock_ht"),
        F.count_distinct("fournisseur_nom").alias("nb_fournisseurs"),
        quotient(F.sum("delai_livraison_jours"), F.count("delai_livraison_jours")).alias("delai_moyen"),
        F.sum(F.when(shown, F.col("nb_occurrences_rupture"))).alias("total_ruptures"),
    )


def stock_by_category(gold: Gold, store: str | None = None) -> DataFrame:
    rows = only_store(views.stock_management(gold, ordered=False), store)
    grouped = rows.groupBy("categorie").agg(F.sum("valeur_stock_moyenne_ht").alias("valeur_stock_moyenne_ht"))
    return descending(grouped, "valeur_stock_moyenne_ht", "categorie")


def lead_time_by_supplier(gold: Gold) -> DataFrame:
    """Mean lead time over the stock lines of each supplier; lines without a supplier drop out."""
    rows = views.stock_management(gold, ordered=False).where(F.col("fournisseur_nom").isNotNull())
    grouped = rows.groupBy("fournisseur_nom").agg(
        quotient(F.sum("delai_livraison_jours"), F.count("delai_livraison_jours")).alias("delai_livraison_jours")
    )
    return ascending(grouped, "delai_livraison_jours", "fournisseur_nom")


# --- page: returns --------------------------------------------------------------------------------------------


def return_figures(gold: Gold, store: str | None = None) -> DataFrame:
    """Totals, main reason and the return rate over the sale lines: one row. The view of returns, one row for each reason, category and
    store, and the number of sale lines are computed in turn when this is called."""
    rows = stored(only_store(views.returns_analysis(gold, ordered=False), store))
    main = highest(_by_reason(rows), "total_retours", "motif")
    name = chosen(store, contract.ALL_STORES)
    sales = gold["fait_ventes"]
    if name is not None:
        sales = matched_rows(sales, "magasin_sk", gold["dim_magasin"].where(F.col("nom") == name), "magasin_sk")
    lines = stored(sales.agg(F.count(F.lit(1)).alias("n")))
    totals = rows.agg(
        F.sum("total_retours").alias("total_retours"),
        F.sum("total_montant_rembourse").alias("total_rembourse"),
        F.sum("total_quantite_retournee").alias("total_quantite"),
    )
    return totals.select(
        "*",
        main.select("motif").scalar().alias("motif_principal"),
        percent(F.col("total_retours"), lines.scalar()).alias("taux_retour_pct"),
    )


def _by_reason(rows: DataFrame) -> DataFrame:
    return rows.groupBy("motif").agg(F.sum("total_retours").alias("total_retours"))


def returns_by_reason(gold: Gold, store: str | None = None, ordered: bool = True) -> DataFrame:
    grouped = _by_reason(only_store(views.returns_analysis(gold, ordered=False), store))
    return descending(grouped, "total_retours", "motif") if ordered else grouped


def refunds_by_category(gold: Gold, store: str | None = None) -> DataFrame:
    rows = only_store(views.returns_analysis(gold, ordered=False), store)
    grouped = rows.groupBy("categorie_produit").agg(
        F.sum("total_montant_rembourse").alias("total_montant_rembourse")
    )
    return descending(grouped, "total_montant_rembourse", "categorie_produit")
