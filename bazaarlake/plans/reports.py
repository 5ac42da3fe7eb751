"""Page tables: the dashboard's projections under their business column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.plans import dashboard, views
from bazaarlake.plans.views import Gold

# --- Fixed values: report columns, in display order ------------------------------------

STORE_REPORT = {
    "magasin_nom": "Magasin",
    "ville": "Ville",
    "region": "Région",
    "surface_m2": "Surface (m²)",
    "total_transactions": "Transactions",
    "chiffre_affaires_ttc": "CA TTC (MAD)",
    "marge_brute_totale": "Marge Brute (MAD)",
    "taux_marge_pct": "Taux Marge (%)",
    "panier_moyen_ttc": "Panier Moyen (MAD)",
    "ca_par_m2": "CA / m² (MAD)",
    "taux_retour_pct": "Taux Retour (%)",
}
MONTH_REPORT = {
    "mois_nom": "Mois",
    "total_transactions": "Transactions",
    "articles_vendus": "Articles Vendus",
    "chiffre_affaires_ht": "CA HT (MAD)",
    "chiffre_affaires_ttc": "CA TTC (MAD)",
    "marge_brute_totale": "Marge Brute (MAD)",
    "taux_marge": "Marge (%)",
    "panier_moyen": "Panier Moyen (MAD)",
}
PRODUCT_REPORT = {
    "produit_nom": "Produit",
    "categorie": "Catégorie",
    "sous_categorie": "Sous-Catégorie",
    "fournisseur_nom": "Fournisseur",
    "prix_vente_ttc": "Prix TTC (MAD)",
    "marge_unitaire": "Marge Unit (MAD)",
    "total_quantite_vendue": "Quantité Vendue",
    "chiffre_affaires_ttc": "CA TTC (MAD)",
    "marge_brute_totale": "Marge Totale (MAD)",
    "taux_marge_pct": "Marge (%)",
}
CUSTOMER_REPORT = {
    "nom": "Nom",
    "prenom": "Prénom",
    "client_ville": "Ville",
    "segment": "Segment",
    "nb_achats": "Nb Achats",
    "total_articles_achetes": "Articles Achetés",
    "depense_totale_ttc": "Dépense Totale (MAD)",
    "panier_moyen": "Panier Moyen (MAD)",
    "marge_totale_generee": "Marge Générée (MAD)",
}
STOCK_REPORT = {
    "produit_nom": "Produit",
    "categorie": "Catégorie",
    "magasin_nom": "Magasin",
    "fournisseur_nom": "Fournisseur",
    "stock_moyen": "Stock Moyen (Unités)",
    "valeur_stock_moyenne_ht": "Valeur Stock (MAD)",
    "delai_livraison_jours": "Délai (Jours)",
    "nb_occurrences_rupture": "Ruptures",
}
RETURN_REPORT = {
    "magasin_nom": "Magasin",
    "categorie_produit": "Rayon",
    "motif": "Motif de Réclamation",
    "total_retours": "Nombre Retours",
    "total_quantite_retournee": "Quantité",
    "total_montant_rembourse": "Montant Remboursé (MAD)",
}


def titled(df: DataFrame, titles: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(title) for c, title in titles.items()])


def store_report(gold: Gold) -> DataFrame:
    return titled(dashboard.store_ranking(gold), STORE_REPORT)


def month_report(gold: Gold, year: int | None = None, store: str | None = None) -> DataFrame:
    return titled(dashboard.month_synthesis(gold, year, store), MONTH_REPORT)


def product_report(gold: Gold, rows: int = 20) -> DataFrame:
    return titled(dashboard.top_products(gold, rows), PRODUCT_REPORT)


def customer_report(gold: Gold, rows: int = 20) -> DataFrame:
    return titled(dashboard.top_customers(gold, rows), CUSTOMER_REPORT)


def stock_report(gold: Gold, store: str | None = None, rows: int = 25) -> DataFrame:
    """The first rows of the stock view: most stock-outs first."""
    view = dashboard.only_store(views.stock_management(gold, ordered=False), store)
    first = view.orderBy(F.desc("nb_occurrences_rupture"), "produit_sk", "magasin_nom", "magasin_ville")
    return titled(first.limit(rows), STOCK_REPORT)


def return_report(gold: Gold, store: str | None = None) -> DataFrame:
    return titled(dashboard.only_store(views.returns_analysis(gold), store), RETURN_REPORT)
