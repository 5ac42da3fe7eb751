"""The data contract: table layouts, keys, references and the fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    length: int | None = None
    required: bool = True

    @property
    def spark_type(self) -> T.DataType:
        return {
            "text": T.StringType(),
            "int": T.IntegerType(),
            "money": T.DecimalType(12, 2),
            "percent": T.DecimalType(5, 2),
            "date": T.DateType(),
            "timestamp": T.TimestampType(),
            "flag": T.BooleanType(),
        }[self.kind]


@dataclass(frozen=True)
class Reference:
    """A foreign key. ``optional`` lets a NULL key pass."""

    column: str
    parent: str
    parent_key: str
    reason: str
    optional: bool = False


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    references: tuple[Reference, ...] = field(default=())
    landing_only: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def landing_names(self) -> list[str]:
        return self.names + list(self.landing_only)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


def text(name: str, length: int, required: bool = True) -> Column:
    return Column(name, "text", length, required)


def typed(kind: str, *names: str) -> tuple[Column, ...]:
    return tuple(Column(n, kind) for n in names)


# --- Fixed values: table layouts -------------------------------------------------

STORES = Table(
    "dim_magasin",
    (
        text("magasin_nk", 50),
        text("nom", 100),
        text("ville", 100),
        text("region", 100),
        text("type", 50),
        *typed("int", "surface_m2"),
    ),
    key=("magasin_nk",),
)

SUPPLIERS = Table(
    "dim_fournisseur",
    (
        text("fournisseur_nk", 50),
        text("nom", 150),
        text("categorie_principale", 100),
        text("pays", 100),
        *typed("int", "delai_livraison_jours"),
    ),
    key=("fournisseur_nk",),
)

PRODUCTS = Table(
    "dim_produit",
    (
        text("produit_nk", 50),
        text("nom", 150),
        text("categorie", 100),
        text("sous_categorie", 100),
        text("fournisseur_nk", 50),
        *typed("money", "prix_achat_ht", "prix_vente_ht"),
        *typed("percent", "tva_pct"),
        *typed("money", "prix_vente_ttc", "marge_brute_ht"),
    ),
    key=("produit_nk",),
    references=(
        Reference("fournisseur_nk", "dim_fournisseur", "fournisseur_nk", "fournisseur_nk inexistant"),
    ),
)

CUSTOMERS = Table(
    "dim_client",
    (
        text("client_nk", 50),
        text("prenom", 100),
        text("nom", 100),
        text("email", 200, required=False),
        text("telephone", 50),
        text("ville", 100),
        *typed("date", "date_naissance", "date_inscription"),
        text("segment", 50),
    ),
    key=("client_nk",),
    landing_only=("email_valide",),
)

CALENDAR = Table(
    "dim_temps",
    (
        *typed("int", "temps_sk"),
        *typed("date", "date_complete"),
        *typed("int", "jour", "jour_semaine_num"),
        text("jour_semaine_nom", 50),
        *typed("int", "semaine_annee", "mois_num"),
        text("mois_nom", 50),
        *typed("int", "trimestre", "semestre", "annee"),
        *typed("flag", "est_weekend", "est_ferie", "est_jour_ouvre"),
    ),
    key=("temps_sk",),
)

STOCK = Table(
    "fait_stock",
    (
        *typed("date", "date_snapshot"),
        text("produit_nk", 50),
        text("magasin_nk", 50),
        *typed("int", "quantite_en_stock"),
        *typed("money", "valeur_stock_ht"),
        *typed("int", "seuil_reapprovisionnement"),
        *typed("flag", "en_rupture"),
    ),
    key=("date_snapshot", "produit_nk", "magasin_nk"),
    references=(
        Reference("produit_nk", "dim_produit", "produit_nk", "produit_nk inexistant"),
        Reference("magasin_nk", "dim_magasin", "magasin_nk", "magasin_nk inexistant"),
    ),
)

ORDERS = Table(
    "fait_commandes",
    (
        text("commande_nk", 50),
        text("fournisseur_nk", 50),
        text("magasin_nk", 50),
        *typed("date", "date_commande", "date_livraison_prev"),
        text("statut", 50),
        *typed("money", "montant_total_ht"),
    ),
    key=("commande_nk",),
    references=(
        Reference("fournisseur_nk", "dim_fournisseur", "fournisseur_nk", "fournisseur_nk inexistant"),
        Reference("magasin_nk", "dim_magasin", "magasin_nk", "magasin_nk inexistant"),
    ),
)

ORDER_LINES = Table(
    "fait_lignes_commandes",
    (
        text("commande_nk", 50),
        text("produit_nk", 50),
        *typed("int", "quantite_commandee"),
        *typed("money", "prix_unitaire_achat", "montant_ligne_ht"),
    ),
    key=("commande_nk", "produit_nk"),
    references=(
        Reference("commande_nk", "fait_commandes", "commande_nk", "commande_nk inexistante"),
        Reference("produit_nk", "dim_produit", "produit_nk", "produit_nk inexistant"),
    ),
)

SALES = Table(
    "fait_ventes",
    (
        text("ticket_nk", 100),
        *typed("timestamp", "timestamp_vente"),
        *typed("date", "date_vente"),
        text("magasin_nk", 50),
        text("client_nk", 50, required=False),
        text("produit_nk", 50),
        *typed("int", "quantite"),
        *typed("money", "prix_unitaire_ht"),
        *typed("percent", "tva_pct"),
        *typed("money", "prix_unitaire_ttc", "montant_ht", "montant_ttc"),
        *typed("money", "marge_brute_unit", "marge_brute_total"),
    ),
    key=("ticket_nk", "produit_nk"),
    references=(
        Reference("magasin_nk", "dim_magasin", "magasin_nk", "magasin_nk inexistant"),
        Reference("produit_nk", "dim_produit", "produit_nk", "produit_nk inexistant"),
        Reference("client_nk", "dim_client", "client_nk", "client_nk fantome inexistant", optional=True),
    ),
)

RETURNS = Table(
    "fait_retours",
    (
        text("retour_nk", 50),
        text("ticket_nk", 100),
        text("produit_nk", 50),
        text("magasin_nk", 50),
        text("client_nk", 50, required=False),
        *typed("date", "date_vente_originale", "date_retour"),
        *typed("int", "quantite_retournee"),
        *typed("money", "montant_rembourse"),
        text("motif", 200),
    ),
    key=("retour_nk",),
    references=(
        Reference("produit_nk", "dim_produit", "produit_nk", "produit_nk inexistant"),
        Reference("magasin_nk", "dim_magasin", "magasin_nk", "magasin_nk inexistant"),
        Reference("client_nk", "dim_client", "client_nk", "client_nk fantome inexistant", optional=True),
    ),
)

DIMENSIONS = (STORES, SUPPLIERS, PRODUCTS, CUSTOMERS, CALENDAR)
FACTS = (STOCK, ORDERS, ORDER_LINES, SALES, RETURNS)
TABLES: dict[str, Table] = {t.name: t for t in DIMENSIONS + FACTS}

REJECTS = "rejected_records"
REJECT_COLUMNS = ("table_name", "record_data", "reason")

# --- Fixed values: rules, defaults, labels ----------------------------------------

EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
DEFAULT_VAT_PERCENT = "20.00"
NET_FROM_GROSS_DIVISOR = "1.20"
DEFAULT_MARGIN_RATE = "0.20"

REJECT_REASONS = {
    "dim_magasin": "Champ obligatoire NULL ou surface invalide",
    "dim_fournisseur": "Champ obligatoire NULL ou delai invalide",
    "dim_produit": "Prix invalide ou champ obligatoire NULL",
    "dim_client": "Champ obligatoire NULL ou date invalide",
    "dim_temps": "temps_sk ou date_complete NULL",
    "fait_stock": "Date/Produit/Magasin NULL ou stock negatif",
    "fait_commandes": "Champ obligatoire NULL ou montant negatif",
    "fait_lignes_commandes": "Quantite/Prix invalide ou clé NULL",
    "fait_ventes": "Quantite <= 0 ou montant TTC negatif",
    "fait_retours": "Retour_nk/Produit NULL ou quantite <= 0",
}
CONTRACT_REASON = "Contrat de colonne non respecte"

ALL_STORES = "Tous les magasins"
ALL_CATEGORIES = "Toutes les catégories"
DEFAULT_YEAR = 2024

SEGMENT_PREMIUM, SEGMENT_STANDARD, SEGMENT_DEFAULT = "Premium", "Standard", "Occasionnel"
PREMIUM_MIN_BASKET, PREMIUM_MIN_TICKETS = 500, 48
STANDARD_MIN_BASKET, STANDARD_MIN_TICKETS = 150, 12

LONG_LEAD_TIME_DAYS = 10

MONTH_NAMES = {
    "fr": [
        "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
        "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
    ],
    "en": [
        "January", "February", "March", "April", "May", "June",
        "July", "August", "September", "October", "November", "December",
    ],
}
# Monday first.
DAY_NAMES = {
    "fr": ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"],
    "en": ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"],
}
HOLIDAYS_2024 = [
    "2024-01-01", "2024-01-11", "2024-04-10", "2024-04-11", "2024-05-01", "2024-06-17",
    "2024-07-30", "2024-08-14", "2024-08-20", "2024-08-21", "2024-11-06", "2024-11-18",
]
GOLD_CALENDAR_START, GOLD_CALENDAR_END = "2024-01-01", "2030-12-31"
#: Days beyond these are taken for typing errors when a calendar is fitted to the facts.
EARLIEST_DAY, LATEST_DAY = "1970-01-01", "2069-12-31"
OUTSIDE_CALENDAR = "Jour hors calendrier"
ORDER_IN_QUARANTINE = "Commande en quarantaine"

#: Keys that gold tables carry: column, parent, parent's key, whether it may be NULL.
GOLD_REFERENCES: dict[str, tuple[tuple[str, str, str, bool], ...]] = {
    "dim_produit": (("fournisseur_sk", "dim_fournisseur", "fournisseur_sk", True),),
    "fait_stock": (
        ("date_snapshot_sk", "dim_temps", "temps_sk", False),
        ("produit_sk", "dim_produit", "produit_sk", False),
        ("magasin_sk", "dim_magasin", "magasin_sk", False),
    ),
    "fait_commandes": (
        ("fournisseur_sk", "dim_fournisseur", "fournisseur_sk", False),
        ("magasin_sk", "dim_magasin", "magasin_sk", False),
        ("date_commande_sk", "dim_temps", "temps_sk", False),
        ("date_livraison_prev_sk", "dim_temps", "temps_sk", False),
    ),
    "fait_lignes_commandes": (
        ("commande_sk", "fait_commandes", "commande_sk", False),
        ("produit_sk", "dim_produit", "produit_sk", False),
    ),
    "fait_ventes": (
        ("date_sk", "dim_temps", "temps_sk", False),
        ("magasin_sk", "dim_magasin", "magasin_sk", False),
        ("client_sk", "dim_client", "client_sk", True),
        ("produit_sk", "dim_produit", "produit_sk", False),
    ),
    "fait_retours": (
        ("produit_sk", "dim_produit", "produit_sk", False),
        ("magasin_sk", "dim_magasin", "magasin_sk", False),
        ("client_sk", "dim_client", "client_sk", True),
        ("date_vente_originale_sk", "dim_temps", "temps_sk", False),
        ("date_retour_sk", "dim_temps", "temps_sk", False),
    ),
}

EVENT_SALE, EVENT_RETURN = "VENTE", "RETOUR"
