"""More faults in the landing layer: every table has rows that its rules reject, and references without a parent.

A fault is (key column, modulus, remainder, column, value): rows whose key leaves the remainder get the value, NULL or text. The same list
drives the landing frames and the SQL counterparts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.operators.references import Link
from bazaarlake.plans.gold import SURROGATE
from bazaarlake.sources.tables import in_turn
from checks.landing import LazyTables, Retailer

FAULTS: dict[str, list[tuple[str, int, int, str, str | None]]] = {
    "dim_magasin": [("magasin_nk", 11, 4, "surface_m2", "0"), ("magasin_nk", 11, 6, "ville", None)],
    "dim_fournisseur": [("fournisseur_nk", 50, 37, "delai_livraison_jours", "-1"), ("fournisseur_nk", 50, 38, "pays", None)],
    "dim_produit": [
        ("produit_nk", 40, 3, "prix_achat_ht", "-1"), ("produit_nk", 40, 7, "fournisseur_nk", "F-GHOST"), ("produit_nk", 40, 11, "nom", None),
    ],
    "dim_client": [("client_nk", 30, 4, "date_naissance", None), ("client_nk", 30, 9, "segment", None)],
    "dim_temps": [("temps_sk", 100, 13, "date_complete", None)],
    "fait_stock": [("produit_nk", 29, 5, "quantite_en_stock", "-4"), ("produit_nk", 29, 6, "produit_nk", "P-GHOST")],
    "fait_commandes": [
        ("commande_nk", 25, 3, "montant_total_ht", "-1"), ("commande_nk", 25, 9, "fournisseur_nk", "F-GHOST"),
        ("commande_nk", 25, 14, "date_commande", None), ("commande_nk", 25, 20, "magasin_nk", None),
    ],
    "fait_lignes_commandes": [
        ("commande_nk", 31, 5, "quantite_commandee", "0"), ("commande_nk", 31, 6, "commande_nk", "C-GHOST"),
        ("commande_nk", 31, 7, "prix_unitaire_achat", "-2"),
    ],
    "fait_ventes": [],
    "fait_retours": [
        ("ticket_nk", 27, 4, "quantite_retournee", "0"), ("ticket_nk", 27, 5, "produit_nk", "P-GHOST"), ("ticket_nk", 27, 6, "motif", None),
    ],
}
# The landed rows of each table in SQL, and its rules there: condition and id, in the order of the checks.
LANDED = {
    "dim_magasin": "store",
    "dim_fournisseur": "vendor",
    "dim_produit": "item",
    "dim_client": "buyer",
    "dim_temps": "cal_fr",
    "fait_stock": "silver_stock",
    "fait_commandes": "silver_orders",
    "fait_lignes_commandes": "landed_lines",
    "fait_ventes": "landed_sales",
    "fait_retours": "landed_returns",
}


def _orphan(column: str, parent: str) -> tuple[str, str]:
    key = contract.TABLES[parent].key[0]
    return f"{column} is not null and {column} not in (select {key} from j_{parent} where rule_id is null)", f"{column}_orphan"


RULES: dict[str, list[tuple[str, str]]] = {
    "dim_magasin": [("ville is null", "ville_null"), ("surface_m2 <= 0", "surface_not_positive")],
    "dim_fournisseur": [("pays is null", "pays_null"), ("delai_livraison_jours < 0", "delai_negative")],
    "dim_produit": [
        ("nom is null", "nom_null"), ("prix_achat_ht < 0", "prix_achat_ht_negative"), _orphan("fournisseur_nk", "dim_fournisseur"),
    ],
    "dim_client": [("date_naissance is null", "date_naissance_null"), ("segment is null", "segment_null")],
    "dim_temps": [("date_complete is null", "date_complete_null")],
    "fait_stock": [
        ("quantite_en_stock < 0", "quantite_negative"), _orphan("produit_nk", "dim_produit"), _orphan("magasin_nk", "dim_magasin"),
    ],
    "fait_commandes": [
        ("magasin_nk is null", "magasin_nk_null"), ("date_commande is null", "date_commande_null"),
        ("montant_total_ht < 0", "montant_negative"), _orphan("fournisseur_nk", "dim_fournisseur"), _orphan("magasin_nk", "dim_magasin"),
    ],
    "fait_lignes_commandes": [
        ("quantite_commandee <= 0", "quantite_not_positive"), ("prix_unitaire_achat < 0", "prix_negative"),
        _orphan("commande_nk", "fait_commandes"), _orphan("produit_nk", "dim_produit"),
    ],
    "fait_ventes": [
        ("timestamp_vente is null", "timestamp_vente_null"), ("quantite <= 0", "quantite_not_positive"),
        ("montant_ttc < 0", "montant_ttc_negative"), _orphan("magasin_nk", "dim_magasin"), _orphan("produit_nk", "dim_produit"),
        _orphan("client_nk", "dim_client"),
    ],
    "fait_retours": [
        ("quantite_retournee <= 0", "quantite_not_positive"), _orphan("produit_nk", "dim_produit"), _orphan("magasin_nk", "dim_magasin"),
        _orphan("client_nk", "dim_client"), ("motif is null", "motif_null"),
    ],
}


class FaultyRetailer(Retailer):
    """The retailer with the faults in its landing layer."""

    def __init__(self, r: Retailer):
        super().__init__(r.spark, r.folder)
        self.bronze = LazyTables({n: (lambda n=n: faulty(getattr(self, f"_land_{n}")(), n)) for n in contract.TABLES})


def faulty(landed: DataFrame, table: str) -> DataFrame:
    changes: dict[str, F.Column] = {}
    for key, modulus, remainder, column, value in FAULTS[table]:
        hit = F.expr(f"try_cast({key} AS bigint) % {modulus} = {remainder}")
        changes[column] = F.when(hit, F.lit(value)).otherwise(changes.get(column, F.col(column)))
    return landed.withColumns(changes) if changes else landed


def faulty_sql(table: str) -> str:
    parts = [
        f"case when try_cast({key} as bigint) % {modulus} = {remainder} then {'null' if value is None else repr(value)} else {column} end as {column}"
        for key, modulus, remainder, column, value in FAULTS[table]
    ]
    return f"select * {f'replace ({', '.join(parts)})' if parts else ''} from {LANDED[table]}"


def _cases(table: str) -> str:
    return " ".join(f"when {condition} then '{rule}'" for condition, rule in RULES[table])


def judged_ctes() -> str:
    """One ``j_<table>`` for each table: its faulty rows with the id of the first broken rule. Parents come first."""
    order = ("dim_magasin", "dim_fournisseur", "dim_produit", "dim_client", "dim_temps", "fait_stock", "fait_commandes",
             "fait_lignes_commandes", "fait_ventes", "fait_retours")
    return ", ".join(f"j_{t} as (select *, case {_cases(t)} end rule_id from ({faulty_sql(t)}) f)" for t in order)


def rejects_sql() -> str:
    parts = [f"select '{t}' table_name, coalesce(rule_id, 'accepte') rule_id, count(*) nb_lignes from j_{t} group by all" for t in LANDED]
    return f"with {judged_ctes()} " + " union all ".join(parts)


def verdicts(r: Retailer) -> DataFrame:
    """Rows of every table by the rule that rejects them, or ``accepte``."""
    shop = FaultyRetailer(r)

    def counts(table: str) -> DataFrame:
        assessed = shop.cleaned[table].assessed
        row = assessed.frame.groupBy(F.coalesce(assessed.rule_id, F.lit("accepte")).alias("rule_id")).agg(F.count(F.lit(1)).alias("nb_lignes"))
        return row.select(F.lit(table).alias("table_name"), "*")

    return in_turn(counts(table) for table in contract.TABLES)


# --- all declared references --------------------------------------------------------------------------------

SILVER_LINKS = [
    Link(f"silver.{t.name}", ref.column, f"silver.{ref.parent}", ref.parent_key, ref.optional) for t in contract.FACTS for ref in t.references
]
GOLD_LINKS = [
    Link(f"gold.{table}", column, f"gold.{parent}", key, optional)
    for table, refs in contract.GOLD_REFERENCES.items() for column, parent, key, optional in refs
]
# Gold days of other years have no parent in the calendar of the audit.
AUDIT_YEARS = (1996, 2000)


def linked_tables(r: Retailer) -> LazyTables:
    """Landed rows with faults as silver's, and gold with a calendar of fewer years than the facts have."""
    shop = FaultyRetailer(r)
    frames = {f"silver.{t}": (lambda t=t: shop.bronze[t]) for t in contract.TABLES}
    frames |= {f"gold.{t}": (lambda t=t: r.gold[t]) for t in SURROGATE}
    frames["gold.dim_temps"] = lambda: r.gold["dim_temps"].where(F.col("annee").between(*AUDIT_YEARS))
    return LazyTables(frames)


def links_sql() -> str:
    day = "year({0}) * 10000 + month({0}) * 100 + day({0})"
    gold = {
        "dim_produit": "item", "dim_fournisseur": "vendor", "dim_magasin": "store", "dim_client": "buyer",
        "dim_temps": f"(select * from cal where annee between {AUDIT_YEARS[0]} and {AUDIT_YEARS[1]})", "fait_commandes": "gold_orders",
        "fait_stock": "gold_stock", "fait_ventes": "gold_sales", "fait_retours": "gold_returns",
        "fait_lignes_commandes": "(select * from silver_lines join gold_orders using (commande_nk) join item using (produit_nk))",
    }
    parts = []
    for link in SILVER_LINKS + GOLD_LINKS:
        layer, child = link.child.split(".")
        parent = link.parent.split(".")[1]
        if layer == "silver":
            rows, known, key = f"({faulty_sql(child)})", f"({faulty_sql(parent)})", link.column
        else:
            rows, known, key = gold[child], gold[parent], link.column
            if parent == "dim_temps" and key != "date_sk":
                key = day.format(key.removesuffix("_sk"))
        orphan = f"k is not null and k not in (select {link.parent_key} from {known} p where {link.parent_key} is not null)"
        parts.append(
            f"select '{link.child}' enfant, '{link.column}' cle, '{link.parent}' parent, "
            f"count(distinct k) filter ({orphan}) nb_cles_orphelines, count(*) filter ({orphan}) nb_lignes_orphelines, "
            f"{'0' if link.optional else 'count(*) filter (k is null)'} nb_lignes_sans_cle from (select {key} k from {rows} c) x"
        )
    return " union all ".join(parts)
