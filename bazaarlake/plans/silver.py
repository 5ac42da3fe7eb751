"""Bronze to silver: typed, checked, de-duplicated tables and their rejects.

Each ``clean_*`` takes the landed all-text table and gives a ``Cleaned``. Nothing runs
until one of its frames is used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions import amounts, casts
from bazaarlake.functions.text import email_or_null
from bazaarlake.operators import quality
from bazaarlake.operators.dedup import keep_first
from bazaarlake.operators.quality import Rule


@dataclass(frozen=True)
class Options:
    """How strictly to clean.

    record_data      "raw" keeps the row as landed in the quarantine, "typed" the cast row
    blank_as_null    treat blank texts as NULL
    enforce_contract also reject rows that break a NOT NULL or length clause no rule covers
    require_ticket   reject returns without a ticket (streamed returns carry none)
    sales_key        business key of a sale line
    join_strategy    join hint for the reference checks; None leaves it to Spark
    settle           stores the orphan keys of a reference, given with the table's and column's name (see ``quality.assess``)
    """

    record_data: str = "raw"
    blank_as_null: bool = False
    enforce_contract: bool = True
    require_ticket: bool = True
    sales_key: tuple[str, ...] = contract.SALES.key
    join_strategy: str | None = None
    settle: Callable[[DataFrame, str, str], DataFrame] | None = None


DEFAULTS = Options()


@dataclass(frozen=True)
class Cleaned:
    """A checked table: every landed row is in ``valid`` or in ``rejects``."""

    table: contract.Table
    assessed: quality.Assessed
    key: tuple[str, ...]
    options: Options = field(default=DEFAULTS)

    @property
    def valid(self) -> DataFrame:
        return self.assessed.accepted(self.table.names)

    @property
    def rows(self) -> DataFrame:
        """The silver rows: one per business key."""
        return keep_first(self.valid, list(self.key))

    @property
    def document(self) -> Column:
        """The quarantine document of a row: as landed, or as cast."""
        row = F.col(quality.LANDED) if self.options.record_data == "raw" else F.struct(*self.table.names)
        return F.to_json(row, {"ignoreNullFields": "false"})

    @property
    def rejects(self) -> DataFrame:
        return self.assessed.rejected(self.table.name, self.document)


def _clean(
    table: contract.Table,
    landed: DataFrame,
    rules: list[Rule],
    parents: dict[str, DataFrame] | None = None,
    readings: dict[str, Column] | None = None,
    options: Options = DEFAULTS,
    key: tuple[str, ...] | None = None,
    not_required: tuple[str, ...] = (),
) -> Cleaned:
    readings = readings or {}
    columns = [
        readings.get(c.name, casts.read_as(c, blank_as_null=options.blank_as_null)).alias(c.name)
        for c in table.columns
    ]
    kept = [c for c in table.landing_names if c in landed.columns]
    typed = landed.select(F.struct(*kept).alias(quality.LANDED), *columns)
    late = []
    if options.enforce_contract:
        covered = {r.rule_id for r in rules}
        required = [r for r in quality.required_rules(table, skip=not_required) if r.rule_id not in covered]
        late = required + quality.length_rules(table)
    key = key or table.key
    settle = options.settle and (lambda orphans, column: options.settle(orphans, table.name, column))
    assessed = quality.assess(typed, rules, table.references, parents, late, options.join_strategy, key, settle)
    return Cleaned(table, assessed, key, options)


def _rules(table: contract.Table, required: list[str], **bounds: str) -> list[Rule]:
    reason = contract.REJECT_REASONS[table.name]
    return quality.missing(reason, *required) + [Rule(name, cond, reason) for name, cond in bounds.items()]


# --- dimensions -----------------------------------------------------------------------


def clean_stores(landed: DataFrame, options: Options = DEFAULTS) -> Cleaned:
    t = contract.STORES
    return _clean(t, landed, _rules(t, t.names, surface_not_positive="surface_m2 <= 0"), options=options)


def clean_suppliers(landed: DataFrame, options: Options = DEFAULTS) -> Cleaned:
    t = contract.SUPPLIERS
    rules = _rules(t, t.names, delai_negative="delai_livraison_jours < 0")
    return _clean(t, landed, rules, options=options)


def clean_products(landed: DataFrame, suppliers: DataFrame, options: Options = DEFAULTS) -> Cleaned:
    t = contract.PRODUCTS
    prices = ["prix_achat_ht", "prix_vente_ht", "prix_vente_ttc"]
    rules = _rules(
        t,
        ["produit_nk", "nom", "categorie", "fournisseur_nk", *prices],
        **{f"{p}_negative": f"{p} < 0" for p in prices},
    )
    return _clean(t, landed, rules, {"dim_fournisseur": suppliers}, options=options)


def clean_customers(landed: DataFrame, options: Options = DEFAULTS) -> Cleaned:
    t = contract.CUSTOMERS
    required = [c.name for c in t.columns if c.required]
    readings = {"email": email_or_null(F.col("email"))}
    return _clean(t, landed, _rules(t, required), readings=readings, options=options)


def clean_calendar(landed: DataFrame, options: Options = DEFAULTS) -> Cleaned:
    t = contract.CALENDAR
    return _clean(t, landed, _rules(t, ["temps_sk", "date_complete"]), options=options)


# --- facts ------------------------------------------------------------------------------


def clean_stock(landed: DataFrame, dims: dict[str, DataFrame], options: Options = DEFAULTS) -> Cleaned:
    t = contract.STOCK
    rules = _rules(
        t,
        ["date_snapshot", "produit_nk", "magasin_nk", "quantite_en_stock"],
        quantite_negative="quantite_en_stock < 0",
    )
    return _clean(t, landed, rules, dims, options=options)


def clean_orders(landed: DataFrame, dims: dict[str, DataFrame], options: Options = DEFAULTS) -> Cleaned:
    t = contract.ORDERS
    rules = _rules(
        t,
        ["commande_nk", "fournisseur_nk", "magasin_nk", "date_commande", "montant_total_ht"],
        montant_negative="montant_total_ht < 0",
    )
    return _clean(t, landed, rules, dims, options=options)


def clean_order_lines(
    landed: DataFrame, dims: dict[str, DataFrame], orders: DataFrame, options: Options = DEFAULTS
) -> Cleaned:
    """``orders`` are the cleaned headers: lines of a rejected order are rejected too."""
    t = contract.ORDER_LINES
    rules = _rules(
        t,
        ["commande_nk", "produit_nk", "quantite_commandee", "prix_unitaire_achat"],
        quantite_not_positive="quantite_commandee <= 0",
        prix_negative="prix_unitaire_achat < 0",
    )
    return _clean(t, landed, rules, {**dims, "fait_commandes": orders}, options=options)


def clean_sales(landed: DataFrame, dims: dict[str, DataFrame], options: Options = DEFAULTS) -> Cleaned:
    """Missing net amounts, tax rates and margins are derived from the gross ones."""
    t = contract.SALES
    amount = {
        name: casts.read_as(t.column(name))
        for name in t.names
        if t.column(name).kind in ("money", "percent", "int")
    }
    net_price = amounts.net_or_derived(amount["prix_unitaire_ht"], amount["prix_unitaire_ttc"])
    unit_margin = amounts.unit_margin_or_derived(amount["marge_brute_unit"], net_price)
    readings = {
        "date_vente": casts.first_known(
            casts.to_day(F.col("date_vente")), casts.to_day(F.col("timestamp_vente"))
        ),
        "tva_pct": amounts.vat_or_default(amount["tva_pct"]),
        "prix_unitaire_ht": net_price,
        "montant_ht": amounts.net_or_derived(amount["montant_ht"], amount["montant_ttc"]),
        "marge_brute_unit": unit_margin,
        "marge_brute_total": amounts.line_margin_or_derived(
            amount["marge_brute_total"], unit_margin, amount["quantite"]
        ),
    }
    rules = _rules(
        t,
        ["ticket_nk", "produit_nk", "magasin_nk", "timestamp_vente", "quantite", "montant_ttc"],
        quantite_not_positive="quantite <= 0",
        montant_ttc_negative="montant_ttc < 0",
    )
    return _clean(t, landed, rules, dims, readings, options, key=options.sales_key)


def clean_returns(landed: DataFrame, dims: dict[str, DataFrame], options: Options = DEFAULTS) -> Cleaned:
    t = contract.RETURNS
    required = ["retour_nk", "ticket_nk", "produit_nk", "magasin_nk", "date_retour", "quantite_retournee"]
    waived: tuple[str, ...] = ()
    if not options.require_ticket:
        required.remove("ticket_nk")
        waived = ("ticket_nk",)
    readings = {
        "date_vente_originale": casts.first_known(
            casts.to_day(F.col("date_vente_originale")), casts.to_day(F.col("date_retour"))
        )
    }
    rules = _rules(t, required, quantite_not_positive="quantite_retournee <= 0")
    return _clean(t, landed, rules, dims, readings, options, not_required=waived)
