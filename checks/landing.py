"""The given tables read as the landing layer of a retailer, with faults put in.

Stores are nations, tickets are orders, sale lines are line items. Faults depend on the
order number only, so their number can be computed without Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.operators import calendar as cal
from bazaarlake.plans import gold as gold_plan
from bazaarlake.plans import silver as silver_plan
from bazaarlake.sources.files import land

EXACT = "decimal(18,4)"


class LazyTables(Mapping):
    """Tables built on first use."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _cents(amount: Column, scale: int, quantity: Column) -> Column:
    """amount / quantity in money, rounded half up on whole numbers."""
    unit = 10 ** (scale - 2)
    whole = (F.abs(amount) * F.lit(10**scale)).cast("long")
    cents = F.floor((whole + quantity * (unit // 2)) / (quantity * unit))
    return (F.signum(amount).cast("int") * cents / F.lit(100)).cast("decimal(12,2)")


class Retailer:
    """Bronze, silver and gold over one folder of the given tables; nothing is cached."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._given: dict[str, DataFrame] = {}
        self.bronze = LazyTables({n: getattr(self, f"_land_{n}") for n in contract.TABLES})
        self.cleaned = LazyTables({n: getattr(self, f"_clean_{n}") for n in contract.TABLES})
        self.silver = LazyTables({n: (lambda n=n: self.cleaned[n].rows) for n in contract.TABLES})
        self.gold = LazyTables({n: getattr(self, f"_gold_{n}") for n in contract.TABLES})

    def table(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._given[name]

    # --- bronze ---------------------------------------------------------------------

    def _land(self, df: DataFrame, table: contract.Table) -> DataFrame:
        return land(df, table, audit=False)

    def _one_row(self, **values: str) -> DataFrame:
        return self.spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(n) for n, v in values.items()])

    def _land_dim_magasin(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
        key = F.col("n_nationkey")
        stores = joined.select(
            key.alias("magasin_nk"),
            F.concat(F.lit("Store "), "n_name").alias("nom"),
            F.col("n_name").alias("ville"),
            F.col("r_name").alias("region"),
            F.concat(F.lit("T"), (key % 3).cast("string")).alias("type"),
            (key * 100 + 500).alias("surface_m2"),
        )
        empty = self._one_row(
            magasin_nk="99", nom="Store EMPTY", ville="NOWHERE", region="NONE", type="T0", surface_m2="1000"
        )
        return self._land(stores, contract.STORES).unionByName(empty)

    def _land_dim_fournisseur(self) -> DataFrame:
        supplier, nation = self.table("supplier"), self.table("nation")
        joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        key = F.col("s_suppkey")
        return self._land(
            joined.select(
                key.alias("fournisseur_nk"),
                F.col("s_name").alias("nom"),
                F.concat(F.lit("C"), (key % 5).cast("string")).alias("categorie_principale"),
                F.col("n_name").alias("pays"),
                (key % 15).alias("delai_livraison_jours"),
            ),
            contract.SUPPLIERS,
        )

    def _land_dim_produit(self) -> DataFrame:
        price = F.col("p_retailprice").cast(EXACT)
        vat = F.when(F.col("p_partkey") % 2 == 0, 20).otherwise(14)
        products = self.table("part").select(
            F.col("p_partkey").alias("produit_nk"),
            F.col("p_name").alias("nom"),
            F.col("p_type").alias("categorie"),
            F.col("p_brand").alias("sous_categorie"),
            (F.col("p_partkey") % 10).alias("fournisseur_nk"),
            (price * F.lit("0.8").cast("decimal(2,1)")).cast(EXACT).alias("prix_achat_ht"),
            price.alias("prix_vente_ht"),
            vat.alias("tva_pct"),
            (price * (vat + 100) / F.lit(100)).cast(EXACT).alias("prix_vente_ttc"),
            (price * F.lit("0.2").cast("decimal(2,1)")).cast(EXACT).alias("marge_brute_ht"),
        )
        unsold = self._one_row(
            produit_nk="UNSOLD", nom="unsold thing", categorie="NONE", sous_categorie="Brand#0", fournisseur_nk="0",
            prix_achat_ht="8", prix_vente_ht="10", tva_pct="20", prix_vente_ttc="12", marge_brute_ht="2",
        )
        return self._land(products, contract.PRODUCTS).unionByName(unsold)

    def _land_dim_client(self) -> DataFrame:
        customer, nation = self.table("customer"), self.table("nation")
        joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        key = F.col("c_custkey")
        bad = key % 20 == 3
        at = F.when(bad, "").otherwise("@")
        days = lambda start, n: F.date_add(F.lit(start).cast("date"), (key % n).cast("int"))
        customers = joined.select(
            key.alias("client_nk"),
            F.concat(F.lit("P"), key.cast("string")).alias("prenom"),
            F.col("c_name").alias("nom"),
            F.concat(F.lit("c"), key.cast("string"), at, F.lit("mail.com")).alias("email"),
            F.concat(F.lit("06"), key.cast("string")).alias("telephone"),
            F.col("n_name").alias("ville"),
            days("1960-01-01", 10000).alias("date_naissance"),
            days("1994-01-01", 300).alias("date_inscription"),
            F.col("c_mktsegment").alias("segment"),
            (~bad).alias("email_valide"),
        )
        idle = self._one_row(
            client_nk="IDLE", prenom="Nobody", nom="Idle", email="idle@mail.com", telephone="060", ville="NOWHERE",
            date_naissance="1970-01-01", date_inscription="1994-01-01", segment="NONE", email_valide="true",
        )
        return self._land(customers, contract.CUSTOMERS).unionByName(idle)

    def day_bounds(self) -> DataFrame:
        """From the first day of the first order year to the last day of the last one."""
        seen = cal.observed_bounds(self.table("orders"), "o_orderdate")
        return seen.select(
            F.trunc("first", "year").alias("first"),
            F.last_day(F.add_months(F.trunc("last", "year"), 11)).alias("last"),
        )

    def _land_dim_temps(self) -> DataFrame:
        return self._land(cal.source_calendar(self.day_bounds()), contract.CALENDAR)

    def order_lines(self) -> DataFrame:
        """Line items with their order and the supplier's nation, amounts in exact decimals."""
        line, order, supplier = self.table("lineitem"), self.table("orders"), self.table("supplier")
        # Widths that keep every product within 18 digits, where decimals are plain longs.
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        discount, tax = (F.col(c).cast("decimal(3,2)") for c in ("l_discount", "l_tax"))
        one = F.lit(1).cast("decimal(1,0)")
        # Read as exact numbers and placed before they meet their order: whole numbers are shuffled in fewer bytes than doubles.
        placed = line.join(supplier, line.l_suppkey == supplier.s_suppkey).select(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            "l_returnflag",
            "s_nationkey",
            F.col("l_quantity").cast("long").alias("quantity"),
            (price * (one - discount)).cast("decimal(13,4)").alias("net"),
            tax.alias("tax"),
        )
        dated = order.select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
        # Both grow with the data, so they meet by shuffle; AQE splits a skewed order.
        typed = placed.join(dated.hint("merge"), placed.l_orderkey == dated.o_orderkey).drop("o_orderkey")
        return typed.withColumn("gross", (F.col("net") * (one + F.col("tax"))).cast("decimal(18,6)"))

    def _land_fait_ventes(self) -> DataFrame:
        order = F.col("l_orderkey")
        signed = lambda c: F.when(order % 100 == 11, -F.col(c)).otherwise(F.col(c))
        net, gross = signed("net"), signed("gross")
        margin = (net * F.lit("0.2").cast("decimal(2,1)")).cast("decimal(18,5)")
        day = F.col("day").cast("string")
        quantity = F.when(order % 50 == 7, -(F.col("l_linenumber") % 3)).otherwise(F.col("quantity"))
        sales = self.order_lines().select(
            order.alias("ticket_nk"),
            F.when(order % 100 == 37, "DATE_INVALIDE")
            .otherwise(F.concat(day, F.lit(" 00:00:00")))
            .alias("timestamp_vente"),
            day.alias("date_vente"),
            F.col("s_nationkey").alias("magasin_nk"),
            F.when(order % 100 == 23, "CLI-GHOST").otherwise(F.col("o_custkey").cast("string")).alias("client_nk"),
            F.col("l_partkey").alias("produit_nk"),
            quantity.alias("quantite"),
            _cents(net, 4, F.col("quantity")).alias("prix_unitaire_ht"),
            (F.col("tax") * 100).cast("decimal(5,2)").alias("tva_pct"),
            _cents(gross, 6, F.col("quantity")).alias("prix_unitaire_ttc"),
            net.alias("montant_ht"),
            gross.alias("montant_ttc"),
            _cents(margin, 5, F.col("quantity")).alias("marge_brute_unit"),
            margin.alias("marge_brute_total"),
            F.when((order + F.col("l_linenumber")) % 33 == 0, 2).otherwise(1).alias("copies"),
        )
        repeated = sales.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        return self._land(repeated, contract.SALES)

    def _land_fait_retours(self) -> DataFrame:
        lines = self.order_lines().where(F.col("l_returnflag") == "R")
        return self._land(
            lines.select(
                F.concat_ws("-", "l_orderkey", "l_partkey", "l_linenumber").alias("retour_nk"),
                F.col("l_orderkey").alias("ticket_nk"),
                F.col("l_partkey").alias("produit_nk"),
                F.col("s_nationkey").alias("magasin_nk"),
                F.col("o_custkey").alias("client_nk"),
                F.col("day").alias("date_vente_originale"),
                F.date_add("day", F.col("l_linenumber") + 1).alias("date_retour"),
                F.col("quantity").alias("quantite_retournee"),
                F.col("gross").alias("montant_rembourse"),
                F.col("o_orderpriority").alias("motif"),
            ),
            contract.RETURNS,
        )

    def _land_fait_lignes_commandes(self) -> DataFrame:
        price = F.col("l_extendedprice").cast(EXACT)
        quantity = F.col("l_quantity").cast("long")
        return self._land(
            self.table("lineitem").select(
                F.col("l_orderkey").alias("commande_nk"),
                F.col("l_partkey").alias("produit_nk"),
                quantity.alias("quantite_commandee"),
                _cents(price, 4, quantity).alias("prix_unitaire_achat"),
                price.alias("montant_ligne_ht"),
            ),
            contract.ORDER_LINES,
        )

    def _land_fait_commandes(self) -> DataFrame:
        totals = self.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sum(F.col("l_extendedprice").cast(EXACT)).alias("total")
        )
        order = F.col("o_orderkey")
        day = F.to_date("o_orderdate")
        return self._land(
            self.table("orders").join(totals, "o_orderkey", "left").select(
                order.alias("commande_nk"),
                (order % 10).alias("fournisseur_nk"),
                (order % 25).alias("magasin_nk"),
                day.alias("date_commande"),
                F.date_add(day, (order % 10).cast("int")).alias("date_livraison_prev"),
                F.col("o_orderstatus").alias("statut"),
                F.coalesce(F.col("total"), F.lit(0)).alias("montant_total_ht"),
            ),
            contract.ORDERS,
        )

    def _land_fait_stock(self) -> DataFrame:
        # Dealt by product, as the join with its price needs them: sums by month and store hardly shrink the rows, and would be shuffled again.
        lines = self.order_lines().select(F.trunc("day", "MM").alias("date_snapshot"), "l_partkey", "s_nationkey", "quantity")
        lines = lines.repartition("l_partkey").groupBy("date_snapshot", "l_partkey", "s_nationkey").agg(F.sum("quantity").alias("q"))
        part = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").cast(EXACT).alias("price")
        )
        q = F.col("q")
        value = (q * F.col("price") * F.lit("0.8").cast("decimal(2,1)")).cast(EXACT)
        return self._land(
            lines.join(part, "l_partkey").select(
                "date_snapshot",
                F.col("l_partkey").alias("produit_nk"),
                F.col("s_nationkey").alias("magasin_nk"),
                q.alias("quantite_en_stock"),
                value.alias("valeur_stock_ht"),
                F.lit(10).alias("seuil_reapprovisionnement"),
                (q % 7 == 0).alias("en_rupture"),
            ),
            contract.STOCK,
        )

    # --- silver: parents are the valid rows, whose keys equal those of the final rows ---

    @cached_property
    def _parents(self) -> Mapping:
        return LazyTables({n: (lambda n=n: self.cleaned[n].valid) for n in contract.TABLES})

    def _clean_dim_magasin(self):
        return silver_plan.clean_stores(self.bronze["dim_magasin"])

    def _clean_dim_fournisseur(self):
        return silver_plan.clean_suppliers(self.bronze["dim_fournisseur"])

    def _clean_dim_produit(self):
        return silver_plan.clean_products(self.bronze["dim_produit"], self._parents["dim_fournisseur"])

    def _clean_dim_client(self):
        return silver_plan.clean_customers(self.bronze["dim_client"])

    def _clean_dim_temps(self):
        return silver_plan.clean_calendar(self.bronze["dim_temps"])

    def _clean_fait_stock(self):
        return silver_plan.clean_stock(self.bronze["fait_stock"], self._parents)

    def _clean_fait_commandes(self):
        return silver_plan.clean_orders(self.bronze["fait_commandes"], self._parents)

    def _clean_fait_lignes_commandes(self):
        parents = self._parents
        dims = {"dim_produit": parents["dim_produit"]}
        return silver_plan.clean_order_lines(self.bronze["fait_lignes_commandes"], dims, parents["fait_commandes"])

    def _clean_fait_ventes(self):
        return silver_plan.clean_sales(self.bronze["fait_ventes"], self._parents)

    def _clean_fait_retours(self):
        return silver_plan.clean_returns(self.bronze["fait_retours"], self._parents)

    # --- gold ------------------------------------------------------------------------------

    @cached_property
    def keys(self) -> gold_plan.KeyMaps:
        names = ("dim_magasin", "dim_fournisseur", "dim_produit", "dim_client")
        return gold_plan.KeyMaps({n: self.gold[n] for n in names}, one_row=True)

    def _gold_dim_magasin(self):
        return gold_plan.build_stores(self.silver["dim_magasin"])

    def _gold_dim_fournisseur(self):
        return gold_plan.build_suppliers(self.silver["dim_fournisseur"])

    def _gold_dim_produit(self):
        return gold_plan.build_products(self.silver["dim_produit"], self.gold["dim_fournisseur"])

    def _gold_dim_client(self):
        return gold_plan.build_customers(self.silver["dim_client"])

    def _gold_dim_temps(self):
        return cal.calendar(self.day_bounds())

    def _gold_fait_stock(self):
        return gold_plan.build_stock(self.silver["fait_stock"], self.keys)

    def _gold_fait_commandes(self):
        return gold_plan.build_orders(self.silver["fait_commandes"], self.keys)

    def _gold_fait_lignes_commandes(self):
        return gold_plan.build_order_lines(
            self.silver["fait_lignes_commandes"], self.keys, self.gold["fait_commandes"]
        )

    def _gold_fait_ventes(self):
        return gold_plan.build_sales(self.silver["fait_ventes"], self.keys)

    def _gold_fait_retours(self):
        return gold_plan.build_returns(self.silver["fait_retours"], self.keys)
