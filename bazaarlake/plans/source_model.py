"""Table jobs that derive source attributes: prices, amounts, segments, order totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions import amounts
from bazaarlake.operators.joins import with_default


def price_list(products: DataFrame, cost: str, markup: Column, vat_percent: Column) -> DataFrame:
    """Adds net price, gross price and unit margin to products with a cost."""
    net = amounts.sale_price(F.col(cost), markup)
    priced = products.withColumns({"prix_vente_ht": net, "tva_pct": vat_percent.cast("decimal(5,2)")})
    return priced.withColumns(
        {
            "prix_vente_ttc": amounts.gross_price(F.col("prix_vente_ht"), F.col("tva_pct")),
            "marge_brute_ht": amounts.price_margin(F.col("prix_vente_ht"), F.col(cost)),
        }
    )


def sale_line_amounts(lines: DataFrame) -> DataFrame:
    """Adds line amounts and margin from unit prices, unit margin and quantity."""
    return lines.withColumns(
        {
            "montant_ht": amounts.line_amount(F.col("prix_unitaire_ht"), F.col("quantite")),
            "montant_ttc": amounts.line_amount(F.col("prix_unitaire_ttc"), F.col("quantite")),
            "marge_brute_total": amounts.line_margin(F.col("marge_brute_unit"), F.col("quantite")),
        }
    )


def stock_flags(stock: DataFrame, cost: str, usual_minimum: Column) -> DataFrame:
    """Adds value, reorder point and the out-of-stock flag."""
    quantity = F.col("quantite_en_stock")
    return stock.withColumns(
        {
            "valeur_stock_ht": amounts.stock_value(quantity, F.col(cost)),
            "seuil_reapprovisionnement": amounts.reorder_point(usual_minimum),
            "en_rupture": amounts.out_of_stock(quantity),
        }
    )


def customer_segments(sales: DataFrame) -> DataFrame:
    """Segment of each buying customer, from distinct tickets and the mean line amount.

    The distinct count first groups by (customer, ticket), so one customer with a large
    part of the lines is spread over its tickets.
    """
    known = sales.where(F.col("client_nk").isNotNull() & (F.col("quantite") > 0))
    stats = known.groupBy("client_nk").agg(
        F.count_distinct("ticket_nk").alias("nb_tickets"),
        F.sum("montant_ttc").alias("_ttc"),
        F.count("montant_ttc").alias("_n"),
    )
    # Compared as products, so that no rounded mean decides a class.
    basket_at_least = lambda floor: F.col("_ttc") >= F.col("_n") * floor
    segment = (
        F.when(
            basket_at_least(contract.PREMIUM_MIN_BASKET) & (F.col("nb_tickets") >= contract.PREMIUM_MIN_TICKETS),
            contract.SEGMENT_PREMIUM,
        )
        .when(
            basket_at_least(contract.STANDARD_MIN_BASKET) & (F.col("nb_tickets") >= contract.STANDARD_MIN_TICKETS),
            contract.SEGMENT_STANDARD,
        )
        .otherwise(contract.SEGMENT_DEFAULT)
    )
    return stats.select("client_nk", "nb_tickets", segment.alias("segment"))


def assign_segments(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Customers with the computed segment; those without purchases get the default class."""
    computed = customer_segments(sales)
    return with_default(customers, computed, "client_nk", "segment", contract.SEGMENT_DEFAULT)


def order_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("commande_nk").agg(F.sum("montant_ligne_ht").alias("montant_total_ht"))


def order_total_audit(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders whose header total differs from the sum of their lines."""
    summed = order_totals(lines).withColumnRenamed("montant_total_ht", "total_lignes_ht")
    both = orders.select("commande_nk", "montant_total_ht").join(summed, "commande_nk", "left")
    both = both.withColumn("total_lignes_ht", F.coalesce("total_lignes_ht", F.lit(0)))
    return both.where(F.col("montant_total_ht") != F.col("total_lignes_ht"))
