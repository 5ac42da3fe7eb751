"""Calendar dimension, month spine and the gaps in the product x store x month frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions import dates


def date_bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row with the columns ``first`` and ``last``."""
    return spark.range(0, 1, 1, 1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )


def observed_bounds(df: DataFrame, day: str) -> DataFrame:
    """The first and last day found in ``df``, as one row."""
    return df.agg(F.min(F.col(day).cast("date")).alias("first"), F.max(F.col(day).cast("date")).alias("last"))


def calendar(
    bounds: DataFrame,
    locale: str = "en",
    monday_zero: bool = False,
    holidays: list[str] | None = None,
) -> DataFrame:
    """One row per day between the bounds, both included."""
    day = F.col("date_complete")
    off = holidays or []
    days = bounds.select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("date_complete"))
    return days.select(
        dates.date_key(day).alias("temps_sk"),
        day,
        F.dayofmonth(day).alias("jour"),
        dates.weekday_number(day, monday_zero).alias("jour_semaine_num"),
        dates.day_name(day, locale).alias("jour_semaine_nom"),
        F.weekofyear(day).alias("semaine_annee"),
        F.month(day).alias("mois_num"),
        dates.month_name(day, locale).alias("mois_nom"),
        F.quarter(day).alias("trimestre"),
        dates.half_year(day).alias("semestre"),
        F.year(day).alias("annee"),
        dates.is_weekend(day).alias("est_weekend"),
        dates.is_holiday(day, off).alias("est_ferie"),
        dates.is_working_day(day, off).alias("est_jour_ouvre"),
    )


def warehouse_calendar(spark: SparkSession) -> DataFrame:
    """The gold calendar of the published range: English names, Sunday = 1, no holidays."""
    return calendar(date_bounds(spark, contract.GOLD_CALENDAR_START, contract.GOLD_CALENDAR_END))


def fitted_bounds(facts: dict[str, tuple[DataFrame, list[str]]], earliest: str, latest: str) -> DataFrame:
    """Whole years around all days in the given columns of the facts, as one row; days before ``earliest`` or after
    ``latest`` are taken for errors and do not count. Without any day the bounds are NULL."""
    seen = None
    for df, columns in facts.values():
        days = [F.when(F.col(c).between(F.lit(earliest).cast("date"), F.lit(latest).cast("date")), F.col(c)) for c in columns]
        # One row a fact, with least and greatest over its columns, so each fact is read once.
        ends = df.agg(*[F.min(d).alias(f"a{i}") for i, d in enumerate(days)], *[F.max(d).alias(f"b{i}") for i, d in enumerate(days)])
        both = ends.select(
            F.array_min(F.array(*[f"a{i}" for i in range(len(days))])).alias("first"),
            F.array_max(F.array(*[f"b{i}" for i in range(len(days))])).alias("last"),
        )
        seen = both if seen is None else seen.unionByName(both)
    whole = seen.agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return whole.select(
        F.trunc("first", "year").alias("first"), F.last_day(F.add_months(F.trunc("last", "year"), 11)).alias("last")
    )


def source_calendar(bounds: DataFrame, holidays: list[str] | None = None) -> DataFrame:
    """The landing calendar: French names, Monday = 0, public holidays."""
    return calendar(bounds, "fr", True, contract.HOLIDAYS_2024 if holidays is None else holidays)


def month_starts(bounds: DataFrame) -> DataFrame:
    """The first of every month between the bounds."""
    months = F.expr("sequence(trunc(first, 'MM'), trunc(last, 'MM'), interval 1 month)")
    return bounds.select(F.explode(months).alias("date_snapshot"))


def stock_coverage(stock: DataFrame, products: DataFrame, stores: DataFrame, bounds: DataFrame) -> DataFrame:
    """For every month and store: how many products there are, how many have no stock, and the stock of the others.

    The frame of every product in every store and month is only counted, never built: what has stock is summed by month and
    store, and the rest follows from the number of products. ``stock`` is unique on (month, product, store) and refers to
    ``products`` and ``stores``.
    """
    held = stock.groupBy("date_snapshot", "magasin_nk").agg(
        F.count("quantite_en_stock").alias("_held"), F.sum("quantite_en_stock").alias("quantite")
    )
    months = bounds.select(F.expr("sequence(trunc(first, 'MM'), trunc(last, 'MM'), interval 1 month)").alias("m"))
    frame = stores.select("magasin_nk").distinct().withColumn("date_snapshot", F.explode(months.scalar()))
    total = products.agg(F.count_distinct("produit_nk").alias("n")).scalar()
    return frame.join(held, ["date_snapshot", "magasin_nk"], "left").select(
        "date_snapshot",
        "magasin_nk",
        total.alias("nb_produits"),
        (total - F.coalesce("_held", F.lit(0))).alias("nb_sans_stock"),
        F.coalesce("quantite", F.lit(0)).alias("quantite"),
    )
