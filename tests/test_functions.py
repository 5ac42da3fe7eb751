from decimal import Decimal

from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions import amounts, casts, dates, text


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_to_int_cuts_the_fraction_and_refuses_the_rest(spark):
    values = ["3", "3.0", "3.7", "-1.0", "-1.5", " 4 ", "abc", "", None, "1e2", "99999999999"]
    got = column(spark, values, casts.to_int(F.col("x")))
    assert got == [3, 3, 3, -1, -1, 4, None, None, None, None, None]


def test_to_decimal_overflow_is_null(spark):
    got = column(spark, ["1.005", "abc", "12345678901234.5", " 2 "], casts.to_decimal(F.col("x")))
    assert got == [Decimal("1.01"), None, None, Decimal("2.00")]


def test_dates_and_times(spark):
    values = ["2024-01-02", "2024-1-2", "2024-01-02T03:04:05", "2026-08-10T21:14:04.805123+00:00", "02/01/2024", "DATE_INVALIDE"]
    days = column(spark, values, casts.to_day(F.col("x")).cast("string"))
    assert days == ["2024-01-02", "2024-01-02", "2024-01-02", "2026-08-10", None, None]
    moments = column(spark, values, casts.to_moment(F.col("x")).cast("string"))
    assert moments[2] == "2024-01-02 03:04:05" and moments[3].startswith("2026-08-10 21:14:04.8") and moments[5] is None


def test_flags_and_text(spark):
    assert column(spark, ["true", "0", "oui", None], casts.to_flag(F.col("x"))) == [True, False, None, None]
    assert column(spark, [" a ", " ", None], casts.clean_text(F.col("x"))) == ["a", "", None]
    assert column(spark, [" a ", " "], casts.clean_text(F.col("x"), blank_as_null=True)) == ["a", None]


def test_email(spark):
    got = column(spark, ["a.b@c.ma", "ab.c", " a@b.ma ", None], text.email_or_null(F.col("x")))
    assert got == ["a.b@c.ma", None, None, None]


def test_derived_amounts(spark):
    row = spark.sql("select cast(12 as decimal(12,2)) g, cast(null as decimal(12,2)) n, 3 q")
    net = amounts.net_or_derived(F.col("n"), F.col("g"))
    unit = amounts.unit_margin_or_derived(F.col("n"), net)
    got = row.select(
        net, unit, amounts.line_margin_or_derived(F.col("n"), unit, F.col("q")),
        amounts.vat_or_default(F.col("n").cast("decimal(5,2)")),
    ).first()
    assert list(got) == [Decimal("10.00"), Decimal("2.00"), Decimal("6.00"), Decimal("20.00")]


def test_ratios_are_exact_and_safe(spark):
    row = spark.sql("select cast(1.005 as decimal(22,2)) a, cast(2.01 as decimal(22,2)) b, 2L two, 0L zero")
    got = row.select(
        amounts.ratio(F.col("b"), F.col("two")), amounts.ratio(F.col("b"), F.col("zero")),
        amounts.percent(F.col("two"), F.lit(3)),
    ).first()
    assert list(got) == [Decimal("1.01"), None, Decimal("66.67")]


def test_price_and_stock_expressions(spark):
    row = spark.sql("select cast(8.33 as decimal(12,2)) c, cast(0.2 as decimal(3,2)) m, 0 q, 80 u")
    price = amounts.sale_price(F.col("c"), F.col("m"))
    got = row.select(
        price, amounts.gross_price(price, F.lit(20)), amounts.price_margin(price, F.col("c")),
        amounts.line_margin(F.col("c"), F.col("q")), amounts.out_of_stock(F.col("q")), amounts.reorder_point(F.col("u")),
    ).first()
    assert list(got) == [Decimal("10.00"), Decimal("12.00"), Decimal("1.67"), Decimal("8.33"), True, 16]


def test_labels_and_keys(spark):
    row = spark.sql("select date '2024-08-04' d")
    d = F.col("d")
    got = row.select(
        dates.date_key(d), dates.day_name(d, "fr"), dates.month_name(d, "fr"), dates.day_name(d), dates.weekday_number(d),
        dates.weekday_number(d, True), dates.is_weekend(d), dates.half_year(d), dates.is_working_day(d, []),
        text.quarter_label(F.quarter(d)), text.without(F.lit("Shop A"), "Shop "),
        dates.capped_date(d, 60, "2024-09-01").cast("string"),
    ).first()
    assert list(got) == [20240804, "Dimanche", "Août", "Sunday", 1, 6, True, 2, False, "T3", "A", "2024-09-01"]


def test_row_document_keeps_nulls(spark):
    assert spark.sql("select 1 a, cast(null as int) b").select(text.row_document()).first()[0] == '{"a":1,"b":null}'


def test_contract_covers_every_table():
    assert len(contract.TABLES) == 10
    for table in contract.TABLES.values():
        assert set(table.key) <= set(table.names)
        for ref in table.references:
            assert ref.column in table.names and ref.parent_key in contract.TABLES[ref.parent].names
