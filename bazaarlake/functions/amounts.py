"""Money, tax and ratio expressions. All arithmetic on money stays in decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlake.contract import DEFAULT_MARGIN_RATE, DEFAULT_VAT_PERCENT, NET_FROM_GROSS_DIVISOR

MONEY = "decimal(12,2)"


def _const(text: str, type_name: str) -> Column:
    return F.lit(text).cast(type_name)


def vat_or_default(vat: Column) -> Column:
    return F.coalesce(vat, _const(DEFAULT_VAT_PERCENT, "decimal(5,2)"))


def net_or_derived(net: Column, gross: Column) -> Column:
    """The net amount, or the gross one without the flat tax when net is missing."""
    derived = (gross / _const(NET_FROM_GROSS_DIVISOR, "decimal(3,2)")).try_cast(MONEY)
    return F.coalesce(net, derived)


def unit_margin_or_derived(margin: Column, net_price: Column) -> Column:
    return F.coalesce(margin, (net_price * _const(DEFAULT_MARGIN_RATE, "decimal(3,2)")).try_cast(MONEY))


def line_margin_or_derived(margin: Column, unit_margin: Column, quantity: Column) -> Column:
    return F.coalesce(margin, (unit_margin * quantity).try_cast(MONEY))


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Exact quotient rounded half up; NULL when the denominator is zero or NULL."""
    exact = numerator * F.lit(1).cast("decimal(1,0)")
    return F.round(exact / F.nullif(denominator, F.lit(0)), digits)


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    exact = numerator * F.lit(100).cast("decimal(3,0)")
    return F.round(exact / F.nullif(denominator, F.lit(0)), digits)


def quotient(numerator: Column, denominator: Column) -> Column:
    """Unrounded quotient as double, for measures reported without rounding."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


# Price list: cost, mark-up and tax rate to sale prices.


def sale_price(cost: Column, markup: Column) -> Column:
    return F.round(cost * (F.lit(1) + markup), 2).cast(MONEY)


def gross_price(net: Column, vat_percent: Column) -> Column:
    return F.round(net * (F.lit(1) + vat_percent / F.lit(100)), 2).cast(MONEY)


def price_margin(net: Column, cost: Column) -> Column:
    return F.round(net - cost, 2).cast(MONEY)


# Sale lines.


def line_amount(price: Column, quantity: Column) -> Column:
    return F.round(price * quantity, 2).cast(MONEY)


def line_margin(unit_margin: Column, quantity: Column) -> Column:
    """Unit margin times quantity, where a quantity under one counts as one."""
    return F.round(unit_margin * F.greatest(F.lit(1), quantity), 2).cast(MONEY)


# Stock.


def stock_value(quantity: Column, cost: Column) -> Column:
    return F.round(quantity * cost, 2).cast(MONEY)


def out_of_stock(quantity: Column) -> Column:
    return quantity == 0


def reorder_point(usual_minimum: Column) -> Column:
    return F.greatest(F.lit(10), F.floor(usual_minimum / F.lit(5)).cast("int"))


# Tax.


def vat_amount(gross: Column, net: Column) -> Column:
    return gross - net


def vat_share(gross: Column, net: Column, digits: int = 1) -> Column:
    return percent(gross - net, gross, digits)
