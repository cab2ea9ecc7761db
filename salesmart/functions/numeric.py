"""Fixed-point money arithmetic.

Money has four decimals. Quotients of money are cut after four decimals (not rounded), as the
source system's money type does; percentages are rounded half up.
"""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.schema import MONEY, PERCENT

_TEN_THOUSANDTH = Decimal("0.0001")
_HUNDREDTH = Decimal("0.01")


def money(col: Column) -> Column:
    return col.cast(MONEY)


def line_amount(unit_price: Column, quantity: Column, discount: Column) -> Column:
    """unit price x quantity x (1 - discount), rounded to money."""
    return money(unit_price * quantity * (F.lit(1) - discount))


def _int_div(num: Column, den: Column) -> Column:
    return F.call_function("div", num, F.when(den != 0, den)).cast("decimal(19,0)")


def money_div(num: Column, den: Column) -> Column:
    """num / den cut toward zero after four decimals; null when den is zero."""
    return (_int_div(num * 10000, den) * F.lit(_TEN_THOUSANDTH)).cast(MONEY)


def pct2(num: Column, den: Column) -> Column:
    """100 * num / den rounded half away from zero to two decimals; null when den is zero."""
    rounded = _int_div(F.abs(num) * 20000 + F.abs(den), F.abs(den) * 2)
    signed = F.when((num < 0) != (den < 0), -rounded).otherwise(rounded)
    return (signed * F.lit(_HUNDREDTH)).cast(PERCENT)


def mean_pct(total: Column, rows: Column) -> Column:
    """100 * total / rows as a double, taken from an exact decimal total."""
    return total.cast("double") / rows * 100


def allocate(amount: Column, line: Column, subtotal: Column, ratio_mode: str = "float") -> Column:
    """The share of an order-level amount that falls to one line.

    `float` takes the ratio as a double and spreads the amount whole (to rounding); `money` cuts
    the ratio after four decimals, as the full refresh of the source system does.
    """
    amount = F.coalesce(amount, F.lit(0).cast(MONEY))
    zero = F.lit(0).cast(MONEY)
    if ratio_mode == "float":
        ratio = line.cast("double") / subtotal.cast("double")
        return F.when(subtotal == 0, zero).otherwise(money(amount.cast("double") * ratio))
    if ratio_mode == "money":
        return F.when(subtotal > 0, money(amount * money_div(line, subtotal))).otherwise(zero)
    raise ValueError(f"unknown ratio_mode {ratio_mode!r}")
