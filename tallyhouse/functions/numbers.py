"""Money, ratios and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"

_TWO_60 = 1 << 60

# Currency codes written as a leading symbol.
CURRENCY_SYMBOLS = {"USD": "$", "EUR": "€", "GBP": "£"}


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def round_cents(value: Column) -> Column:
    """Round a double to two places the way an IEEE-exact, half-to-even rounding does.

    ``round`` and ``bround`` work on the printed decimal, so 0.025 counts as a tie although
    the stored double lies above it. Here the fraction is scaled by 2^60, which is exact, and
    rounded as a decimal. The quotient has 17 places; anything but a true tie is at least
    100 / 2^60, about 9e-17, away from one.
    """
    size = F.abs(value)
    whole = F.floor(size)
    # Through long: a double cast straight to decimal goes by its printed, inexact digits.
    fraction = ((size - whole) * F.lit(float(_TWO_60))).cast("long").cast("decimal(19,0)")
    hundredths = (fraction * F.lit(100).cast("decimal(3,0)")).cast("decimal(21,0)") / F.lit(_TWO_60).cast("decimal(19,0)")
    cents = F.bround(hundredths, 0).cast("long")
    return F.signum(value) * ((whole * 100 + cents).cast("double") / F.lit(100.0))


def percent(part: Column, total: Column) -> Column:
    """Percentage with two places; 0.0 when the total is not positive."""
    # nullif keeps the division safe under ANSI mode.
    ratio = part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0)) * F.lit(100.0)
    return F.when(total <= 0, F.lit(0.0)).otherwise(round_cents(ratio))


def divide_or(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Plain division with a default for a zero denominator; NULL in, NULL out."""
    quotient = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.when(denominator == 0, F.lit(default)).otherwise(quotient)


def per_second(count: Column, seconds: Column) -> Column:
    """Throughput; 0.0 when no time has passed."""
    return F.when(seconds <= 0, F.lit(0.0)).otherwise(
        count.cast("double") / F.nullif(seconds.cast("double"), F.lit(0.0))
    )


def mean_of_money(amount: Column) -> Column:
    """Exact mean of a decimal column: six places, half up."""
    return F.avg(money(amount)).cast("decimal(22,6)")


def currency_text(amount: Column, currency: Column) -> Column:
    """Two places with thousands separators; known currencies get their symbol in front."""
    digits = F.format_number(amount, 2)
    text = F.concat(digits, F.lit(" "), currency)
    for code, symbol in CURRENCY_SYMBOLS.items():
        text = F.when(currency == code, F.concat(F.lit(symbol), digits)).otherwise(text)
    return text
