"""Number expressions: parsing, rounding, empty values."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def py_round(name: str, digits: int) -> Column:
    """Round a column as Python's round() does: to the nearest decimal, ties to even.

    A double such as 2.675 lies a little below the decimal it prints as, so
    scaling it can land on .5 although it is no tie. There the exact sign of
    (k + .5) - scale * value decides; it is found by subtracting the
    power-of-two multiples that make up the scale, each step being exact.

    It takes a column name, as the value occurs many times in the expression.
    """
    value = f"`{name}`"
    if digits == 0:
        return F.expr(f"bround({value})")
    scale = 10 ** digits
    scaled = f"({value} * {scale}D)"
    below = f"CAST(floor({scaled}) AS DOUBLE)"
    multiples = [bit for bit in reversed(range(scale.bit_length())) if scale >> bit & 1]
    rest = f"({below} + 0.5D" + "".join(f" - {value} * {1 << bit}D" for bit in multiples) + ")"
    return F.expr(
        f"CASE WHEN {scaled} - {below} = 0.5D AND {rest} > 0 THEN {below} "
        f"WHEN {scaled} - {below} = 0.5D AND {rest} < 0 THEN {below} + 1 "
        f"ELSE bround({scaled}) END / {scale}D")


def round_columns(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Columns rounded in place."""
    return df.withColumns({name: py_round(name, digits) for name in names})


def js_round(value: Column, digits: int = 0) -> Column:
    """Round as Math.round(value * 10**digits) / 10**digits does: ties upward."""
    scale = float(10 ** digits)
    return F.floor(value * scale + 0.5).cast("double") / scale


def one_decimal(value: Column) -> Column:
    """Scale by ten, round half to even, scale back."""
    return F.bround(value * 10.0) / 10.0


def zero_as_null(value: Column) -> Column:
    return F.when(value != 0, value)


def blank_as_null(text: Column) -> Column:
    return F.when(text != "", text)


def null_as_blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


_NUMBER = (r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$")


def to_number(text: Column) -> Column:
    """Text to double; null where the text is no number.

    The pattern comes first because try_cast works by catching an exception per
    bad value. Digit grouping (1_000) counts as a number, Java's suffixes (1.5d)
    do not.
    """
    text = F.when(text.contains("_"), F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")).otherwise(text)
    return F.when(text.rlike(_NUMBER), text.cast("double"))


def to_int(text: Column) -> Column:
    """Text of digits to a whole number of up to 38 digits; null for other texts."""
    return F.when(text.rlike(r"^\s*\+?\d+\s*$"), F.trim(text).try_cast("decimal(38,0)"))


def finite(value: Column) -> Column:
    """The number itself; null for NaN and infinities."""
    number = value.cast("double")
    return F.when(F.abs(number) < float("inf"), number)
