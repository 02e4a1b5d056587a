"""Small column expressions shared by the operators; all run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def half_even(value: Column, decimals: int = 0) -> Column:
    """Round half to even on the binary value: scale, round to integer, scale back."""
    if decimals == 0:
        return F.rint(value)
    return F.rint(value * 10.0**decimals) / 10.0**decimals


def ratio(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """part / whole, and ``empty`` where there is nothing to divide by."""
    out = F.try_divide(part.cast("double"), whole.cast("double"))
    return out if empty is None else F.coalesce(out, F.lit(empty))


def clip(value: Column, lower, upper) -> Column:
    """Pull values outside the limits onto them; NULL stays NULL."""
    return F.when(value < lower, F.lit(lower)).when(value > upper, F.lit(upper)).otherwise(value)


def outside(value: Column, lower, upper) -> Column:
    """True strictly outside the limits; NULL is not an outlier."""
    return F.coalesce((value < lower) | (value > upper), F.lit(False))


def label_of(code: Column, names: dict) -> Column:
    """Code to label; a code without one becomes NULL."""
    out = F.lit(None)
    for key, label in reversed(names.items()):
        out = F.when(code == key, label).otherwise(out)
    return out if names else out.cast("string")


def signed_text(value: Column, decimals: int) -> Column:
    return F.format_string(f"%+.{decimals}f", value)


def fixed_text(value: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", value)


def text_bar(value: Column, width: int, char: str) -> Column:
    """``char`` repeated int(|value| * width) times."""
    return F.repeat(F.lit(char), F.abs(value * width).cast("int"))


def sign_mark(value: Column) -> Column:
    return F.when(value > 0, "+").otherwise("-")


def effect(value: Column) -> Column:
    """Direction in which a coefficient or correlation moves the risk."""
    return F.when(value > 0, "raises").otherwise("lowers")


def rows_of(df: DataFrame, fields: list[str], rows: list[list[Column]]) -> DataFrame:
    """Turn a one-row wide aggregate into a long table, one output row per entry of ``rows``."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(row, fields)]) for row in rows]
    return df.select(F.inline(F.array(*structs)))
