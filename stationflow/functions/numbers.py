"""Number columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Means of few values often end in an exact half of the last digit kept; the threshold lies beside it.
LIFT = 3e-5


def rounded(x: Column, digits: int = 4, lift: float = 0.0) -> Column:
    """Half-up rounding by floor, which any engine does alike; ``lift`` moves the threshold off exact halves."""
    return F.floor(x * 10**digits + (0.5 + lift)) / F.lit(float(10**digits))


def ratio(part: Column, whole: Column, empty: Column | None = None) -> Column:
    """``part / whole``; ``empty`` (null by default) if there is no whole."""
    return F.when(whole > 0, part / whole).otherwise(empty if empty is not None else F.lit(None).cast("double"))


def json_object(text: Column | str) -> Column:
    """JSON text parsed once, as a variant; null if it is none."""
    return F.try_parse_json(text)


def json_text(parsed: Column, *keys: str) -> Column:
    """The first of the keys that a parsed object holds, as text; null if it holds none."""
    return F.coalesce(*(F.try_variant_get(parsed, f"$.{k}", "string") for k in keys))


def json_number(parsed: Column, *keys: str) -> Column:
    """The first of the keys that holds a number, as a double; null if none does."""
    return F.coalesce(*(json_text(parsed, k).try_cast("double") for k in keys))


def json_flag(parsed: Column, *keys: str) -> Column:
    """The first of the keys that holds a truth value; null if none does."""
    return F.coalesce(*(json_text(parsed, k).try_cast("boolean") for k in keys))
