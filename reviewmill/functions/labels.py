"""Label, status and confidence expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.functions.text import is_blank, strip_ws


def label_value(col: Column, strict: bool = True) -> Column:
    """Parse a label to INT; null when it is not an integer literal.

    ``strict=False`` also reads the ``1.0`` form that a float column prints.
    """
    text = strip_ws(col.cast("string"))
    pattern = r"^[+-]?[0-9]+$" if strict else r"^[+-]?[0-9]+(\.0)?$"
    number = F.regexp_replace(text, r"\.0$", "")
    return F.when(text.rlike(pattern), number.try_cast("int"))


def display_label(col: Column, mapping: dict[int, str] | None = None, default: Column | None = None) -> Column:
    """The display name of 0/1 in any of its int, float and string forms, else ``default``.

    ``default`` is the value's own text unless given.
    """
    text = col.cast("string")
    result = text if default is None else default
    for value, name in sorted((mapping or config.DISPLAY_LABELS).items(), reverse=True):
        result = F.when(text.isin(str(value), f"{value}.0"), F.lit(name)).otherwise(result)
    return result


def invalid_text_mask(col: Column) -> Column:
    return is_blank(col)


def prediction_status(col: Column) -> Column:
    return F.when(is_blank(col), F.lit(config.STATUS_BLANK)).otherwise(F.lit(config.STATUS_OK))


def confidence_level(col: Column, high: float = 0.85, medium: float = 0.65) -> Column:
    sure, fair, weak = config.CONFIDENCE_LEVELS
    return F.when(col >= high, F.lit(sure)).when(col >= medium, F.lit(fair)).when(col.isNotNull(), F.lit(weak))
