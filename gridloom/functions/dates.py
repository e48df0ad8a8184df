"""Date and relative-time texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.text import clean_ascii, safe_name, strip

# Accepted date layouts, tried in this order.
DATE_LAYOUTS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
]


def parse_date(col: Column) -> Column:
    return F.coalesce(
        *[F.when(col.rlike(shape), F.try_to_date(col, layout)) for shape, layout in DATE_LAYOUTS]
    )


def format_date(col: Column, form_variant: bool = False) -> Column:
    """``yyyy-MM-dd`` text where a layout fits, else the cleaned text.

    ``form_variant`` keeps outer white space (which then fits no layout) and falls back to a
    file-safe name.
    """
    text = col.cast("string") if form_variant else strip(col.cast("string"))
    fallback = safe_name(col) if form_variant else clean_ascii(col)
    return F.coalesce(F.date_format(parse_date(text), "yyyy-MM-dd"), fallback)


def utc_text(moment: Column, layout: str) -> Column:
    """A moment as UTC wall-clock text, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), layout)


def relative_minutes(col: Column) -> Column:
    """Minutes after the start for texts such as ``T0``, ``T0+5``, ``T+1h30``, ``T0 + 5min``."""
    text = F.lower(F.regexp_replace(F.coalesce(col, F.lit("")), r"\s+", ""))
    shape = r"^t0?(?:([+-])(?:(\d+)h)?(?:(\d+)(?:min|mn|m)?)?)?$"
    hours = F.coalesce(F.regexp_extract(text, shape, 2).try_cast("long"), F.lit(0))
    minutes = F.coalesce(F.regexp_extract(text, shape, 3).try_cast("long"), F.lit(0))
    sign = F.when(F.regexp_extract(text, shape, 1) == "-", -1).otherwise(1)
    return F.when(text.rlike(shape), (sign * (hours * 60 + minutes)).cast("long"))
