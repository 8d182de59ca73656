"""Dates in the Gregorian and the ROC (Minguo) calendar.

Built on text patterns plus one guarded cast, so an impossible day never fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ROC_OFFSET = 1911
UNPARSABLE = "0001-01-01"


def roc_to_ad(year: Column) -> Column:
    return F.try_add(year.try_cast("int"), F.lit(ROC_OFFSET))


def roc_digits_to_date(digits: Column) -> Column:
    """Seven digits yyyMMdd of the ROC calendar as a date."""
    year = roc_to_ad(F.substring(digits, 1, 3)).cast("string")
    month, day = F.substring(digits, 4, 2), F.substring(digits, 6, 2)
    return F.concat_ws("-", year, month, day).try_cast("date")


def version_digits(version: Column) -> Column:
    """First run of exactly the last seven digits before a non-digit, or null."""
    found = F.regexp_extract(version, r".*?(\d{7})(?!\d)", 1)
    return F.when(found != "", found)


def _ad(text: Column, pattern: str, month_group: bool, day_group: bool) -> Column:
    month = F.regexp_extract(text, pattern, 2) if month_group else F.lit("1")
    day = F.regexp_extract(text, pattern, 3) if day_group else F.lit("1")
    return F.concat_ws("-", F.regexp_extract(text, pattern, 1), month, day)


def _roc(text: Column, pattern: str, full: bool) -> Column:
    year = roc_to_ad(F.regexp_extract(text, pattern, 1)).cast("string")
    if not full:
        return F.concat_ws("-", year, F.lit("1"), F.lit("1"))
    return F.concat_ws("-", year, F.regexp_extract(text, pattern, 2), F.regexp_extract(text, pattern, 3))


def parse_timestamp(raw: Column) -> Column:
    """Date with clock time, `2024/1/2 03:04:05` or dashes, as timestamp_ntz; else null."""
    pattern = r"^(\d{4})([/-])(\d{1,2})\2(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})$"
    text = F.trim(raw)
    day = F.concat_ws("-", *[F.regexp_extract(text, pattern, g) for g in (1, 3, 4)])
    clock = F.concat_ws(":", *[F.lpad(F.regexp_extract(text, pattern, g), 2, "0") for g in (5, 6, 7)])
    return F.when(text.rlike(pattern), F.concat_ws(" ", day, clock).try_cast("timestamp_ntz"))


def parse_date(raw: Column) -> Column:
    """Date of a text in one of the accepted spellings; 0001-01-01 where none fits.

    Blanks inside are ignored. One to three digits are a ROC year, three groups with a
    short year a ROC date, seven digits a ROC yyyMMdd; four-digit years are Gregorian.
    """
    text = F.replace(raw, F.lit(" "), F.lit(""))
    year = r"^(\d{1,3})$"
    roc = r"^(\d{1,3})[./](\d{1,2})[./](\d{1,2})$"
    slash, dash = r"^(\d{4})/(\d{1,2})/(\d{1,2})$", r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
    packed, month = r"^(\d{4})(\d{2})(\d{2})$", r"^(\d{4})-(\d{1,2})$"
    only_year = r"^(\d{4})年?$"
    spelled = (
        F.when(text.rlike(year), _roc(text, year, False))
        .when(text.rlike(roc), _roc(text, roc, True))
        .when(text.rlike(slash), _ad(text, slash, True, True))
        .when(text.rlike(dash), _ad(text, dash, True, True))
        .when(text.rlike(packed), _ad(text, packed, True, True))
        .when(text.rlike(month), _ad(text, month, True, False))
        .when(text.rlike(only_year), _ad(text, only_year, False, False))
        .try_cast("date")
    )
    packed_roc = F.when(text.rlike(r"^\d{7}$"), roc_digits_to_date(text))
    return F.coalesce(parse_timestamp(raw).cast("date"), packed_roc, spelled, F.lit(UNPARSABLE).cast("date"))
