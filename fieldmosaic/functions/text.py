"""Name and text clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fieldmosaic.functions.binding import let

# Phrases cut from dataset titles, and the name limits of the store.
TITLE_PHRASES = (" - 農業資料開放平臺", "農地空間圖")
MAX_CHARS = 21
MAX_BYTES = 63

WORD = r"\p{L}\p{N}_"
BLANK = r"\p{Z}\s\x1c-\x1f\x85"


def strip_blank(text: Column) -> Column:
    """Trim every kind of white space, not only the plain blank."""
    return F.regexp_replace(text, rf"^[{BLANK}]+|[{BLANK}]+$", "")


def _cut(text: Column, max_bytes: Column) -> Column:
    def longest(head: Column) -> Column:
        fits = lambda k: F.octet_length(F.substring(head, F.lit(1), k)) <= max_bytes
        return F.substring(head, F.lit(1), F.array_max(F.filter(F.sequence(F.lit(0), F.lit(MAX_CHARS)), fits)))

    return let(text, lambda t: F.when(F.length(t) > MAX_CHARS, let(F.substring(t, 1, MAX_CHARS), longest)).otherwise(t))


def clean_table_name(title: Column) -> Column:
    """Title without the known phrases and non-word characters, within the name limits.

    The byte limit applies only to titles over the character limit.
    """
    for phrase in TITLE_PHRASES:
        title = F.replace(title, F.lit(phrase), F.lit(""))
    return _cut(F.regexp_replace(title, f"[^{WORD}]", ""), F.lit(MAX_BYTES))


def short_filename(path: Column) -> Column:
    """Base name of a path; long stems are cut, the extension is kept."""
    def parts(base: Column) -> Column:
        extension = F.regexp_extract(base, r"(?s)^\.*[^.].*(\.[^.]*)$", 1)
        return F.struct(base.alias("base"), extension.alias("ext"))

    def shorten(p: Column) -> Column:
        stem = F.substring(p.base, F.lit(1), F.length(p.base) - F.length(p.ext))
        return F.concat(_cut(stem, F.lit(MAX_BYTES) - F.octet_length(p.ext)), p.ext)

    return let(let(F.substring_index(path, "/", -1), parts), shorten)


def file_stem(name: Column) -> Column:
    """File name without its last extension, used as the version of a boundary file."""
    return F.regexp_replace(F.substring_index(name, "/", -1), r"(?<=[^.])\.[^.]*$", "")


def clean_string(text: Column) -> Column:
    """Lower-case text without punctuation; what is missing becomes an empty string."""
    kept = F.regexp_replace(text.cast("string"), f"[^{WORD}{BLANK}]", "")
    return F.coalesce(strip_blank(F.lower(kept)), F.lit(""))


def process_string(text: Column) -> Column:
    """Lower case with blanks as underscores."""
    return F.replace(F.lower(text), F.lit(" "), F.lit("_"))


def truncate_text(text: Column, limit: int = 15) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def parse_thousands(text: Column) -> Column:
    """Number text with thousands commas as a double, null where it is not a number."""
    return F.replace(strip_blank(text), F.lit(","), F.lit("")).try_cast("double")


def sanitize_column(name: str) -> str:
    """A column name without blanks, dots and dashes."""
    for mark in " .-":
        name = name.replace(mark, "_")
    return name
