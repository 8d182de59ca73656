"""Query parameters of request URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fieldmosaic.functions.binding import let


def _encode(text: Column) -> Column:
    """Percent-encoding as a query string wants it: blanks as +, tilde kept, asterisk not."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def keep_query(url: Column, replaced: list[str]) -> Column:
    """struct<head, kept, fragment>: the URL without the parameters that get new values.

    Names match in any case. Parameters with an empty value are dropped, repeated ones keep
    all their values in the place of the first. Text that is no valid percent-encoding is taken as it is.
    """
    fragment = F.regexp_extract(url, r"(#.*)$", 1)
    plain = F.regexp_replace(url, r"#.*$", "")
    head = F.substring_index(plain, "?", 1)
    query = F.when(F.contains(plain, F.lit("?")), F.substring(plain, F.length(head) + 2, F.length(plain))).otherwise("")
    taken = F.array(*[F.lit(name.lower()) for name in replaced])

    def pair(text: Column) -> Column:
        name = F.substring_index(text, "=", 1)
        value = F.substring(text, F.length(name) + 2, F.length(text))
        return F.struct(F.coalesce(F.try_url_decode(name), name).alias("k"), F.coalesce(F.try_url_decode(value), value).alias("v"))

    def regroup(kept: Column) -> Column:
        names = F.array_distinct(F.transform(kept, lambda p: p.k))
        grouped = F.flatten(F.transform(names, lambda name: F.filter(kept, lambda p: p.k == name)))
        return F.transform(grouped, lambda p: F.concat(_encode(p.k), F.lit("="), _encode(p.v)))

    pairs = F.transform(F.split(query, "&"), pair)
    kept = F.filter(pairs, lambda p: (p.v != "") & ~F.array_contains(taken, F.lower(p.k)))
    return F.struct(head.alias("head"), let(kept, regroup).alias("kept"), fragment.alias("fragment"))


def add_query(kept: Column, params: dict[str, Column]) -> Column:
    """URL of a `keep_query` struct with new parameters at the end of its query."""
    new = F.array(*[
        F.concat(_encode(F.lit(name)), F.lit("="), _encode(value.cast("string"))) for name, value in params.items()
    ])
    return F.concat(kept.head, F.lit("?"), F.array_join(F.concat(kept.kept, new), "&"), kept.fragment)


def rewrite_query(url: Column, params: dict[str, Column]) -> Column:
    """URL with the parameters set: old spellings in any case go, new ones follow at the end."""
    return let(keep_query(url, list(params)), lambda kept: add_query(kept, params))
