"""Guarded extraction from one parsed VARIANT column.

A guard takes alias paths in order; a member of the wrong JSON type, range or length counts
as absent. JSON null and missing members are alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX, LONG_MAX = 2147483647, 9223372036854775807


def _each(v: Column, paths: tuple[str, ...], one) -> Column:
    found = []
    for p in paths:
        node = F.try_variant_get(v, p, "variant")
        found.append(one(F.schema_of_variant(node), F.try_variant_get(v, p, "string")))
    return F.coalesce(*found) if len(found) > 1 else found[0]


def text(v: Column, most: int, *paths: str, keep_empty: bool = False) -> Column:
    """A JSON string of at most ``most`` characters; empty is absent unless kept."""
    return _each(v, paths, lambda kind, s: F.when((kind == "STRING") & (F.char_length(s) <= most), s if keep_empty else F.nullif(s, F.lit(""))))


def _plain(s: Column) -> Column:
    return F.trim(s)


def integer(v: Column, *paths: str, most: int = INT_MAX) -> Column:
    """A JSON integer or a string of one, within -(most + 1) .. most; 4.0 is no integer."""
    kind_ok = lambda kind: kind.isin("BIGINT", "STRING")
    value = lambda s: _plain(s).try_cast("decimal(38,0)")
    return _each(v, paths, lambda kind, s: F.when(kind_ok(kind) & _plain(s).rlike(r"^[+-]?[0-9]+\z") & value(s).between(-most - 1, most), value(s).cast("long")))


def double(v: Column, *paths: str) -> Column:
    """A JSON number or a string of a decimal or scientific number that is finite."""

    def one(kind: Column, s: Column) -> Column:
        t = _plain(s)
        decimal = t.rlike(r"^[+-]?([0-9]{1,308}([.][0-9]*)?|[.][0-9]+)\z")
        scientific = t.rlike(r"^[+-]?[0-9]+([.][0-9]+)?[eE][+-]?[0-9]{1,3}\z")
        number = t.try_cast("double")
        fine = (kind.isin("BIGINT", "DOUBLE", "STRING") | kind.startswith("DECIMAL")) & (decimal | scientific) & (F.abs(number) <= 1.7976931348623157e308)
        return F.when(fine, number)

    return _each(v, paths, one)


def flag(v: Column, *paths: str) -> Column:
    """1 or 0 of true, false, 1, 0, as JSON value or as string in any case; else null."""

    def one(kind: Column, s: Column) -> Column:
        t = F.lower(F.trim(s))
        return F.when(kind.isin("BOOLEAN", "BIGINT", "STRING"), F.when(t.isin("true", "1"), 1).when(t.isin("false", "0"), 0))

    return _each(v, paths, one)


def array_text(v: Column, *paths: str) -> Column:
    """The JSON text of an array; other types are absent."""
    return F.coalesce(*(F.when(F.schema_of_variant(F.try_variant_get(v, p, "variant")).startswith("ARRAY"), F.to_json(F.try_variant_get(v, p, "variant"))) for p in paths))


# Helpers of the row transforms, which read JSON more leniently than the guards above.


def lenient_text(v: Column, path: str) -> Column:
    """A JSON string; empty is absent."""
    return F.nullif(present_text(v, path), F.lit(""))


def present_text(v: Column, path: str) -> Column:
    """A JSON string, empty included."""
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))


def lenient_long(v: Column, path: str) -> Column:
    """An integral JSON number (also 4.0) or a string of an integer."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    s = F.try_variant_get(v, path, "string")
    n = s.try_cast("decimal(38,10)")
    number = (kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE") | ((kind == "STRING") & s.rlike(r"^[+-]?[0-9]+\z"))
    return F.when(number & (n == F.floor(n)) & n.between(-LONG_MAX - 1, LONG_MAX), n.cast("long"))


def lenient_double(v: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    s = F.try_variant_get(v, path, "string")
    return F.when(kind.isin("BIGINT", "DOUBLE", "STRING") | kind.startswith("DECIMAL"), s.try_cast("double"))


def bool_flag(v: Column, path: str) -> Column:
    """1 for true or a non-zero integer, else 0; the string "true" is 0."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    s = F.try_variant_get(v, path, "string")
    return F.when((kind == "BOOLEAN") & (s == "true"), 1).when((kind == "BIGINT") & (s != "0"), 1).otherwise(0)


def instant(text_: Column) -> Column:
    """A timestamp with a mandatory offset, else null."""
    return F.when(text_.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)\z"), F.try_to_timestamp(text_))


def lenient_instant(text_: Column) -> Column:
    """With an offset if there is one, else the first 19 characters read as UTC."""
    return F.coalesce(instant(text_), F.try_to_timestamp(F.left(text_, F.lit(19))))


def lenient_time(v: Column, path: str) -> Column:
    return instant(present_text(v, path))
