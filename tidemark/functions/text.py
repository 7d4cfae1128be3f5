"""Text expressions. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accent map of the place canonicaliser. Capitals outside it (for instance the
# other diaereses) become blanks.
PLACE_ACCENTED = "ÁÉÍÓÚÜÑÀÈÌÒÙÂÊÎÔÛ"
PLACE_PLAIN = "AEIOUUNAEIOUAEIOU"
# Words that only mark a capital district.
PLACE_DISTRICT_WORDS = r"\b(D C|DC|DISTRITO)\b"
# What becomes a blank, in this order.
PLACE_BLANKS = (r"\([^)]*\)", r"[^A-Z0-9 ]", PLACE_DISTRICT_WORDS, r"\s+")

# Labels of missing and of rare categories.
UNKNOWN = "DESCONOCIDO"
OTHER = "OTRO"
NO_DATA = "SIN DATO"


def canonical_place(col: Column, accented: str = PLACE_ACCENTED,
                    plain: str = PLACE_PLAIN) -> Column:
    """Canonical spelling of a place name; apply it to both sides of a join."""
    out = F.translate(F.upper(F.trim(col)), accented, plain)
    for pattern in PLACE_BLANKS:
        out = F.regexp_replace(out, pattern, " ")
    return F.trim(out)


def pad_code(col: Column, width: int = 5) -> Column:
    """Left-pad a code with zeros; longer codes are cut to ``width``."""
    return F.lpad(F.trim(col), width, "0")


def homologate(col: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """First matching LIKE pattern gives the label; without a match the value stays."""
    out = None
    for pattern, label in rules:
        hit = col.like(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return col if out is None else out.otherwise(col)


def clean_category(col: Column, unknown: str = UNKNOWN) -> Column:
    return F.upper(F.trim(F.coalesce(col.cast("string"), F.lit(unknown))))


def keep_categories(col: Column, allowed: Iterable[str], other: str = OTHER) -> Column:
    """Values outside a frozen list become ``other`` (the list is bounded by its training cap)."""
    return F.when(col.isin(list(allowed)), col).otherwise(F.lit(other))


def label_or_missing(col: Column, missing: str = NO_DATA) -> Column:
    return F.coalesce(col.cast("string"), F.lit(missing))


def cp1252_text(raw: Column) -> Column:
    """Decode bytes as Windows-1252, with U+FFFD for the bytes it leaves undefined.

    The charset equals ISO-8859-1 but for bytes 0x80-0x9F, so a plain decode plus a
    ``translate`` of that range is enough and needs no legacy charset switch.
    """
    control = "".join(map(chr, range(0x80, 0xA0)))
    printable = bytes(range(0x80, 0xA0)).decode("cp1252", errors="replace")
    return F.translate(F.decode(raw, "ISO-8859-1"), control, printable)
