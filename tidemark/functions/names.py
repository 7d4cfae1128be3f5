"""Column names: snake-case normalisation and dictionary renames (schema only, no data cost)."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

# Accented letters and the plain letters they become; all else that a name may not
# hold.
PLAIN_LETTERS = str.maketrans({
    "á": "a", "ä": "a", "â": "a", "à": "a",
    "é": "e", "ë": "e", "ê": "e", "è": "e",
    "í": "i", "ï": "i", "î": "i", "ì": "i",
    "ó": "o", "ö": "o", "ô": "o", "ò": "o",
    "ú": "u", "ü": "u", "û": "u", "ù": "u",
    "ñ": "n",
})
NOT_IN_NAMES = "[^a-z0-9_]+"


def normalize_name(name: str) -> str:
    """``'  Año Académico (1) '`` -> ``'ano_academico_1'``; other runs become one underscore."""
    plain = str(name).strip().lower().translate(PLAIN_LETTERS)
    return re.sub(NOT_IN_NAMES, "_", plain).strip("_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalise every column name; two names that fall together are an error."""
    names = [normalize_name(c) for c in df.columns]
    clashes = {n: [c for c in df.columns if normalize_name(c) == n]
               for n, times in Counter(names).items() if times > 1}
    if clashes:
        raise ValueError(f"column names that normalise to the same name: {clashes}")
    return df.toDF(*names)


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that are present; absent ones are ignored."""
    return df.withColumnsRenamed(mapping)
