from tidemark.functions.names import normalize_columns, normalize_name, rename_map
from tidemark.functions.numbers import (
    band_by_cuts, half_even, half_up, null_unless, presence_ratio, rate_pct, risk_band, to_double,
    to_long)
from tidemark.functions.text import (
    canonical_place, clean_category, cp1252_text, homologate, keep_categories, label_or_missing,
    pad_code)

__all__ = [
    "band_by_cuts", "canonical_place", "clean_category", "cp1252_text", "half_even", "half_up",
    "homologate", "keep_categories", "label_or_missing", "normalize_columns", "normalize_name",
    "null_unless", "pad_code", "presence_ratio", "rate_pct", "rename_map", "risk_band",
    "to_double", "to_long",
]
