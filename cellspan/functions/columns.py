"""Scalar column functions. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that name the absence of a cell type.
STRICT_PLACEHOLDERS = ("NA", "Unassigned", "requires_review")
CANONICAL_PLACEHOLDERS = (
    "", "na", "nan", "none", "n/a", "unknown", "unannotated", "unassigned",
    "requires_review", "requires review",
)
# An include flag counts as set.
TRUTHY = ("1", "true", "yes")


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def int_div(value, by: int | Column) -> Column:
    """Integer division (truncating; callers pass non-negative positions)."""
    return F.call_function("div", _col(value), by if isinstance(by, Column) else F.lit(by).cast("long"))


def sanitize_label(label) -> Column:
    """Runs of characters outside ``[A-Za-z0-9._-]`` become ``_``; edge ``_`` go; empty is an error."""
    clean = F.btrim(F.regexp_replace(_col(label), r"[^A-Za-z0-9._-]+", "_"), F.lit("_"))
    return F.when(F.length(clean) > 0, clean).otherwise(
        F.raise_error(F.concat(F.lit("label has no usable character: "), _col(label)))
    )


def safe_ratio(numerator, denominator) -> Column:
    """Ratio as double, null when the denominator is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def safe_percent(numerator, denominator) -> Column:
    return F.try_divide(F.lit(100.0) * _col(numerator).cast("double"), _col(denominator).cast("double"))


def overlap_length(start_a, end_a, start_b, end_b) -> Column:
    """Shared bases of two half-open intervals, never negative."""
    shared = F.least(_col(end_a), _col(end_b)) - F.greatest(_col(start_a), _col(start_b))
    return F.greatest(shared, F.lit(0))


def overlap_fraction(start_a, end_a, start_b, end_b) -> Column:
    """Shared bases as a fraction of the first interval."""
    return overlap_length(start_a, end_a, start_b, end_b) / (_col(end_a) - _col(start_a))


def bin_index(position, size: int) -> Column:
    return int_div(position, size)


def is_bin_aligned(start, size: int) -> Column:
    return _col(start) % F.lit(size).cast("long") == 0


def has_any_prefix(name, prefixes: Iterable[str]) -> Column:
    """Upper-cased ``name`` starts with any of the upper-cased ``prefixes``."""
    upper = F.upper(_col(name))
    test = F.lit(False)
    for prefix in prefixes:
        test = test | upper.startswith(prefix.upper())
    return test


def clip(value, limit: float) -> Column:
    """Limit to ``[-limit, limit]``; null stays null."""
    v = _col(value)
    return F.when(v > limit, F.lit(float(limit))).when(v < -limit, F.lit(-float(limit))).otherwise(v)


def sha256_hex(value) -> Column:
    return F.sha2(_col(value).cast("string"), 256)


def md5_hex(value) -> Column:
    return F.md5(_col(value).cast("string"))


def sha1_token(value, length: int = 10) -> Column:
    return F.substring(F.sha1(_col(value).cast("string")), 1, length)


def weight_tag(weight) -> Column:
    """Six significant digits without trailing zeros, ``.`` written ``p``: ``0.2`` -> ``0p2``."""
    w = _col(weight).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(5) - F.floor(F.log10(F.abs(w))))
    rounded = F.when(w == 0, F.lit(0.0)).otherwise(F.round(w * scale, 0) / scale)
    text = rounded.cast("decimal(30,15)").cast("string")
    return F.replace(F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", ""), F.lit("."), F.lit("p"))


def split_labels(text) -> Column:
    """Comma list to array, empty items dropped."""
    return F.filter(F.split(_col(text), ","), lambda x: F.length(x) > 0)


def join_labels(labels) -> Column:
    return F.array_join(F.array_sort(_col(labels)), ",")


def is_placeholder(label, mode: str = "canonical") -> Column:
    """``strict``: case-sensitive short set; ``canonical``: trimmed, lower-cased full set; null counts."""
    c = _col(label)
    if mode == "strict":
        return c.isin(*STRICT_PLACEHOLDERS)
    if mode == "canonical":
        return F.lower(F.trim(F.coalesce(c, F.lit("")))).isin(*CANONICAL_PLACEHOLDERS)
    raise ValueError(f"unknown placeholder mode {mode!r}")


def first_present(*columns) -> Column:
    """First non-null of a fallback chain (e.g. cohort, then sample, then id prefix)."""
    return F.coalesce(*[_col(c) for c in columns])


def is_truthy(flag) -> Column:
    return F.lower(F.trim(F.coalesce(_col(flag).cast("string"), F.lit("")))).isin(*TRUTHY)
