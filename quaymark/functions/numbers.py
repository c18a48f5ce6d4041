"""Number parsers, buckets and scores (inventory N1-N20). Pure Column to Column."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Cols = Column | str


def _c(x: Cols) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _try_double(x: Column) -> Column:
    """A plain decimal number; Spark alone would also take '1d' or '5f'."""
    t = F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    return F.when(t.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))


def is_number(x: Column) -> Column:
    """Whether the column is numeric or boolean: its type is known when the plan is made, so the branch costs nothing."""
    return F.typeof(x).rlike("^(tinyint|smallint|int|bigint|float|double|boolean|decimal.*)$")


def _first_number(x: Column, text: Column) -> Column:
    found = F.nullif(F.regexp_extract(text, r"\d+(?:\.\d+)?", 0), F.lit("")).try_cast("double")
    return F.when(is_number(x), x.try_cast("double")).otherwise(found)


def parse_number(x: Cols) -> Column:
    """A number as it is; in a string commas go, then the first unsigned number anywhere."""
    return _first_number(_c(x), F.replace(_c(x).cast("string"), F.lit(","), F.lit("")))


def parse_first_number(x: Cols) -> Column:
    """As N1 with commas kept, so "1,200" is 1."""
    return _first_number(_c(x), _c(x).cast("string"))


def _money(x: Cols) -> Column:
    t = F.lower(_c(x).cast("string"))
    for sign in (",", "$", "hkd"):
        t = F.replace(t, F.lit(sign), F.lit(""))
    return F.when(is_number(_c(x)), _c(x).try_cast("double")).otherwise(_try_double(t))


def money_or_null(x: Cols) -> Column:
    """A number without commas, dollar signs and "hkd"; "nan" is a number here."""
    nan = ~is_number(_c(x)) & F.lower(F.trim(_c(x).cast("string"))).rlike("^[+-]?nan$")
    return F.when(nan, F.lit(float("nan"))).otherwise(_money(x))


def whole_money_or_null(x: Cols) -> Column:
    """As N5, truncated toward zero."""
    return _money(x).try_cast("bigint")


def int_or_null(x: Cols) -> Column:
    """A number truncated toward zero; a string only if it is a whole number without commas."""
    t = F.regexp_replace(_c(x).cast("string"), r"(?U)^\s+|\s+$", "")
    return F.when(is_number(_c(x)), _c(x).try_cast("double").try_cast("bigint")).otherwise(F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint")))


def bool_pref(x: Cols) -> Column:
    """A boolean as it is, and true for the strings 1, true and yes; else false."""
    kind, text = F.typeof(_c(x)), _c(x).cast("string")
    return F.when(kind == "boolean", F.coalesce(text == "true", F.lit(False))).when(kind == "string", F.coalesce(F.lower(F.trim(text)).isin("1", "true", "yes"), F.lit(False))).otherwise(False)


def bool_or_null(x: Cols) -> Column:
    """Tri-state, of booleans and strings; anything else is null."""
    kind, t = F.typeof(_c(x)), F.lower(F.trim(_c(x).cast("string")))
    known = F.when(t.isin("1", "true", "yes", "y"), True).when(t.isin("0", "false", "no", "n"), False)
    return F.when(kind.isin("boolean", "string"), known)


def positive(x: Cols) -> Column:
    """The value if above zero."""
    return F.when(_c(x) > 0, _c(x))


def price_per_unit(direct: Cols, other: Cols, price: Cols, size: Cols) -> Column:
    """A direct figure, its other spelling, or price over size where the size is above zero."""
    return F.coalesce(_c(direct), _c(other), F.when(_c(size) > 0, _c(price) / _c(size)))


def bucketize(x: Cols, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None, right: bool = False) -> Column:
    """Label of the interval that holds x: [edge, next) or, with ``right``, (edge, next]."""
    out = F.when(_c(x).isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(_c(x) <= edge if right else _c(x) < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def sqft_price_bucket(x: Cols) -> Column:
    """N10."""
    return bucketize(x, (30, 40, 50, 60, 80), ("under_30", "30_to_39_99", "40_to_49_99", "50_to_59_99", "60_to_79_99", "80_plus"), "unknown")


def bedroom_group(x: Cols) -> Column:
    """Studio, "n bedrooms" or "6+ bedrooms" of a truncated count."""
    n = parse_number(x).cast("bigint")
    return F.when(n <= 0, "studio").when(n >= 6, "6+ bedrooms").otherwise(F.concat(n.cast("string"), F.lit(" bedrooms")))


def bedroom_order(x: Cols) -> Column:
    """Sort key of a bedroom group."""
    return F.when(_c(x) == "studio", 0).when(_c(x) == "6+ bedrooms", 99).otherwise(F.coalesce(F.regexp_extract(_c(x), r"^(\d+) bedrooms$", 1).try_cast("int"), F.lit(100)))


def budget_bucket(low: Cols, high: Cols) -> Column:
    """Bucket of the upper bound, or of the lower one where there is none."""
    return bucketize(F.coalesce(_c(high), _c(low)), (10_000, 20_000, 30_000, 50_000, 80_000), ("<10k", "10k-20k", "20k-30k", "30k-50k", "50k-80k", ">=80k"), "unknown")


#: Edges and labels of the price levels and of the buckets of an index text.
LEVELS = (30, 40, 50, 70), ("budget", "affordable", "mid_market", "premium", "luxury")


def price_level(median: Cols) -> Column:
    """The level of a median price per square foot."""
    return bucketize(median, *LEVELS, "unknown")


def midpoint(low: Cols, high: Cols) -> Column:
    """N15."""
    return F.coalesce((_c(low) + _c(high)) / 2, _c(low), _c(high))


def closeness(value: Cols, low: Cols, high: Cols, weight: float, tolerance: float = 0.25) -> Column:
    """Weight, falling linearly to 0 at the tolerance around the midpoint."""
    mid = midpoint(low, high)
    score = F.greatest(F.lit(0.0), 1 - F.abs(_c(value) - mid) / mid / tolerance) * weight
    return F.coalesce(F.when(mid != 0, score), F.lit(0.0))


def around(value: Cols, mid: Cols, weight: float, tolerance: float = 0.25) -> Column:
    """N16 with the midpoint at hand."""
    score = F.greatest(F.lit(0.0), 1 - F.abs(_c(value) - _c(mid)) / _c(mid) / tolerance) * weight
    return F.coalesce(F.when(_c(mid) != 0, score), F.lit(0.0))


def recency(updated: Cols, created: Cols, now: Cols, weight: float = 10, days: float = 7) -> Column:
    """The age part of N17: zero counts as missing."""
    at = F.coalesce(F.nullif(_c(updated), F.lit(0)), F.nullif(_c(created), F.lit(0)))
    return F.coalesce(F.greatest(F.lit(0.0), 1 - (_c(now) - at) / (days * 86400)) * weight, F.lit(0.0))


def format_price(x: Cols) -> Column:
    """N19."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(_c(x), 0)), F.lit("N/A"))


def format_size(x: Cols) -> Column:
    """Whole square feet."""
    return F.coalesce(F.concat(_c(x).cast("bigint").cast("string"), F.lit(" sqft")), F.lit("N/A"))


def listing_score(price: Cols, size: Cols, bedrooms: Cols, updated: Cols, created: Cols, bounds: dict[str, Column], now: int) -> Column:
    """Closeness of price (45), size (25) and bedrooms (20), and up to 10 for the last seven days."""
    near = closeness(price, bounds["min_price"], bounds["max_price"], 45.0) + closeness(size, bounds["min_size"], bounds["max_size"], 25.0)
    return near + closeness(bedrooms, bounds["min_bedrooms"], bounds["max_bedrooms"], 20.0, 1.0) + F.least(F.lit(10.0), recency(updated, created, F.lit(now)))


def nudged_round(x: Cols, digits: int) -> Column:
    """Rounding that agrees across engines on decimal ties; for queries compared with SQL only."""
    return F.round(_c(x) + F.lit(1e-9), digits)


def py_round(x: Cols, digits: int) -> Column:
    """Python's own rounding of doubles, where figures must agree with it to the last digit; in Arrow batches."""

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if v != v else round(v, digits))

    return run(_c(x).cast("double"))
