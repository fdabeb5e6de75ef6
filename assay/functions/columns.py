"""Scalar building blocks. Every function takes column names or Columns and stays JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_date(value: ColumnLike) -> Column:
    """A date literal from an ISO string, or the given Column."""
    return F.lit(value).cast("date") if isinstance(value, str) else value


def typed(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not parse becomes NULL instead of an error."""
    return df.withColumns({
        name: F.expr(f"try_cast(`{name}` AS {kind})") for name, kind in spec.items()})


def parse_date(col: ColumnLike, formats: Sequence[str]) -> Column:
    """The first format that reads the text as a date wins; NULL when none does.

    The ISO layout is read by a cast, which takes unpadded months and days too.
    """
    text = as_column(col)
    return F.coalesce(*[
        text.try_cast("date") if fmt == "yyyy-MM-dd" else F.try_to_date(text, fmt)
        for fmt in formats
    ])


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(col: ColumnLike, mapping: Mapping[str, str]) -> Column:
    """Value of a small literal mapping, NULL for an unknown key."""
    literal = F.expr("map(" + ", ".join(text(x) for kv in mapping.items() for x in kv) + ")")
    return F.try_element_at(literal, as_column(col))


def standardize(col: ColumnLike, mapping: Mapping[str, str]) -> Column:
    """Upper-case the text and replace long names by their code; other text stays as it is."""
    upper = F.upper(as_column(col))
    return F.coalesce(lookup(upper, mapping), upper)


def categorize(col: ColumnLike, mapping: Mapping[str, str], default: str = "other") -> Column:
    """Bucket of a text by exact lookup."""
    return F.coalesce(lookup(col, mapping), F.lit(default))


def null_if_empty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in cols})


def fill_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def age_at(dob: ColumnLike, as_of: ColumnLike) -> Column:
    """Completed years of 365.25 days."""
    days = F.datediff(as_date(as_of), as_column(dob))
    return F.floor(days / F.lit(365.25)).cast("int")


def years_between(start: ColumnLike, as_of: ColumnLike, scale: int = 2) -> Column:
    """Years of 365.25 days as a rounded double."""
    days = F.datediff(as_date(as_of), as_column(start))
    return F.round(days / F.lit(365.25), scale)


def band(col: ColumnLike, bands: Sequence[tuple]) -> Column:
    """Label of the closed interval ``(low, high, label)`` that holds the value.

    ``high=None`` leaves the interval open. Values in no interval, and NULL, give NULL.
    """
    value = as_column(col)
    out = None
    for low, high, label in bands:
        inside = value >= low if high is None else value.between(low, high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def threshold_band(col: ColumnLike, floors: Sequence[tuple]) -> Column:
    """Label by descending lower limits ``(floor, label)``; ``floor=None`` takes the rest."""
    value = as_column(col)
    out = None
    for floor, label in floors:
        inside = value.isNotNull() if floor is None else value >= floor
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def ratio(num: ColumnLike, den: ColumnLike, scale: int) -> Column:
    """``num/den`` of two non-negative integers, rounded half up on the exact quotient.

    Integer arithmetic keeps the last digit independent of floating point; NULL when ``den``
    is zero.
    """
    n = as_column(num).cast("decimal(38,0)")
    d = as_column(den).cast("decimal(38,0)")
    unit = 10 ** scale
    scaled = F.call_function("div", n * F.lit(2 * unit) + d, F.nullif(d * F.lit(2), F.lit(0)))
    return scaled / F.lit(float(unit))


def clean_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast to double; infinities and NaN become NULL."""
    out = {}
    for c in cols:
        x = F.col(c).cast("double")
        usable = ~F.isnan(x) & ~x.isin(float("inf"), float("-inf"))
        out[c] = F.when(usable, x)
    return df.withColumns(out)


def whole_share(key: ColumnLike, salt: str) -> Column:
    """A repeatable number in [0, 1) per key, from the first 32 bits of an md5."""
    digest = F.md5(F.concat(F.lit(salt), as_column(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
