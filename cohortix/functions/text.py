"""Text, typing and missing-value expressions. All are Spark columns; none runs Python per row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that mean "missing" in user tables (fixed values).
MISSING_TOKENS = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", ".", "-9")

#: What counts as a number in text; without it engines differ on forms like ``1d`` or ``1_0``.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: str | Column) -> Column:
    """The value as text without white space at either end."""
    return F.regexp_replace(col(c).cast("string"), r"^\s+|\s+$", "")


def is_missing(c: str | Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    text = as_text(c)
    return text.isNull() | text.isin(list(tokens))


def null_if_missing(c: str | Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    return F.when(~is_missing(c, tokens), as_text(c))


def to_number(c: str | Column) -> Column:
    """The text as a double; null for what is no number, NaN included."""
    text = col(c).cast("string")  # a cast leaves white space at the ends out
    return F.when(text.rlike(rf"^\s*{NUMBER[1:-1]}\s*$"), text.try_cast("double"))


def to_whole(c: str | Column) -> Column:
    """The text as a bigint; null for what is no whole number."""
    n = to_number(c)
    return F.when(n == F.floor(n), n.try_cast("bigint"))


def to_date(c: str | Column) -> Column:
    text = as_text(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def day_number(c: str | Column) -> Column:
    """Days since 1970-01-01."""
    return F.datediff(col(c).cast("date"), F.lit("1970-01-01").cast("date"))


def column_or_null(columns: Iterable[str], name: str, kind: str = "string") -> Column:
    return F.col(name) if name in set(columns) else F.lit(None).cast(kind)


def info_value(info: str | Column, key: str) -> Column:
    """Value of ``key`` in ``A=1;B=2`` text; '' where the key is absent."""
    return F.regexp_extract(col(info), rf"(?:^|;){key}=([^;]*)", 1)


def extra_map(extra: str | Column) -> Column:
    return F.str_to_map(col(extra), F.lit(";"), F.lit("="))


def without_version(c: str | Column) -> Column:
    """An accession without its ``.N`` version."""
    return F.regexp_replace(col(c), r"\.\d+$", "")


def native_id(family: str | Column | None, sample: str | Column, sep: str = "_") -> Column:
    """The sample's id, or family and id where families are given; a null family counts as 0."""
    if family is None:
        return col(sample)
    return F.concat(F.coalesce(col(family), F.lit("0")), F.lit(sep), col(sample))


def fail_reasons(flags: dict[str, Column], sep: str = ";") -> Column:
    """Names of the true flags, joined; '' where none is."""
    return F.concat_ws(sep, *[F.when(c, F.lit(n)) for n, c in flags.items()])


def header_key(name: str) -> str:
    """A column name as matching sees it: lower case, no white space at the ends, no leading ``#``."""
    return name.strip().lstrip("#").lower()


def long_form(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to rows (ids, name, value), nulls included.

    A generator over an array of structs: expressions on what ``unpivot`` makes do not always compile
    to Java and are then interpreted.
    """
    items = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in columns]
    return df.select(*ids, F.inline(F.array(*items)))
