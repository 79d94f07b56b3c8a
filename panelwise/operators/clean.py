"""Row cleaning, validation and column housekeeping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from panelwise.functions import cleaning


def coerce(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: cleaning.to_number(F.col(c)) for c in columns})


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def drop_sentinel_rows(df: DataFrame, temp: str, precip: str) -> DataFrame:
    """Keep rows with a real temperature and a real rainfall; NULL counts as not real."""
    return df.filter((F.col(temp) > cleaning.SENTINEL_FLOOR) & (F.col(precip) >= 0))


def null_sentinels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: cleaning.null_if_sentinel(F.col(c)) for c in columns})


def with_day(df: DataFrame, source: str, day: str = "obs_date") -> DataFrame:
    """Parse YYYYMMDD, drop what is no day, add year and month."""
    parsed = df.withColumn(day, cleaning.parse_day(F.col(source))).dropna(subset=[day])
    return parsed.withColumns({"year": F.year(day), "month": F.month(day)})


def with_validity(df: DataFrame, year: str, code: str, flag: str = "is_valid") -> DataFrame:
    """Mark rows with a four-digit year and a three-letter code; both are trimmed."""
    ok = cleaning.is_year(F.col(year)) & cleaning.is_code(F.col(code))
    return df.withColumns({flag: ok, year: F.trim(year), code: F.trim(code)})


def split_valid(df: DataFrame, year: str, code: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected)."""
    flagged = with_validity(df, year, code)
    return (
        flagged.filter("is_valid").drop("is_valid"),
        flagged.filter(~F.col("is_valid")).drop("is_valid"),
    )


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; unknown names are no error."""
    return df.withColumnsRenamed(dict(names))


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower case, blanks to underscores, brackets removed."""
    return df.toDF(*[re.sub(r"[()]", "", c.lower().replace(" ", "_")) for c in df.columns])


def first_present(df: DataFrame, names: Sequence[str], parts: Sequence[str] = ()) -> str:
    """The first of ``names`` that exists, else the first column containing all ``parts``."""
    for name in names:
        if name in df.columns:
            return name
    if parts:
        for column in df.columns:
            if all(p in column.lower() for p in parts):
                return column
    raise ValueError(f"none of {list(names)} in {df.columns}")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in exclude
    ]


def round_columns(
    df: DataFrame, digits: int, columns: Sequence[str] | None = None, half_even: bool = False
) -> DataFrame:
    """Round the given columns, or every floating-point one."""
    chosen = columns or [c for c, t in df.dtypes if t in ("double", "float")]
    fn = F.bround if half_even else F.round
    return df.withColumns({c: fn(F.col(c), digits) for c in chosen})


def contains_tag(column: str, tag: str) -> Column:
    """Condition; a NULL text does not contain the tag."""
    return F.coalesce(F.col(column).contains(tag), F.lit(False))
