"""Scalar functions on text, maps and records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_get(m: Column | str, key: str) -> Column:
    """Value of a map under ``key``; null when absent."""
    return _c(m)[key]


def decimal_mul(a: Column | str, b: Column | str) -> Column:
    """Product of two amounts given as text, as text with four decimals."""
    return (_c(a).try_cast("decimal(16,2)") * _c(b).try_cast("decimal(16,2)")).cast("string")


def first_token(text: Column | str, sep: str = " ") -> Column:
    """Text before the first ``sep``."""
    return F.substring_index(_c(text), sep, 1)


def join_set(values: Column | str) -> Column:
    """A set of texts in sorted order, joined by commas."""
    return F.array_join(F.array_sort(_c(values)), ",")


def is_empty(text: Column | str) -> Column:
    """Null or empty text."""
    return F.coalesce(_c(text), F.lit("")) == ""


def round3(x: Column | str) -> Column:
    """Round half up to three decimals."""
    return F.round(_c(x), 3)


def negate_amount(amount: Column | str) -> Column:
    """Amount text with its sign turned."""
    return (-_c(amount).try_cast("decimal(38,4)")).cast("string")


def md5_key(key: Column | str) -> Column:
    """Hex md5 of a row key."""
    return F.md5(_c(key))


def dim_cache_key(table: Column | str, key: Column | str) -> Column:
    """``table:key``."""
    return F.concat_ws(":", table if isinstance(table, Column) else F.lit(table), _c(key))


def keep_keys(m: Column | str, csv: Column | str) -> Column:
    """Keep the map entries whose key is in a comma list."""
    names = F.split(_c(csv), ",")
    return F.map_filter(_c(m), lambda k, _: F.array_contains(names, k))


def merge_objects(left: Column | str, right: Column | str) -> Column:
    """Shallow merge of two maps; the right one wins."""
    l, r = _c(left), _c(right)
    return F.map_concat(F.map_filter(l, lambda k, _: ~F.map_contains_key(r, k)), r)


def prefix_keys(m: Column | str, prefix: str) -> Column:
    """Put ``prefix`` before every key of a map."""
    return F.transform_keys(_c(m), lambda k, _: F.concat(F.lit(prefix), k))


def snake(name: str) -> str:
    """camelCase to snake_case."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def camel(name: str) -> str:
    """snake_case to camelCase."""
    head, *rest = name.split("_")
    return head + "".join(p.capitalize() for p in rest)


def to_json_snake(df: DataFrame, hidden: tuple[str, ...] = ()) -> Column:
    """One JSON text per row with snake_case names; hidden columns are left out."""
    return F.to_json(F.struct(*[F.col(c).alias(snake(c)) for c in df.columns if c not in hidden]))


def snake_to_camel(df: DataFrame) -> DataFrame:
    """Rename all columns to camelCase."""
    return df.toDF(*[camel(c) for c in df.columns])
