"""Data-quality checks for the declared keys and constraints."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtax import schemas
from mailtax.functions.expressions import packed_id
from mailtax.operators.lines import Tables


def referential_checks(
    t: Tables,
    *,
    primary_keys: Mapping[str, str] = schemas.PRIMARY_KEYS,
    foreign_keys: Iterable[tuple[str, str, str, str]] = tuple(schemas.FOREIGN_KEYS),
    not_null: Mapping[str, list[str]] = schemas.NOT_NULL,
    defaults: Mapping[str, Mapping[str, object]] = schemas.DEFAULTS,
) -> DataFrame:
    """One row per check: (table, check, key, violations).

    ``primary_key``  rows beyond the first of each key value
    ``foreign_key``  rows whose key is missing in the parent (NULL keys are not checked)
    ``not_null``     rows with NULL
    ``default``      rows that still hold the default value (counted, not wrong by itself)
    """
    found = [_duplicates(t[table], table, key) for table, key in primary_keys.items()]
    found += [_orphans(t, *fk) for fk in foreign_keys]
    for table in {**not_null, **defaults}:
        found.append(_values(t[table], table, not_null.get(table, []), defaults.get(table, {})))
    return reduce(DataFrame.unionByName, found)


def _report(df: DataFrame, table: str, check: str, key: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(key).alias("key_name"),
        F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"),
    )


def _short(df: DataFrame, key: str) -> Column:
    """The key as it is shuffled: ids that are texts as bytes."""
    return (packed_id(F.col(key)) if dict(df.dtypes)[key] == "string" else F.col(key)).alias("key")


def _duplicates(df: DataFrame, table: str, key: str) -> DataFrame:
    extra = df.groupBy(_short(df, key)).agg((F.count("*") - 1).alias("extra"))
    return _report(extra.agg(F.sum("extra").alias("violations")), table, "primary_key", key)


def _orphans(t: Tables, table: str, key: str, parent: str, parent_key: str) -> DataFrame:
    rows, owners = t[table], t[parent]
    if dict(rows.dtypes)[key] == dict(owners.dtypes)[parent_key]:
        child, known = _short(rows, key), _short(owners, parent_key)
    else:  # compared as Spark compares the two types
        child, known = F.col(key).alias("key"), F.col(parent_key).alias("key")
    used = rows.where(F.col(key).isNotNull()).groupBy(child).agg(F.count("*").alias("row_count"))
    orphans = used.join(owners.select(known), "key", "left_anti")
    return _report(
        orphans.agg(F.sum("row_count").alias("violations")), table, "foreign_key", f"{key} -> {parent}.{parent_key}"
    )


def _values(df: DataFrame, table: str, required: list[str], defaults: Mapping[str, object]) -> DataFrame:
    """All per-row checks of a table in one pass over it."""
    checks = [("not_null", c, F.col(c).isNull()) for c in required]
    checks += [("default", c, F.col(c) == F.lit(v)) for c, v in defaults.items()]
    counts = df.agg(*[F.count_if(hit).alias(f"c{i}") for i, (_, _, hit) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(check).alias("check_name"),
                F.lit(key).alias("key_name"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, (check, key, _) in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows))
