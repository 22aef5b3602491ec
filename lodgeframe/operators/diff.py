"""Column-by-column comparison of two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.session import broadcast_if_small, cut_lineage


def diff_versions(
    old: DataFrame,
    new: DataFrame,
    key: str = schemas.LISTING_KEY,
    columns: Sequence[str] = tuple(schemas.COMPARE_COLUMNS),
    label: str | None = "property_name",
    include_unchanged: bool = False,
) -> DataFrame:
    """``(key, label, changed_fields)`` for keys in both versions, fields in the given order.

    Rows without a change are left out unless ``include_unchanged``. Only the compared columns are
    read; NULL equals NULL.
    """
    wanted = list(dict.fromkeys([key, *columns]))
    o = old.select(*wanted).alias("o")
    n = new.select(*dict.fromkeys([*wanted, *([label] if label else [])])).alias("n")
    differs = [F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in columns]
    out = [F.col(f"n.{key}").alias(key)]
    if label:
        out.append(F.col(f"n.{label}").alias(label))
    out.append(F.array_compact(F.array(*differs)).alias("changed_fields"))
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}")).select(*out)
    return joined if include_unchanged else joined.where(F.size("changed_fields") > 0)


def _fingerprint(columns: Sequence[str]) -> Column:
    """16 bytes that tell rows apart. NULLs are hashed as flags, as the hash itself passes them over."""
    missing = [F.col(c).isNull() for c in columns]
    return F.struct(*[F.xxhash64(F.lit(seed), *missing, *columns).alias(f"h{seed}") for seed in (1, 2)])


def diff_wide_versions(
    old: DataFrame, new: DataFrame, key: str = schemas.LISTING_KEY, columns: Sequence[str] = tuple(schemas.COMPARE_COLUMNS), label: str | None = "property_name"
) -> DataFrame:
    """The changed rows of ``diff_versions`` where rows are wide and few of them change.

    A first join shuffles the key and 16 bytes of a row. Only rows whose fingerprints differ are then compared column by
    column: their keys go to the scans as a broadcast if they are counted as few, so that other rows are not shuffled.
    """
    prints = [side.select(key, _fingerprint(columns).alias("_print")) for side in (old, new)]
    other = prints[1].select(F.col(key).alias("_key"), F.col("_print").alias("_other"))
    changed = prints[0].join(other, F.col(key) == F.col("_key")).where(F.col("_print") != F.col("_other")).select(key).distinct()
    changed = broadcast_if_small(cut_lineage(changed))
    return diff_versions(*(side.join(changed, key, "left_semi") for side in (old, new)), key, columns, label)
