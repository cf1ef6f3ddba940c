"""Full-snapshot sync: insert, update and delete against the current version of a typed table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from order_analytics.operators import membership, quality
from order_analytics.operators.staging import Stage
from order_analytics.schemas import TableSpec
from order_analytics.sources import snapshots

ACTIONS = snapshots.ACTIONS


def snapshot_changes(
    target: DataFrame, source: DataFrame, key: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """The key and what happens to its row.

    Every matched row is an update unless ``compare`` names the columns that decide it. Only the key travels through the join, and
    two digests of those columns (128 bits) where both sides have them in the same types, else the columns.
    """
    compared = [name for name in compare or [] if name not in key]
    alike = len(compared) < 63 and all(target.schema[name].dataType == source.schema[name].dataType for name in compared)

    def contents(name: str) -> list[str]:
        return [f"{name}_{number}" for number in range(2 if compared and alike else 1)]

    def side(df: DataFrame, name: str) -> DataFrame:
        content = row_digests(compared) if alike else [F.struct(*compared)]
        named = dict(zip(contents(name), content if compared else [F.lit(True)], strict=True))
        return df.select(*key, *[column.alias(label) for label, column in named.items()])

    matched = side(target, "TARGET").join(side(source, "SOURCE"), on=list(key), how="full_outer")
    same = [F.col(before).eqNullSafe(F.col(after)) for before, after in zip(contents("TARGET"), contents("SOURCE"), strict=True)]
    unchanged = reduce(and_, same) if compared else F.lit(False)
    action = (
        F.when(F.col("TARGET_0").isNull(), "INSERT")
        .when(F.col("SOURCE_0").isNull(), "DELETE")
        .when(unchanged, "UNCHANGED")
        .otherwise("UPDATE")
    )
    return matched.select(*key, action.alias("ACTION"))


def row_digests(columns: Sequence[str]) -> list[Column]:
    """Two digests of a row's ``columns``, none of them NULL. Hashes skip NULLs, so which columns are NULL is hashed as well."""
    empty = sum((F.when(F.col(name).isNull(), 1 << place).otherwise(0).cast("bigint") for place, name in enumerate(columns)), F.lit(0))
    return [F.xxhash64(F.lit(salt), empty, *columns) for salt in (1, 2)]


def paired_rows(old: DataFrame, new: DataFrame, key: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """The key, ``ACTION``, and the row before (``OLD``) and after (``NEW``), NULL where there is none, of every key of two snapshots."""
    compared = [name for name in compare if name not in key]

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*key, F.struct(*new.columns).alias(name))

    same = F.struct(F.lit(True), *[F.col(f"OLD.{name}") for name in compared]).eqNullSafe(F.struct(F.lit(True), *[F.col(f"NEW.{name}") for name in compared]))
    action = F.when(F.col("OLD").isNull(), "INSERT").when(F.col("NEW").isNull(), "DELETE").when(same, "UNCHANGED").otherwise("UPDATE")
    joined = side(old, "OLD").join(side(new, "NEW"), on=list(key), how="full_outer")
    return joined.select(*key, action.alias("ACTION"), "OLD", "NEW")


def changed_rows(
    old: DataFrame, new: DataFrame, key: Sequence[str], compare: Sequence[str], group: str | None = None, stage: Stage | None = None
) -> DataFrame:
    """``ACTION``, ``OLD`` and ``NEW`` of the rows that differ.

    With ``group``, a column of the key, and a stage, only digests of all rows travel: rows meet by key in the groups that do not hold
    the same rows before and after, and in no others. So a key that is repeated or has a NULL, whose rows differ even from themselves,
    tells no change in a group that is the same.
    """
    if group is not None:
        if group not in key:
            raise ValueError(f"{group} is no part of the key")
        differ = membership.keep(_differing_groups(old, new, group, list(dict.fromkeys([*key, *compare]))), stage)
        old, new = (membership.inside(rows, differ, F.xxhash64(group)) for rows in (old, new))
    return paired_rows(old, new, key, compare).filter("ACTION <> 'UNCHANGED'").select("ACTION", "OLD", "NEW")


def _differing_groups(old: DataFrame, new: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Hashes of the groups whose rows have other digests before and after; groups that share a hash are taken as one.

    A digest is the sum of the rows' hashes, in halves that cannot overflow; rows after count against those before. Hashes skip
    NULLs, so which columns are NULL is hashed as well.
    """
    empty = sum((F.when(F.col(name).isNull(), 1 << place).otherwise(0).cast("bigint") for place, name in enumerate(columns)), F.lit(0))
    digest = F.xxhash64(empty, *columns)
    halves = {"LOW": digest.bitwiseAND(F.lit(0xFFFFFFFF)), "HIGH": F.shiftright(digest, 32)}

    def side(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(F.xxhash64(group).alias("GROUP"), *[(half * sign).alias(name) for name, half in halves.items()])

    sums = side(old, -1).unionAll(side(new, 1)).groupBy("GROUP").agg(*[F.sum(name).alias(name) for name in halves])
    return sums.filter("LOW <> 0 OR HIGH <> 0").select("GROUP")


def change_summary(changes: DataFrame) -> DataFrame:
    """One row: rows per action, and rows before and after."""
    return changes.agg(*_summary_columns())


def _summary_columns() -> list[Column]:
    return [
        *[F.count_if(F.col("ACTION") == action).alias(f"{action}_ROWS") for action in ACTIONS],
        F.count_if(F.col("ACTION") != "INSERT").alias("TARGET_ROWS"),
        F.count_if(F.col("ACTION") != "DELETE").alias("FINAL_ROWS"),
    ]


def keyed_changes(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """``snapshot_changes`` without columns to compare, and one row: its summary, and ``key_summary`` of the source.

    The rows of a key are counted before they meet the target, so the keys of the source travel once for both. The summary
    holds for keys that are unique, which the other two figures tell.
    """
    counted = source.groupBy(*key).agg(F.count(F.lit(1)).alias("COPIES"))
    matched = target.select(*key, F.lit(True).alias("IN_TARGET")).join(counted, on=list(key), how="full_outer")
    action = F.when(F.col("IN_TARGET").isNull(), "INSERT").when(F.col("COPIES").isNull(), "DELETE").otherwise("UPDATE")
    return matched.select(action.alias("ACTION"), "COPIES").agg(
        *_summary_columns(),
        F.coalesce(F.sum("COPIES"), F.lit(0)).alias("ROWS"),
        F.count_if(F.col("COPIES") > 1).alias("DUPLICATE_KEYS"),
    )


def sync(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    spec: TableSpec,
    compare: Sequence[str] | None = None,
) -> dict[str, int]:
    """Bring the snapshot at ``path`` to the state of ``source``, a complete snapshot.

    The source is written once, as the next version, and everything else reads that: the key gate, the
    comparison with the current version, the row counts. The version is published only when all hold,
    and discarded when ``compare`` shows that nothing changed.
    """
    current = snapshots.current_version(spark, path)
    version, rows = snapshots.write_candidate(source, path)
    with snapshots.candidate(spark, path, version):
        candidate = snapshots.read_version(spark, path, version, spec.schema)
        summary = dict.fromkeys((f"{action}_ROWS" for action in ACTIONS), 0)
        summary |= {"INSERT_ROWS": rows, "TARGET_ROWS": 0, "FINAL_ROWS": rows}
        if current is None:
            keys = key_check(candidate, spec)
        else:
            target = snapshots.read_version(spark, path, current, spec.schema)
            if any(name not in spec.key for name in compare or []):
                keys = key_check(candidate, spec)
                summary = change_summary(snapshot_changes(target, candidate, spec.key, compare)).first().asDict()
            else:
                found = keyed_changes(target, candidate, spec.key).first().asDict()
                keys = {name: found.pop(name) for name in ("ROWS", "DUPLICATE_KEYS")}
                require_unique(keys, spec)
                summary = found
        quality.assert_row_count(keys["ROWS"], summary["FINAL_ROWS"], spec.name)
        quality.assert_row_count(keys["ROWS"], rows, spec.name)
    if current is not None and summary["UNCHANGED_ROWS"] == summary["TARGET_ROWS"] == summary["FINAL_ROWS"]:
        snapshots.discard(spark, path, version)
        return summary | {"VERSION": current}
    snapshots.publish(spark, path, version)
    return summary | {"VERSION": version}


def key_check(candidate: DataFrame, spec: TableSpec) -> dict[str, int]:
    """Rows and conflicting keys of a merged table; raises on a conflict."""
    keys = quality.key_counts(candidate, spec.key)
    require_unique(keys, spec)
    return keys


def require_unique(keys: dict[str, int], spec: TableSpec) -> None:
    quality.require_none({f"DUPLICATE_KEY_{spec.name.upper()}": keys["DUPLICATE_KEYS"]}, spec.name)
