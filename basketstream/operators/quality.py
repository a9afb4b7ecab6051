"""Data-quality checks. A check returns the offending rows; none means it passed."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from basketstream.functions.ids import record_id


class QualityError(Exception):
    """A check found offending rows."""


def duplicate_keys(df: DataFrame, keys: list[str], also_null: bool = False) -> DataFrame:
    """Key values that occur more than once (or, if asked, hold a null)."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    bad = F.col("row_count") > 1
    if also_null:
        bad = reduce(lambda acc, key: acc | F.col(key).isNull(), keys, bad)
    return counted.where(bad)


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column in one pass, as rows (column_name, null_rows)."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], columns, "column_name", "null_rows")


def key_checks(df: DataFrame, key: str, unique: str, nulls: dict[str, str]) -> DataFrame:
    """Uniqueness of ``key`` and nulls of columns in one pass, as rows (check_name, offending_rows).

    ``unique`` names the uniqueness check, ``nulls`` maps check names to columns.
    Rows are reduced to one per key first, so a key with very many rows is cheap.
    """
    per_key = df.groupBy(key).agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(column).isNull()).alias(name) for name, column in nulls.items()])
    totals = per_key.agg(
        F.count_if(F.col("_rows") > 1).alias(unique), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in nulls])
    return totals.unpivot([], totals.columns, "check_name", "offending_rows")


def null_checks(df: DataFrame, nulls: dict[str, str]) -> DataFrame:
    """Nulls of columns in one pass, as rows (check_name, offending_rows)."""
    counts = df.agg(*[F.count_if(F.col(column).isNull()).alias(name) for name, column in nulls.items()])
    return counts.unpivot([], counts.columns, "check_name", "offending_rows")


def total_mismatch(staged: DataFrame, parts: DataFrame, measure: str) -> DataFrame:
    """One row when the parts' measure does not add up to the staged row count.

    The two totals meet as two rows of one union, so no cross join is planned.
    """
    sides = staged.agg(F.count("*").alias("staged_events"), F.lit(0).cast("bigint").alias("summed_events"))
    summed = parts.agg(
        F.lit(0).cast("bigint").alias("staged_events"),
        F.coalesce(F.sum(measure), F.lit(0)).cast("bigint").alias("summed_events"),
    )
    both = sides.unionByName(summed).agg(
        F.sum("staged_events").alias("staged_events"),
        F.sum("summed_events").alias("summed_events"),
    )
    return both.where(F.col("staged_events") != F.col("summed_events"))


def snapshot_integrity(candidates: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Keys missing on either side, repeated in the snapshot, or without client counts."""
    keys = ["client_id", "sku", "feature_as_of_date_source"]
    want = candidates.select(*keys, F.lit(True).alias("_wanted"))
    have = snapshot.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        F.min("events_previous_day").alias("_events"),
    )
    joined = want.join(have, keys, "full")
    broken = (
        F.col("_wanted").isNull()
        | F.col("_rows").isNull()
        | (F.col("_rows") != 1)
        | F.col("_events").isNull()
    )
    return joined.where(broken).select(*keys)


SOURCE_ROW = ["source_dataset", "source_file", "source_row_number"]


def source_row_conflicts(landed: DataFrame) -> DataFrame:
    """Source rows that more than one landing row claims."""
    claims = landed.groupBy(*SOURCE_ROW).agg(F.count("*").alias("row_count"))
    return claims.where(F.col("row_count") > 1)


def new_source_row_conflicts(landed: DataFrame, fresh: DataFrame, key: str, foreign_landed: DataFrame | None = None) -> DataFrame:
    """The same for rows about to be landed, given that ``landed`` has no conflicts.

    ``foreign_landed``: the landed source rows under another id, if they are on record.

    Their record ids are not landed yet, so a landed claim on one of their source
    rows is a conflict. An id normally follows from its source row. A conflict
    therefore has an id on one side that does not: either a fresh one, whose
    proper id is then looked up by the landing key, or a landed one. Only such
    rows move; the landing table is joined by its own key.
    """
    proper = record_id(F.col("source_file"), F.col("source_row_number"))
    foreign = ~F.col(key).eqNullSafe(proper)
    among = source_row_conflicts(fresh).select(*SOURCE_ROW)
    strange = fresh.where(foreign).select(proper.alias(key), *[F.col(c).alias(f"_{c}") for c in SOURCE_ROW])
    same_row = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in SOURCE_ROW])
    taken = landed.select(key, *SOURCE_ROW).join(strange, key).where(same_row).select(*SOURCE_ROW)
    claimed = landed.where(foreign) if foreign_landed is None else foreign_landed
    old = claimed.select(*SOURCE_ROW).join(fresh.select(*SOURCE_ROW).hint("merge"), SOURCE_ROW, "left_semi")
    return among.unionByName(taken).unionByName(old)


def status(checks: dict[str, DataFrame], *counted: DataFrame) -> DataFrame:
    """One row per check: how many rows offend. ``counted`` are checks that have their counts already."""
    rows = [
        bad.agg(F.count("*").alias("offending_rows")).select(F.lit(name).alias("check_name"), "offending_rows")
        for name, bad in checks.items()
    ]
    return reduce(DataFrame.unionByName, [*counted, *rows])


def require_zero(counts: DataFrame, name: str = "check_name", value: str = "offending_rows") -> None:
    """Fail on any check with offending rows; ``counts`` has one row per check."""
    failing = counts.where(F.col(value) > 0).collect()
    if failing:
        raise QualityError(", ".join(f"{row[name]}={row[value]}" for row in failing))
