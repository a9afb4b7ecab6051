"""Source profiles, window counts, manifest checks and label audits."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from basketstream.fixed_values import EVENT_TYPES, LABEL_DAYS, SKU_EVENT_TYPES
from basketstream.functions.times import as_date, check_window
from basketstream.operators import features

# Columns whose range is reported; others only report nulls.
RANGE_COLUMNS = ["client_id", "timestamp", "sku", "url", "category", "price"]


def profile_table(name: str, df: DataFrame) -> DataFrame:
    """Rows, nulls and exact range per column of one table, from one aggregate."""
    measures, shape = [F.count("*").alias("_rows")], []
    for column in df.columns:
        measures.append(F.count_if(F.col(column).isNull()).alias(f"_nulls_{column}"))
        low = high = F.lit(None).cast("string")
        if column in RANGE_COLUMNS:
            measures += [F.min(column).alias(f"_min_{column}"), F.max(column).alias(f"_max_{column}")]
            low, high = (F.col(f"_{side}_{column}").cast("string") for side in ("min", "max"))
        shape.append(
            F.struct(
                F.lit(name).alias("source_file"),
                F.lit(column).alias("column_name"),
                F.col("_rows").alias("total_rows"),
                F.col(f"_nulls_{column}").alias("null_count"),
                low.alias("min_value"),
                high.alias("max_value"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*shape)))


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [profile_table(name, df) for name, df in tables.items()])


def profile_window(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Events in ``[start, end)`` per source file (zero counts kept) and in total."""
    check_window(start, end)
    stamp = F.col("timestamp")
    inside = raw.where((stamp >= start) & (stamp < end))
    counts = inside.agg(
        *[F.count_if(F.col("event_type") == kind).alias(f"{kind}.parquet") for kind in EVENT_TYPES],
        F.count("*").alias("total"),
    )
    quoted = [F.col(f"`{name}`") for name in counts.columns]
    return counts.unpivot([], quoted, "source_file", "matching_events")


def validate_source(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose row count differs from the manifest, and the total if it differs.

    Both inputs have (source_file, row count); a file absent on one side is a mismatch.
    """
    expected = manifest.select("source_file", F.col("expected_rows").cast("bigint"))
    joined = expected.join(counts.select("source_file", "row_count"), "source_file", "full")
    total = joined.agg(
        F.lit("total").alias("source_file"),
        F.sum("expected_rows").alias("expected_rows"),
        F.sum("row_count").alias("row_count"),
    )
    both = joined.unionByName(total)
    same = F.col("expected_rows").eqNullSafe(F.col("row_count"))
    return both.where(~same).select("source_file", "expected_rows", F.col("row_count").alias("found_rows"))


def schema_mismatches(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Names of columns that are missing, unexpected or of another type."""
    actual = dict(df.dtypes)
    return sorted(name for name in expected.keys() | actual.keys() if expected.get(name) != actual.get(name))


def validate_sources(tables: dict[str, DataFrame], manifest: DataFrame, schemas: dict[str, dict[str, str]]) -> DataFrame:
    """Everything in which source files differ from the manifest: (source_file, problem, item, expected, found).

    Row counts come from one pass over each table that reads no column; columns from
    the tables' own schemas, which is as many rows as files have columns.
    """
    spark = manifest.sparkSession
    counts = reduce(DataFrame.unionAll, [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("source_file"), "row_count") for name, df in tables.items()])
    rows = validate_source(counts, manifest).select(
        "source_file", F.lit("row_count").alias("problem"), F.lit(None).cast("string").alias("item"),
        F.col("expected_rows").cast("string").alias("expected"), F.col("found_rows").cast("string").alias("found"))
    wrong = []
    for name, df in tables.items():
        actual, expected = dict(df.dtypes), schemas.get(name, {})
        wrong += [(name, "column", column, expected.get(column), actual.get(column)) for column in schema_mismatches(df, expected)]
    return rows.unionAll(spark.createDataFrame(wrong, "source_file string, problem string, item string, expected string, found string"))


def profile_candidates(day: DataFrame, raw_purchases: DataFrame, purchases: DataFrame, activity_date) -> DataFrame:
    """Candidate and outcome figures of one activity day, as rows (measure, value)."""
    as_of = as_date(activity_date).toordinal() + 1
    as_of = type(as_date(activity_date)).fromordinal(as_of)
    product = day.where(F.col("event_type").isin(SKU_EVENT_TYPES))
    unnamed = F.col("client_id").isNull() | F.col("sku").isNull()
    by_type = product.agg(
        *[F.count_if(F.col("event_type") == kind).alias(kind) for kind in SKU_EVENT_TYPES],
        F.count("*").alias("total_sku_events"),
        F.count_if(unnamed).alias("rows_missing_ids"),
    )
    pairs = features.candidate_pairs(day)
    labelled = features.labelled_pairs(pairs, purchases, as_of)
    found = F.col("first_purchase_at_source").isNotNull()
    outcome = labelled.agg(
        F.count("*").alias("candidate_pairs"),
        F.count_distinct("client_id").alias("distinct_clients"),
        F.coalesce(F.sum("_matching_rows"), F.lit(0)).alias("matching_purchase_rows"),
        F.count_if(found).alias("pairs_with_purchase"),
        F.count_if(~found).alias("pairs_without_purchase"),
    )
    bad = features.invalid_candidate_purchases(pairs, raw_purchases)
    rows = [features.wide_to_long(by_type), features.wide_to_long(outcome)]
    return reduce(DataFrame.unionAll, rows).unionAll(
        features.long_rows({"invalid_candidate_timestamps": bad})
    )


def audit_labels(snapshot: DataFrame, raw_purchases: DataFrame, purchases: DataFrame, as_of) -> DataFrame:
    """Label figures of one as-of date with the unreadable purchase times."""
    day = snapshot.where(F.col(features.AS_OF) == F.lit(str(as_of)).cast("date"))
    bad = features.invalid_candidate_purchases(day, raw_purchases)
    return features.label_summary(day, purchases, as_of).unionAll(
        features.long_rows({"invalid_candidate_timestamps": bad})
    )


def first_purchases(snapshot: DataFrame, purchases: DataFrame, as_of, n: int = 5) -> DataFrame:
    """The ``n`` earliest first purchases among one date's candidates."""
    day = snapshot.where(F.col(features.AS_OF) == F.lit(str(as_of)).cast("date"))
    found = features.labelled_pairs(day, purchases, as_of).where(F.col("first_purchase_at_source").isNotNull())
    ordered = found.orderBy("first_purchase_at_source", "client_id", "sku").limit(n)
    return ordered.select("client_id", "sku", "first_purchase_at_source")
