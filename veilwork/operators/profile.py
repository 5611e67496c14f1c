"""Counts, samples and format profiles of every column of a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilwork.functions.patterns import PATTERNS, PROFILE_FEATURES, has_digit, looks_like, ratio, word_count
from veilwork.functions.text import strip

SAMPLE_SIZE = 5
SAMPLE_WIDTH = 1000  # characters of a sample value
SKETCH_LOG = 12  # of the registers of a sketch of distinct values
_HASH_RANGE = 1 << 60


def default_row_hash(df: DataFrame) -> Column:
    """A non-negative 60-bit hash of the whole row."""
    return F.xxhash64(*[F.col(c) for c in df.columns]).bitwiseAND(F.lit(_HASH_RANGE - 1))


def unpivot_text(df: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """(keep..., column_name, value) with every column as text."""
    columns = columns or df.columns
    keep = keep or []
    wide = df.select(*keep, *[F.col(c).cast("string").alias(f"_v_{c}") for c in columns])
    long = wide.unpivot(keep, [f"_v_{c}" for c in columns], "column_name", "value")
    return long.withColumn("column_name", F.substring("column_name", 4, 1 << 20))


def column_counts(df: DataFrame) -> DataFrame:
    """(column_name, records_scanned, non_null_records) for all columns in one aggregate."""
    totals = df.agg(
        F.count(F.lit(1)).alias("_all"), *[F.count(F.col(c)).alias(f"_v_{c}") for c in df.columns]
    )
    long = totals.unpivot("_all", [f"_v_{c}" for c in df.columns], "column_name", "non_null_records")
    return long.select(
        F.substring("column_name", 4, 1 << 20).alias("column_name"),
        F.col("_all").alias("records_scanned"),
        "non_null_records",
    )


def column_parts(df: DataFrame, k: int = SAMPLE_SIZE, row_hash: Column | None = None) -> DataFrame:
    """Counts and bottom-k values of every column as each task sees them, in one pass.

    (column_name, records, non_null, entries): entries has the task's up to k (row hash, value)
    of lowest hash, then value, copies included, NULL values left out. So a task gives k values
    per column, whatever it reads, and the parts of several tables can be put together before
    anything is shuffled. Values are text, cut to SAMPLE_WIDTH characters.
    """
    row_hash = default_row_hash(df) if row_hash is None else row_hash
    names = list(df.columns)
    texts = [F.substring(F.col(f"`{c}`").cast("string"), 1, SAMPLE_WIDTH).alias(f"_v{i}") for i, c in enumerate(names)]

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, known = 0, [0] * len(names)
        kept: list[list[tuple[int, str]]] = [[] for _ in names]
        for batch in batches:
            records += len(batch)
            hashes = batch.column(0).to_numpy()
            for i in range(len(names)):
                column = batch.column(i + 1)
                known[i] += len(column) - column.null_count
                may = hashes <= kept[i][-1][0] if len(kept[i]) == k else np.ones(len(hashes), dtype=bool)
                if column.null_count:
                    may &= column.is_valid().to_numpy(zero_copy_only=False)
                places = np.flatnonzero(may)
                if len(places) > k:
                    # All that may be among the k lowest of this batch, ties included.
                    places = places[hashes[places] <= np.partition(hashes[places], k - 1)[k - 1]]
                if len(places):
                    values = column.take(pa.array(places)).to_pylist()
                    kept[i] = sorted(kept[i] + list(zip(hashes[places].tolist(), values, strict=True)))[:k]
        if records:
            entries = [[{"row_hash": h, "value": v} for h, v in rows] for rows in kept]
            yield pa.RecordBatch.from_pydict(
                {"column_name": names, "records": [records] * len(names), "non_null": known, "entries": entries}
            )

    kind = "column_name string, records bigint, non_null bigint, entries array<struct<row_hash:bigint,value:string>>"
    return df.select(row_hash.alias("_hash"), *texts).mapInArrow(lowest, kind)


def merged_parts(parts: DataFrame, by: list[str], k: int = SAMPLE_SIZE) -> DataFrame:
    """(by..., records_scanned, non_null_records, samples) of `column_parts`, by their keys.

    One shuffle of k rows per column and task, and nothing on the driver.
    """
    rows = parts.select(*by, "records", "non_null", F.posexplode_outer("entries").alias("_n", "_entry"))
    # A part's counts travel with its first entry only.
    first = F.coalesce("_n", F.lit(0)) == 0
    group = Window.partitionBy(*by)
    ranked = rows.select(
        *by,
        F.sum(F.when(first, F.col("records"))).over(group).alias("records_scanned"),
        F.sum(F.when(first, F.col("non_null"))).over(group).alias("non_null_records"),
        "_entry",
        F.row_number().over(group.orderBy(F.asc_nulls_last("_entry.row_hash"), "_entry.value")).alias("_n"),
    )
    listed = ranked.where(F.col("_n") <= k).groupBy(*by, "records_scanned", "non_null_records").agg(
        F.sort_array(F.collect_list(F.when(F.col("_entry").isNotNull(), F.struct("_n", strip(F.col("_entry.value")).alias("v"))))).alias("_list")
    )
    samples = F.transform("_list", lambda s: s["v"]).alias("samples")
    return listed.select(*by, "records_scanned", "non_null_records", samples)


def column_samples(df: DataFrame, k: int = SAMPLE_SIZE, row_hash: Column | None = None) -> DataFrame:
    """(column_name, samples): up to k non-null values per column, from the rows of lowest hash.

    Which rows are chosen is free, so it is made repeatable by hashing the row. Columns of an
    empty table have empty samples.
    """
    known = merged_parts(column_parts(df, k, row_hash), ["column_name"], k).select("column_name", "samples")
    return _every_column(df, known, samples=F.array().cast("array<string>"))


def _every_column(df: DataFrame, known: DataFrame, **empty: Column) -> DataFrame:
    """`known` with a row for each column of `df` that no task has seen."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "_name string")
    joined = names.join(known, F.col("_name") == F.col("column_name"), "left")
    values = [F.coalesce(c, empty[c]).alias(c) for c in known.columns if c != "column_name"]
    return joined.select(F.col("_name").alias("column_name"), *values)


# Classes of cells whose format follows from their type, as the first character of a long column name.
TEXT, WHOLE, DECIMAL, DAY, TIME = "txwdi"
_CLASSES = {
    "tinyint": WHOLE, "smallint": WHOLE, "int": WHOLE, "bigint": WHOLE, "float": DECIMAL, "double": DECIMAL,
    "date": DAY, "timestamp": TIME, "timestamp_ntz": TIME,
}


def text_values(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(keep..., column_name, class, value): all cells but those of `keep` as stripped text, NULL where empty."""
    keep = keep or []
    types = dict(df.dtypes)
    named = {f"{_CLASSES.get(types[c], TEXT)}{c}": F.col(f"`{c}`").cast("string") for c in df.columns if c not in keep}
    wide = df.select(*keep, *[value.alias(name) for name, value in named.items()])
    long = wide.unpivot(keep, [F.col(f"`{name}`") for name in named], "column_name", "value")
    kind = F.substring("column_name", 1, 1)
    # Odd values of a type (NaN, years of five digits, exponents) are told apart as text.
    plain = (
        F.when(kind == WHOLE, True)
        .when(kind == DECIMAL, ~F.col("value").rlike("[A-Z]"))
        .when(kind == DAY, F.length("value") == 10)
        .when(kind == TIME, F.length("value") >= 19)
        .otherwise(False)
    )
    return long.select(
        *keep,
        F.substring("column_name", 2, 1 << 20).alias("column_name"),
        F.when(plain, kind).otherwise(TEXT).alias("class"),
        F.when(kind == TEXT, F.nullif(strip(F.col("value")), F.lit(""))).otherwise(F.col("value")).alias("value"),
    )


def _typed_format(value: Column, kind: Column, name: str) -> Column:
    """`looks_like` for a cell of a class: from its length and sign where the type decides."""
    size, unsigned = F.length(value), ~F.startswith(value, F.lit("-"))
    whole = {
        "phone": (size == 10) & (F.substring(value, 1, 1) >= "6"),
        "credit_card": unsigned & size.between(13, 19),
        "bank_account": unsigned & size.between(8, 18),
        "medical_record": unsigned & size.between(5, 20),
        "numeric": F.lit(True),
        "alphanumeric": unsigned,
    }
    test = F.when(value.isNull(), False).when(kind == TEXT, looks_like(value, name))
    test = test.when(kind == WHOLE, whole.get(name, F.lit(False)))
    return test.when(kind == DECIMAL, name == "numeric").when(kind == DAY, name == "date").otherwise(False)


# Counters of a profile that add up over parts of a table, and how.
ADDED = ("records", "values", *PROFILE_FEATURES[:9], "_length", "_squares", "_words", "_digits")


def _counters(n: Column, value: Column, kind: Column) -> list[Column]:
    """Aggregates over values of a class that each stand for `n` cells."""
    length = F.length(value).cast("double")

    def total(test: Column) -> Column:
        return F.sum(F.when(test, n).otherwise(0))

    return [
        F.sum(n).alias("records"),
        total(value.isNotNull()).alias("values"),
        *[total(_typed_format(value, kind, p)).alias(name) for p, name in zip(PATTERNS, PROFILE_FEATURES)],
        F.sum(n * length).alias("_length"),
        F.sum(n * length * length).alias("_squares"),
        F.sum(n * F.when(kind == TEXT, word_count(value)).when(kind == TIME, 2).otherwise(F.when(value.isNotNull(), 1))).alias("_words"),
        total(F.when(kind == TEXT, has_digit(value)).otherwise(value.isNotNull())).alias("_digits"),
        F.min(length).alias("_min"),
        F.max(length).alias("_max"),
    ]


def _features(raw: DataFrame, *more: Column) -> DataFrame:
    """The 18 profile features and null share from the counters and `_distinct`."""
    count = F.col("values")
    mean = ratio(F.col("_length"), count)
    variance = ratio(F.col("_squares"), count) - mean * mean
    shares = [ratio(F.col(name), count).alias(name) for name in PROFILE_FEATURES[:9]]

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    return raw.select(
        "column_name",
        "records",
        "values",
        ratio(F.col("records") - count, F.col("records")).alias("null_ratio"),
        *shares,
        F.least(ratio(F.col("_distinct"), count), F.lit(1.0)).alias("unique_ratio"),
        or_zero(mean).alias("avg_length"),
        or_zero(F.col("_min")).alias("min_length"),
        or_zero(F.col("_max")).alias("max_length"),
        F.lit(0.0).alias("null_or_empty"),
        count.cast("double").alias("sample_count"),
        or_zero(F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("std_length"),
        or_zero(ratio(F.col("_words"), count)).alias("avg_word_count"),
        ratio(F.col("_digits"), count).alias("digit_value_ratio"),
        *more,
    )


def profile_columns(df: DataFrame, exact_unique: bool = False) -> DataFrame:
    """The 18 profile features and null share of every column, over all its values.

    With approximate uniqueness this is one pass that leaves the scan as one partial row
    per column and task. `exact_unique` has to shuffle the distinct values anyway, so they
    are counted first and each distinct value is tested once.
    """
    long = text_values(df)
    if exact_unique:
        long = long.groupBy("column_name", "class", "value").agg(F.count(F.lit(1)).alias("_n"))
        distinct = F.count_distinct(F.lower("value"))
    else:
        long = long.withColumn("_n", F.lit(1).cast("bigint"))
        distinct = F.approx_count_distinct(F.lower("value"))
    raw = long.groupBy("column_name").agg(
        *_counters(F.col("_n"), F.col("value"), F.col("class")), distinct.alias("_distinct")
    )
    return _features(raw)


def profile_parts(df: DataFrame, by: list[str]) -> DataFrame:
    """(by..., column_name, counters, sketches) of the other columns, one small row each.

    Parts add up: counters by sums, minima and maxima, distinct values by HyperLogLog sketches
    of 4096 registers (relative error 1.3 % at one standard deviation), and lengths by a KLL
    quantile sketch (rank error about 1.3 %). So a table's profile is a merge of its loads'.
    """
    value = F.col("value")
    return text_values(df, by).groupBy(*by, "column_name").agg(
        *_counters(F.lit(1).cast("bigint"), value, F.col("class")),
        F.hll_sketch_agg(F.lower(value), SKETCH_LOG).alias("_seen"),
        F.kll_sketch_agg_bigint(F.length(value).cast("bigint")).alias("_lengths"),
    )


def merged_profile(parts: DataFrame) -> DataFrame:
    """`profile_columns` of all parts together, with the median and the 95th percentile of lengths."""
    raw = parts.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ADDED],
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
        F.hll_sketch_estimate(F.hll_union_agg("_seen")).alias("_distinct"),
        F.kll_merge_agg_bigint(F.when(F.col("values") > 0, F.col("_lengths"))).alias("_lengths"),
    )

    def at(rank: float) -> Column:
        # A sketch of nothing has no quantiles.
        return F.when(F.col("values") > 0, F.kll_sketch_get_quantile_bigint("_lengths", F.lit(rank)))

    return _features(raw, at(0.5).alias("median_length"), at(0.95).alias("high_length"))
