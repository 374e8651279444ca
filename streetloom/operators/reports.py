"""Counts, rankings and statistics over the integrated table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.dimensions import inline_table
from streetloom.fixed_values import MONTHS


def _rows(weight: str | None) -> Column:
    """Number of rows, or the sum of a column that says how many rows each stands for."""
    return F.count("*") if weight is None else F.sum(weight)


def value_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """(value, n) per value of a column, nulls left out; a row counts as often as ``weight`` says."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(_rows(weight).alias("n"))
    )


def top_values(df: DataFrame, column: str, k: int, weight: str | None = None) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return value_counts(df, column, weight).orderBy(F.desc("n"), "value").limit(k)


def month_name(col: Column) -> Column:
    return F.date_format(col.try_cast("timestamp_ntz"), "MMMM")


def calendar(spark: SparkSession) -> DataFrame:
    schema = T.StructType(
        [T.StructField("month_no", T.IntegerType()), T.StructField("month", T.StringType())]
    )
    return inline_table(spark, list(enumerate(MONTHS, start=1)), schema)


def monthly_counts(
    df: DataFrame, at: str = "requested_datetime", by_year: bool = False, weight: str | None = None
) -> DataFrame:
    """Rows per month name, all years together, months without rows included.

    ``by_year`` counts (year, month) instead, without completion.
    """
    kept = [] if weight is None else [weight]
    stamped = df.select(F.col(at).try_cast("timestamp_ntz").alias("ts"), *kept).where("ts is not null")
    if by_year:
        return stamped.groupBy(
            F.year("ts").alias("year"), F.month("ts").alias("month_no"), F.date_format("ts", "MMMM").alias("month")
        ).agg(_rows(weight).alias("n"))
    counted = stamped.groupBy(F.month("ts").alias("_no")).agg(_rows(weight).alias("_n"))
    return (
        calendar(df.sparkSession)
        .join(counted, F.col("month_no") == F.col("_no"), "left")
        .select("month_no", "month", F.coalesce("_n", F.lit(0)).cast("long").alias("n"))
    )


def top_per_month(
    df: DataFrame, k: int = 5, kind: str = "service_name", at: str = "requested_datetime", weight: str | None = None
) -> DataFrame:
    """The k most frequent kinds of each month, with their rank; ties go to the smaller name."""
    kept = [] if weight is None else [weight]
    counted = (
        df.select(F.col(kind).alias("kind"), month_name(F.col(at)).alias("month"), *kept)
        .where("kind is not null and month is not null")
        .groupBy("month", "kind")
        .agg(_rows(weight).alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("month").orderBy(F.desc("n"), "kind"))
    return counted.withColumn("place", place).where(F.col("place") <= k).withColumnRenamed("kind", kind)


def top_pairings(df: DataFrame, k: int = 5, weight: str | None = None) -> DataFrame:
    """The k most frequent (request type, primary category) pairs."""
    return (
        df.where("service_name is not null and primary_category is not null")
        .groupBy("service_name", "primary_category")
        .agg(_rows(weight).alias("n"))
        .orderBy(F.desc("n"), "service_name", "primary_category")
        .limit(k)
    )


def compare_groups(
    df: DataFrame, group: Column, kind: str = "service_name", k: int = 5, weight: str | None = None
) -> DataFrame:
    """Rows per (kind, group) among the k most frequent kinds."""
    counted = (
        df.where(F.col(kind).isNotNull())
        .groupBy(kind, group.alias("business_group"))
        .agg(_rows(weight).alias("n"))
    )
    # the top kinds come from the counts, so the rows are read once
    top = (
        counted.groupBy(F.col(kind).alias("_kind"))
        .agg(F.sum("n").alias("_n"))
        .orderBy(F.desc("_n"), "_kind")
        .limit(k)
    )
    return counted.join(top, F.col(kind) == F.col("_kind"), "left_semi")


def zip_density(
    df: DataFrame,
    zip_column: str = "zipcode_request",
    request: str = "service_request_id",
    business: str = "business_id",
    distinct_requests: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Per ZIP: request rows (or distinct requests) and distinct businesses; rows without ZIP left out.

    With ``weight`` a row stands for so many; ``request`` may then be null where they have none, and must not be distinct.
    """
    if weight is not None:
        if distinct_requests:
            raise ValueError("rows that stand for many do not tell distinct requests")
        # once for each business, then without them: no row is repeated for the distinct count
        met = (
            df.where(F.col(zip_column).isNotNull())
            .groupBy(F.col(zip_column).alias("zipcode"), business)
            .agg(F.coalesce(F.sum(F.when(F.col(request).isNotNull(), F.col(weight))), F.lit(0)).alias("_n"))
        )
        return met.groupBy("zipcode").agg(F.sum("_n").alias("request_count"), F.count(business).alias("business_count"))
    requests = F.count_distinct(request) if distinct_requests else F.count(request)
    return (
        df.where(F.col(zip_column).isNotNull())
        .groupBy(F.col(zip_column).alias("zipcode"))
        .agg(requests.alias("request_count"), F.count_distinct(business).alias("business_count"))
    )


def density_correlation(density: DataFrame) -> DataFrame:
    """Correlation of the two counts: NaN where one of them is the same in all of several rows, null without two rows."""
    both = F.col("business_count").isNotNull() & F.col("request_count").isNotNull()
    x, y = (F.when(both, F.col(name).cast("double")) for name in ("business_count", "request_count"))
    moments = density.agg(
        F.count_if(both).alias("n"), F.covar_pop(x, y).alias("joint"), (F.stddev_pop(x) * F.stddev_pop(y)).alias("apart")
    )
    # not corr(), which divides by zero there
    ratio = F.when(F.col("apart") == 0, float("nan")).otherwise(F.try_divide("joint", "apart"))
    return moments.select(F.when(F.col("n") > 1, ratio).alias("correlation"))


def density_fit(density: DataFrame) -> DataFrame:
    """Least-squares line of requests on businesses."""
    y, x = F.col("request_count").cast("double"), F.col("business_count").cast("double")
    return density.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def zip_centroids(df: DataFrame, zip_column: str, lat: str, lon: str) -> DataFrame:
    """Mean position and number of rows per ZIP, rows with a missing part left out."""
    return (
        df.na.drop("any", subset=[zip_column, lat, lon])
        .groupBy(F.col(zip_column).alias("zipcode"))
        .agg(F.avg(lat).alias("lat"), F.avg(lon).alias("lon"), F.count("*").alias("n"))
    )


def map_center(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.agg(F.avg(lat).alias("lat"), F.avg(lon).alias("lon"))


def chi_square(df: DataFrame, row: str, column: str) -> DataFrame:
    """Independence test of two label columns: statistic, degrees of freedom, rows.

    With expected counts e = r * c / n the statistic sum((o - e)^2 / e) over all cells, empty ones too,
    equals n * (sum(o^2 / (r * c)) - 1) over the occupied cells, so empty cells are never made.
    """
    cells = df.na.drop("any", subset=[row, column]).groupBy(row, column).agg(F.count("*").alias("o"))
    rows = cells.groupBy(row).agg(F.sum("o").alias("r"))
    columns = cells.groupBy(column).agg(F.sum("o").alias("c"))
    total = rows.agg(F.sum("r")).scalar()
    shape = (
        (rows.agg(F.count("*")).scalar() - 1) * (columns.agg(F.count("*")).scalar() - 1)
    )
    share = F.col("o").cast("double") * F.col("o") / (F.col("r").cast("double") * F.col("c"))
    return (
        cells.join(rows, row)
        .join(columns, column)
        .agg(F.sum(share).alias("share"))
        .select(
            ((F.col("share") - 1) * total).alias("statistic"),
            shape.cast("long").alias("degrees"),
            total.cast("long").alias("n"),
        )
    )


def _log_gamma_half(n: Column) -> Column:
    """Logarithm of gamma(n / 2) for whole n >= 1, by the recurrence from 1 or 1/2."""
    odd = n % 2 == 1
    start = F.when(odd, 0.5 * math.log(math.pi)).otherwise(0.0)
    first = F.when(odd, 0.5).otherwise(1.0)
    steps = F.sequence(F.lit(0), (F.floor((n - 1) / 2) - F.when(odd, 1).otherwise(1)).cast("int"))
    grown = F.aggregate(steps, start, lambda total, k: total + F.log(first + k))
    return F.when(n <= 2, start).otherwise(grown)


def chi_square_tail(statistic: Column, degrees: Column) -> Column:
    """Probability that a chi-square variable of ``degrees`` is at least ``statistic``: the regularised upper
    incomplete gamma function at (degrees / 2, statistic / 2).

    Below the mean by the power series of the lower function, above it by the continued fraction of the upper one;
    both get so many terms, growing with the square root of the degrees, that the rest is below double precision.
    """
    a, x = degrees / 2, statistic / 2
    terms = (12 * F.sqrt(a) + 120).cast("int")
    front = F.exp(a * F.log(x) - x - _log_gamma_half(degrees))

    series = F.aggregate(
        F.sequence(F.lit(1), terms),
        F.struct((1 / a).alias("term"), (1 / a).alias("total")),
        lambda acc, n: F.struct(
            (acc["term"] * x / (a + n)).alias("term"), (acc["total"] + acc["term"] * x / (a + n)).alias("total")
        ),
        lambda acc: acc["total"],
    )

    # the fraction 1 / (x + 1 - a - 1 (1 - a) / (x + 3 - a - 2 (2 - a) / ...)), from its last term upwards
    fraction = F.aggregate(
        F.transform(F.sequence(F.lit(1), terms), lambda k: terms + 1 - k),
        F.lit(0.0),
        lambda below, n: n * (n - a) / (x + 2 * n + 1 - a + below) * -1,
    )
    upper = front / (x + 1 - a + fraction)
    tail = F.when(x < a + 1, 1 - front * series).otherwise(upper)
    return F.when(degrees <= 0, F.lit(None)).when(statistic <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def chi_square_test(df: DataFrame, row: str, column: str) -> DataFrame:
    """Independence test with its p-value: (p_value, degrees, statistic), for any number of labels.

    The p-value is null if a side has a single label.
    """
    tested = chi_square(df, row, column)
    return tested.select(chi_square_tail(F.col("statistic"), F.col("degrees")).alias("p_value"), "degrees", "statistic")


UNGROUPED = "ungrouped"


def with_group(df: DataFrame, groups: DataFrame, kind: str = "service_name") -> DataFrame:
    """Add ``request_group`` to every row; types without a group, and rows without a type, are ``ungrouped``.

    ``groups`` is (service_name, request_group), one row for each lower-case type.
    """
    named = groups.select(F.col("service_name").alias("_kind"), F.col("request_group").alias("_group"))
    joined = df.join(named, F.lower(kind) == F.col("_kind"), "left")
    return joined.withColumn("request_group", F.coalesce("_group", F.lit(UNGROUPED))).drop("_kind", "_group")


def group_share(df: DataFrame, groups: DataFrame, kind: str = "service_name") -> DataFrame:
    """Rows and percentage of all rows per request group; ``groups`` is (service_name, request_group).

    Types without a group, and rows without a type, are counted as ``ungrouped``.
    """
    kinds = df.groupBy(F.lower(kind).alias("kind")).agg(F.count("*").alias("n"))
    counted = with_group(kinds, groups, "kind").groupBy("request_group").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select("request_group", "n", (100 * F.col("n") / total).alias("pct"))


def review_overview(df: DataFrame, text: str = "text", at: str = "date", key: str = "business_id") -> DataFrame:
    """One row: rows, distinct businesses, first and last date, mean text length."""
    return df.agg(
        F.count("*").alias("reviews"),
        F.count_distinct(key).alias("businesses"),
        F.min(at).alias("first_date"),
        F.max(at).alias("last_date"),
        F.avg(F.char_length(text)).alias("avg_length"),
    )


def category_counts(df: DataFrame, column: str = "categories_normalized") -> DataFrame:
    """(category, n) over the entries of an array column."""
    return df.select(F.explode(column).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


def top_categories(df: DataFrame, k: int = 20, column: str = "categories_normalized") -> DataFrame:
    return category_counts(df, column).orderBy(F.desc("n"), "category").limit(k)


def category_change(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """One row: distinct category names before and after normalisation."""
    tagged = df.select(
        F.explode(
            F.concat(
                F.transform(before, lambda c: F.struct(F.lit("before").alias("stage"), c.alias("category"))),
                F.transform(after, lambda c: F.struct(F.lit("after").alias("stage"), c.alias("category"))),
            )
        ).alias("entry")
    ).select("entry.*").distinct()
    return tagged.agg(
        F.count_if(F.col("stage") == "before").alias("categories_before"),
        F.count_if(F.col("stage") == "after").alias("categories_after"),
    )


