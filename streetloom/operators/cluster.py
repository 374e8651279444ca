"""Standardised features and k-means on them.

Scores have 4 places, so there are far fewer different points than rows. k-means runs on the distinct
points with their counts as weights: the same objective, and a training set whose size does not depend on
the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.dimensions import inline_table
from streetloom.functions.binding import bind
from streetloom.session import checkpointed

FEATURES = ("proximity_score", "category_similarity")
POINTS_PER_TASK = 100_000
MAX_ITER = 300
TOLERANCE = 1e-9  # centres move no more than this in the last step
MAX_BROADCAST_POINTS = 1_000_000
STEPS = 10  # of the form with given starts
PLACES = 9  # of squared distances, so that equal ones are equal however they were summed up

Centers = list[tuple[float, ...]]


def _moments(df: DataFrame, features: Sequence[str]) -> Column:
    """Mean and population deviation of every feature as one scalar struct."""
    return df.agg(
        F.struct(
            *[F.avg(f).alias(f"{f}_mean") for f in features],
            *[F.stddev_pop(f).alias(f"{f}_sd") for f in features],
        ).alias("moments")
    ).scalar()


def standardize(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Add ``<feature>_z``: zero mean, unit population deviation; a constant feature becomes 0.

    Rows with a missing feature are dropped.
    """
    complete = df.na.drop("any", subset=list(features))
    moments = F.col("_moments")

    def z(feature: str) -> Column:
        sd = moments[f"{feature}_sd"]
        return (F.col(feature) - moments[f"{feature}_mean"]) / F.when(sd == 0, 1.0).otherwise(sd)

    return (
        complete.withColumn("_moments", _moments(complete.select(*features), features))
        .withColumns({f"{f}_z": z(f) for f in features})
        .drop("_moments")
    )


def weighted_points(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Distinct feature combinations with standardised vector and number of rows."""
    scaled = standardize(df.select(*features), features)
    return (
        scaled.groupBy(*features)
        .agg(F.count("*").alias("weight"), *[F.first(f"{f}_z").alias(f"{f}_z") for f in features])
        .withColumn("features", array_to_vector(F.array(*[F.col(f"{f}_z") for f in features])))
    )


def _training_set(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, int]:
    """Checkpointed weighted points and their number.

    Many small jobs read them, so they lie in as few tasks as their number needs.
    """
    points = checkpointed(weighted_points(df, features))
    n = points.count()
    return points.coalesce(max(1, -(-n // POINTS_PER_TASK))), n


def _fit(points: DataFrame, k: int, seed: int) -> tuple[float, KMeansModel]:
    model = KMeans(k=k, seed=seed, maxIter=MAX_ITER, tol=TOLERANCE, weightCol="weight", featuresCol="features").fit(points)
    return model.summary.trainingCost, model


def best_models(
    points: DataFrame, ks: Sequence[int], n_init: int = 10, seed: int = 42, parallelism: int = 8
) -> dict[int, tuple[float, KMeansModel]]:
    """Per k the least inertia of ``n_init`` starts and its model; ``parallelism`` fits run at a time."""
    if n_init < 1:
        raise ValueError("n_init must be at least 1")
    starts = [(k, seed + start) for k in ks for start in range(n_init)]
    fit = inheritable_thread_target(points.sparkSession)(lambda start: _fit(points, *start))
    with ThreadPool(min(parallelism, len(starts))) as pool:
        fitted = list(zip(starts, pool.map(fit, starts)))
    return {
        k: min((found for start, found in fitted if start[0] == k), key=lambda found: found[0]) for k in ks
    }


def kmeans_elbow(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    ks: Sequence[int] = tuple(range(2, 11)),
    n_init: int = 10,
    seed: int = 42,
) -> DataFrame:
    """(k, inertia) for each k. Training runs when this is called."""
    points, _ = _training_set(df, features)
    models = best_models(points, ks, n_init, seed)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("inertia", T.DoubleType())])
    return inline_table(df.sparkSession, [(k, models[k][0]) for k in ks], schema)


def kmeans_assign(
    df: DataFrame, features: Sequence[str] = FEATURES, k: int = 4, n_init: int = 10, seed: int = 42
) -> DataFrame:
    """Rows with complete features and their ``cluster`` 0..k-1, numbered by ascending centre.

    Training runs when this is called; the rows then take the cluster of their point, a lookup by the
    feature values that repeats no scaling.
    """
    points, n = _training_set(df, features)
    _, model = best_models(points, [k], n_init, seed)[k]
    centers = [tuple(center) for center in model.clusterCenters()]
    order = sorted(range(len(centers)), key=centers.__getitem__)
    new_label = F.array(*[F.lit(order.index(i)) for i in range(len(order))])
    labelled = model.transform(points).select(*features, F.get(new_label, F.col("prediction")).alias("cluster"))
    return df.join(F.broadcast(labelled) if n <= MAX_BROADCAST_POINTS else labelled, list(features))


# ---- given starts and a given number of steps: the same result everywhere, also in SQL -------------------


def _apart(features: Sequence[str], centers: Column) -> Column:
    """Squared distances of a point to each of an array of centres.

    Centres are data of the plan, not part of its code, so that all rounds share one compiled job.
    """
    return F.transform(
        centers,
        lambda c: F.round(
            sum(((F.col(f"{f}_z") - c[i]) * (F.col(f"{f}_z") - c[i]) for i, f in enumerate(features)), F.lit(0.0)), PLACES
        ),
    )


def _given(centers: Centers) -> Column:
    return F.lit([list(c) for c in centers])


def farthest_points(points: DataFrame, k: int, features: Sequence[str] = FEATURES) -> Centers:
    """The point farthest from the mean, then k - 1 times the one farthest from those chosen; ties by feature values.

    One job and one row of ``weighted_points`` for each; fewer centres if there are fewer points.
    """
    chosen: Centers = []
    for _ in range(k):
        least = F.array_min(_apart(features, _given(chosen or [(0.0,) * len(features)])))
        order = [F.desc("_apart"), *features]
        row = points.withColumn("_apart", least).orderBy(*order).select("_apart", *[f"{f}_z" for f in features]).first()
        if row is None or (chosen and row["_apart"] == 0):
            break
        chosen.append(tuple(row[1:]))
    return chosen


def _nearest(features: Sequence[str], centers: Column) -> Column:
    """Position ``at`` of the nearest centre, the first of equally near ones, and its squared distance ``apart``."""
    return bind(
        _apart(features, centers),
        lambda far: F.struct((F.array_position(far, F.array_min(far)) - 1).alias("at"), F.array_min(far).alias("apart")),
    )


def _dealt(points: DataFrame, centers: Mapping[int, Centers], features: Sequence[str]) -> DataFrame:
    """Every point once for each set of centres, with ``at`` and ``apart``."""
    sets = F.array(*[F.struct(F.lit(name).alias("set"), _given(given).alias("given")) for name, given in centers.items()])
    spread = points.select("weight", *[f"{f}_z" for f in features], F.inline(sets))
    return spread.select("*", _nearest(features, F.col("given")).alias("near")).select("*", "near.*")


def moved_centers(
    points: DataFrame, starts: Mapping[int, Centers], features: Sequence[str] = FEATURES, steps: int = STEPS
) -> dict[int, Centers]:
    """Centres of every set in ``starts`` after ``steps`` rounds: points go to their nearest centre, centres to the
    weighted mean of their points; one without points stays. All sets share one job a round, which returns a row for
    each centre."""
    centers = {name: list(given) for name, given in starts.items() if given}
    means = [(F.sum(F.col("weight") * F.col(f"{f}_z")) / F.sum("weight")).alias(f) for f in features]
    for _ in range(steps if centers else 0):
        for row in _dealt(points, centers, features).groupBy("set", "at").agg(*means).collect():
            centers[row["set"]][row["at"]] = tuple(row[f] for f in features)
    return centers


def elbow_from_farthest(
    df: DataFrame, features: Sequence[str] = FEATURES, ks: Sequence[int] = tuple(range(2, 11)), steps: int = STEPS
) -> DataFrame:
    """(k, inertia) for each k, from farthest points as starts; no row without points. Runs when called."""
    points, _ = _training_set(df, features)
    far = farthest_points(points, max(ks), features)
    centers = moved_centers(points, {k: far[:k] for k in ks}, features, steps)
    if not centers:
        return inline_table(df.sparkSession, [], T.StructType([T.StructField("k", T.IntegerType()), T.StructField("inertia", T.DoubleType())]))
    dealt = _dealt(points, centers, features)
    return dealt.groupBy(F.col("set").alias("k")).agg(F.sum(F.col("weight") * F.col("apart")).alias("inertia"))


def assign_from_farthest(df: DataFrame, features: Sequence[str] = FEATURES, k: int = 4, steps: int = STEPS) -> DataFrame:
    """Like ``kmeans_assign``, from farthest points as starts."""
    points, n = _training_set(df, features)
    centers = sorted(moved_centers(points, {k: farthest_points(points, k, features)}, features, steps).get(k, []))
    label = _nearest(features, _given(centers))["at"].cast("int") if centers else F.lit(None).cast("int")
    labelled = points.select(*features, label.alias("cluster"))
    return df.join(F.broadcast(labelled) if n <= MAX_BROADCAST_POINTS else labelled, list(features))


def cluster_profile(assigned: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Rows and mean features per cluster."""
    return assigned.groupBy("cluster").agg(
        F.count("*").alias("n"), *[F.avg(f).alias(f"avg_{f}") for f in features]
    )


def cluster_audit(df: DataFrame, features: Sequence[str] = FEATURES, k: int = 4, ks: Sequence[int] = (2, 3, 4)) -> DataFrame:
    """One row of checks that hold whatever the start centres were.

    rows, clusters, misplaced (rows nearer to another cluster's mean than to their own), unordered (neighbouring
    labels whose means are not in ascending order), wrong_inertia (1 if the inertia summed over the labelled rows is
    not the model's) and rises (steps of the curve over ``ks`` that go up).
    """
    assigned = kmeans_assign(df, features, k)
    scaled = checkpointed(standardize(assigned, features).select("cluster", F.array(*[F.col(f"{f}_z") for f in features]).alias("z")))
    size = range(len(features))
    means = scaled.groupBy("cluster").agg(F.array(*[F.avg(F.col("z")[i]) for i in size]).alias("mean"))
    listed = means.agg(F.array_sort(F.collect_list(F.struct("cluster", "mean"))).alias("means"))  # k entries

    def squared(mean: Column) -> Column:
        return sum(((F.col("z")[i] - mean[i]) * (F.col("z")[i] - mean[i]) for i in size), F.lit(0.0))

    apart = scaled.withColumn("means", listed.scalar()).select(
        "cluster", "means", F.transform("means", lambda m: squared(m["mean"])).alias("far")
    )
    own = F.get("far", F.col("cluster"))
    curve = {row["k"]: row["inertia"] for row in kmeans_elbow(df, features, [*dict.fromkeys([*ks, k])]).collect()}
    rises = sum(curve[b] > curve[a] * (1 + 1e-9) for a, b in zip(ks, ks[1:]))
    ordered = F.filter("means", lambda m, i: (i > 0) & (F.get("means", i - 1)["mean"] > m["mean"]))
    return apart.agg(
        F.count("*").alias("rows"),
        F.count_distinct("cluster").alias("clusters"),
        F.count_if(F.array_min("far") < own - 1e-9).alias("misplaced"),
        F.max(F.size(ordered)).alias("unordered"),
        (F.abs(F.sum(own) - curve[k]) > 1e-6 * curve[k]).cast("int").alias("wrong_inertia"),
    ).withColumn("rises", F.lit(rises))
