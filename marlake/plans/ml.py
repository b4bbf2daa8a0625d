"""Models as Spark ML pipelines over the feature frames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import hash_int, ratio
from marlake.operators.ordered import joined_by_group, running, small
from marlake.session import stage, together

MISSING = "missing"
CLUSTERS = 3

# One set of settings for jobs and registered queries. Depth is 5 and rounds are 20 for all trees (boosting with
# Spark grows one tree per job), with a larger step; the share of rows and columns per tree and the
# smallest leaf are those of the target models. Their minimum gain is a sum over rows, which has no
# fixed counterpart in Spark's mean gain.
DELIVERY_TREES = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.9239, "minInstancesPerNode": 8, "featureSubsetStrategy": "0.6167"}
REVIEW_TREES = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.9447, "minInstancesPerNode": 3, "featureSubsetStrategy": "0.84"}
VALUE_TREES = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1}
STARTS = 4
ITERATIONS = 200


# --- preprocessing --------------------------------------------------------------------------
def prepared(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Numbers as doubles, missing categories as their own level (before any indexing)."""
    return df.withColumns(
        {
            **{c: F.col(c).cast("double") for c in numeric},
            **{c: F.coalesce(F.col(c), F.lit(MISSING)) for c in categorical},
        }
    )


def preprocessing(numeric: Sequence[str], categorical: Sequence[str], scale: bool = True) -> list:
    """Median imputation and scaling of numbers, one-hot categories with unknown as all zeros.

    The scaler uses the sample deviation; the difference to the population one does not change
    distances between clusters' order or tree splits.
    """
    numeric, categorical = list(numeric), list(categorical)
    filled = [f"{c}__filled" for c in numeric]
    stages: list = [
        Imputer(inputCols=numeric, outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="_numeric", handleInvalid="keep"),
    ]
    number_col = "_numeric"
    if scale:
        stages.append(StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True))
        number_col = "_scaled"
    inputs = [number_col]
    if categorical:
        index, hot = [f"{c}__index" for c in categorical], [f"{c}__hot" for c in categorical]
        stages += [
            StringIndexer(inputCols=categorical, outputCols=index, handleInvalid="keep", stringOrderType="frequencyDesc"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
        ]
        inputs += hot
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]


def balanced_weight(df: DataFrame, label: str, positives_only: bool = True) -> DataFrame:
    """Weight of the positives n_neg / n_pos; or n / (2 n_class) for both classes."""
    counts = df.agg(
        F.struct(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).alias("c")
    ).scalar()
    pos, neg = F.col("_c.pos"), F.col("_c.neg")
    if positives_only:
        weight = F.when(F.col(label) == 1, ratio(neg, F.greatest(pos, F.lit(1)))).otherwise(F.lit(1.0))
    else:
        own = F.when(F.col(label) == 1, pos).otherwise(neg)
        weight = ratio(pos + neg, 2 * own)
    return df.withColumn("_c", counts).withColumn("weight", weight).drop("_c")


def positive_probability(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


# --- fitted models as tables ----------------------------------------------------------------
def parameter_rows(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> list[tuple]:
    """(part, input, position, level, value) of everything a pipeline has learned; as many as levels and columns, never rows.

    Parts are median, mean, deviation, level (position by frequency), center (position is the cluster),
    intercept and coefficient (position in the feature vector).
    """
    rows, levels = [], [(c, None) for c in numeric]
    for part in model.stages:
        if isinstance(part, ImputerModel):
            found = part.surrogateDF.head()
            rows += [("median", c, 0, None, float(found[c])) for c in numeric]
        elif isinstance(part, StandardScalerModel):
            rows += [("mean", c, 0, None, float(v)) for c, v in zip(numeric, part.mean)]
            rows += [("deviation", c, 0, None, float(v)) for c, v in zip(numeric, part.std)]
        elif isinstance(part, StringIndexerModel):
            own = [(c, i, level) for c, names in zip(categorical, part.labelsArray) for i, level in enumerate(names)]
            rows += [("level", c, i, level, None) for c, i, level in own]
            levels += [(c, level) for c, _, level in own]
        elif isinstance(part, KMeansModel):
            centers = part.clusterCenters()
            rows += [("center", c, k, None, float(v)) for k, at in enumerate(centers) for c, v in zip(numeric, at)]
        elif isinstance(part, LogisticRegressionModel):
            rows.append(("intercept", "", 0, None, float(part.intercept)))
            weights = part.coefficients.toArray()
            rows += [("coefficient", c, i, level, float(v)) for i, ((c, level), v) in enumerate(zip(levels, weights))]
    return rows


def parameters(spark, rows: Sequence[tuple]) -> DataFrame:
    """``parameter_rows`` as a table, to be stored beside the scores."""
    return spark.createDataFrame(list(rows), "part string, input string, position int, level string, value double")


def _scaled(rows: Sequence[tuple], numeric: Sequence[str]) -> dict[str, Column]:
    """The scaled numbers as expressions over the raw columns."""
    at = {(part, c): v for part, c, _, _, v in rows if part in ("median", "mean", "deviation")}
    out = {}
    for c in numeric:
        x = F.col(c).cast("double")
        x = F.when(x.isNull() | F.isnan(x), F.lit(at[("median", c)])).otherwise(x)
        spread = at[("deviation", c)]
        out[c] = (x - at[("mean", c)]) / spread if spread else F.lit(0.0)
    return out


def probability_from(rows: Sequence[tuple], numeric: Sequence[str], categorical: Sequence[str]) -> Column:
    """Logistic probability as an expression over raw columns, from the stored parameters alone; unknown levels count 0."""
    weight = {(c, level): v for part, c, _, level, v in rows if part == "coefficient"}
    total = F.lit(next(v for part, _, _, _, v in rows if part == "intercept"))
    for c, x in _scaled(rows, numeric).items():
        total = total + x * weight[(c, None)]
    for c in categorical:
        known = [F.lit(v) for (own, level), w in weight.items() if own == c and level is not None for v in (level, w)]
        if known:
            total = total + F.coalesce(F.create_map(*known)[F.coalesce(F.col(c), F.lit(MISSING))], F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def distance_to(rows: Sequence[tuple], numeric: Sequence[str], cluster: int) -> Column:
    """Squared distance to a center as an expression over raw columns, from the stored parameters alone."""
    center = {c: v for part, c, k, _, v in rows if part == "center" and k == cluster}
    return sum([(x - center[c]) * (x - center[c]) for c, x in _scaled(rows, numeric).items()], F.lit(0.0))


def is_nearest(rows: Sequence[tuple], numeric: Sequence[str], col: str = "cluster") -> Column:
    """Whether no center is nearer than that of the row's cluster."""
    ids = sorted({k for part, _, k, _, _ in rows if part == "center"})
    far = {k: distance_to(rows, numeric, k) for k in ids}
    own = F.coalesce(*[F.when(F.col(col) == k, far[k]) for k in ids])
    return own <= F.least(*far.values(), F.lit(float("inf"))) + 1e-9


# --- classifiers and regressors -------------------------------------------------------------
def fit_classifier(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], seed: int = 42, **trees
) -> PipelineModel:
    """Boosted trees with the positives weighted up to the weight of the negatives."""
    frame = balanced_weight(prepared(df, numeric, categorical).withColumn("label", F.col(label).cast("double")), "label")
    model = GBTClassifier(labelCol="label", weightCol="weight", seed=seed, **trees)
    return Pipeline(stages=[*preprocessing(numeric, categorical), model]).fit(frame)


def fit_logistic(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], iterations: int = ITERATIONS
) -> PipelineModel:
    """Logistic regression with both classes balanced."""
    frame = balanced_weight(
        prepared(df, numeric, categorical).withColumn("label", F.col(label).cast("double")), "label", False
    )
    model = LogisticRegression(labelCol="label", weightCol="weight", maxIter=iterations)
    return Pipeline(stages=[*preprocessing(numeric, categorical), model]).fit(frame)


def score(model: PipelineModel, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], out: str) -> DataFrame:
    scored = model.transform(prepared(df, numeric, categorical))
    return scored.select(*df.columns, positive_probability().alias(out))


def fit_value_model(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], seed: int = 42, **trees
) -> PipelineModel:
    frame = prepared(df, numeric, categorical).withColumn("label", F.col(label).cast("double"))
    model = GBTRegressor(labelCol="label", seed=seed, **trees)
    return Pipeline(stages=[*preprocessing(numeric, categorical), model]).fit(frame)


def predict_value(model: PipelineModel, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], out: str) -> DataFrame:
    """Back from log1p, never below zero."""
    predicted = model.transform(prepared(df, numeric, categorical))
    return predicted.select(*df.columns, F.greatest(F.expm1("prediction"), F.lit(0.0)).alias(out))


# --- clusters -------------------------------------------------------------------------------
def cluster_input(columns: Sequence[str]) -> list:
    filled = [f"{c}__filled" for c in columns]
    return [
        Imputer(inputCols=list(columns), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="features", withMean=True, withStd=True),
    ]


def kmeans(points: DataFrame, k: int, seed: int) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(points)


def fit_clusters(
    df: DataFrame, columns: Sequence[str], k: int = CLUSTERS, starts: int = STARTS, seed: int = 42
) -> PipelineModel:
    """KMeans with several starts; the one with the lowest cost is kept."""
    prep = Pipeline(stages=cluster_input(columns)).fit(df)
    points = prep.transform(df).select("features").cache()
    try:
        fits = together(*[partial(kmeans, points, k, seed + start) for start in range(starts)])
        best = min(fits, key=lambda found: found.summary.trainingCost)
    finally:
        points.unpersist()
    return PipelineModel(stages=[*prep.stages, best])


def elbow(df: DataFrame, columns: Sequence[str], ks: Sequence[int] = range(2, 9), starts: int = STARTS, seed: int = 42) -> DataFrame:
    """Training cost for each number of clusters."""
    prep = Pipeline(stages=cluster_input(columns)).fit(df)
    points = prep.transform(df).select("features").cache()
    try:
        tried = [(k, seed + start) for k in ks for start in range(starts)]
        fits = together(*[partial(kmeans, points, k, own) for k, own in tried])
        costs = [found.summary.trainingCost for found in fits]
        rows = [(k, float(min(c for (own, _), c in zip(tried, costs) if own == k))) for k in ks]
    finally:
        points.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, training_cost double")


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).select(*df.columns, "cluster")


# --- split and evaluation -------------------------------------------------------------------
def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, out: str = "is_test") -> DataFrame:
    """Mark the rows with the lowest hashed rank of each label as test rows.

    The split depends on the key only, so it is the same on every run. Only labels, hashes and keys
    are ranked; the rows are compared with the last test key of their label.
    """
    at = F.struct(hash_int(F.lit("split"), key).alias("h"), F.col(key).alias("key"))
    narrow = df.select(label, hash_int(F.lit("split"), key).alias("_h"), key)
    ranked = running(narrow, [label], ["_h", key], sums={"_rank": F.lit(1)}, totals={"_n": "_rank"})
    limit = F.round(F.col("_n") * F.lit(test_share))
    last = F.max(F.when(F.col("_rank") < limit, F.struct(F.col("_h").alias("h"), F.col(key).alias("key"))))
    ends = stage(ranked.groupBy(label).agg(last.alias("_end")), "split-ends")
    marked = joined_by_group(df, small(ends), [label], "left")
    return marked.withColumn(out, F.coalesce(at <= F.col("_end"), F.lit(False))).drop("_end")


def classification_report(scored: DataFrame, label: str, score_col: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, from one pass of counts."""
    predicted = (F.col(score_col) >= threshold).cast("int")
    counts = scored.groupBy(F.col(label).cast("int").alias("actual"), predicted.alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_class = counts.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("class"), "actual", "predicted", "n")
    hit = (F.col("actual") == F.col("class")) & (F.col("predicted") == F.col("class"))
    sums = per_class.groupBy("class").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("predicted") == F.col("class"), F.col("n")).otherwise(0)).alias("called"),
        F.sum(F.when(F.col("actual") == F.col("class"), F.col("n")).otherwise(0)).alias("support"),
    )
    precision, recall = ratio("hits", "called"), ratio("hits", "support")
    return sums.select(
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1"),
        "support",
    )


def precision_recall_points(scored: DataFrame, label: str, score_col: str) -> DataFrame:
    """Precision and recall at every distinct score, and the average precision over them.

    Counts per distinct score come first; their running sum is taken in chunks.
    """
    per_score = scored.groupBy((-F.col(score_col)).alias("_neg")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("bigint")).alias("_hits")
    )
    per_score = stage(per_score, "per-score")
    run = running(
        per_score, [], ["_neg"], sums={"_n0": "_n", "_h0": "_hits"}, totals={"_pos": "_h0"}
    )
    called, hits = F.col("_n0") + F.col("_n"), F.col("_h0") + F.col("_hits")
    return run.select(
        (-F.col("_neg")).alias("threshold"),
        ratio(hits, called).alias("precision"),
        ratio(hits, "_pos").alias("recall"),
        (ratio(hits, called) * ratio("_hits", "_pos")).alias("area"),
    )


def average_precision(points: DataFrame) -> DataFrame:
    return points.agg(F.sum("area").alias("average_precision"))


# --- revenue forecast -----------------------------------------------------------------------
def black_friday(year: int) -> date:
    """Friday after the fourth Thursday of November."""
    first = date(year, 11, 1)
    return first + timedelta(days=(3 - first.weekday()) % 7 + 21 + 1)


def mothers_day(year: int) -> date:
    """Second Sunday of May."""
    first = date(year, 5, 1)
    return first + timedelta(days=(6 - first.weekday()) % 7 + 7)


def carnival(year: int) -> date:
    """Tuesday 47 days before Easter Sunday (Gregorian computus)."""
    a, b, c = year % 19, year // 100, year % 100
    d, e = divmod(b, 4)
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    m = (32 + 2 * e + 2 * i - h - k) % 7
    n = (a + 11 * h + 22 * m) // 451
    month, day = divmod(h + m - 7 * n + 114, 31)
    return date(year, month, day + 1) - timedelta(days=47)


# Days before and after each holiday that belong to it.
HOLIDAYS = {
    "black_friday": (black_friday, -3, 1),
    "christmas": (lambda year: date(year, 12, 25), -14, 0),
    "mothers_day": (mothers_day, -10, 0),
    "carnival": (carnival, -1, 2),
}


def years_of(days: DataFrame, ahead: int = 1) -> range:
    """Calendar years of the column ``ds`` and ``ahead`` more; two values are fetched."""
    first, last = days.agg(F.year(F.min("ds")), F.year(F.max("ds"))).head()
    return range(0) if first is None else range(first, last + 1 + ahead)


def holiday_calendar(spark, years: Sequence[int]) -> DataFrame:
    """One row per holiday and year with its window of days."""
    rows = [
        f"('{name}', date'{rule(y).isoformat()}', {low}, {high})"
        for name, (rule, low, high) in HOLIDAYS.items()
        for y in years
    ]
    if not rows:
        return spark.createDataFrame([], "holiday string, ds date, lower_window int, upper_window int")
    return spark.sql(f"select * from values {', '.join(rows)} as t(holiday, ds, lower_window, upper_window)")


def holiday_days(calendar: DataFrame) -> DataFrame:
    """Every day that belongs to a holiday, with its distance to it."""
    return calendar.select(
        "holiday", "ds", F.explode(F.sequence("lower_window", "upper_window")).alias("offset")
    ).select("holiday", F.date_add("ds", F.col("offset")).alias("ds"), "offset")


def forecast_days(orders: DataFrame, historical_end: str, *more: str) -> DataFrame:
    """Orders of the historical cohort up to a day and of the synthetic cohort, with their day ``ds``."""
    day = F.to_date("order_purchase_timestamp")
    chosen = (~F.col("is_synthetic") & (day <= F.lit(historical_end).cast("date"))) | F.col("is_synthetic")
    return orders.where(chosen).select("order_id", day.alias("ds"), *more)


def forecast_input(orders: DataFrame, items: DataFrame, historical_end: str, target: str = "price") -> DataFrame:
    """Daily revenue of the historical cohort up to a day, and of the synthetic cohort."""
    chosen = forecast_days(orders, historical_end)
    amount = F.col("price") if target == "price" else F.col("price") + F.col("freight_value")
    per_order = items.groupBy("order_id").agg(F.sum(amount).alias("y"))
    return chosen.join(per_order, "order_id").groupBy("ds").agg(F.sum("y").alias("y"))


def seasonal_features(
    days: DataFrame, holidays: DataFrame | None, origin: Column, yearly: int = 10, weekly: int = 3
) -> DataFrame:
    """Trend, weekly and yearly Fourier terms and holiday flags of the days in ``ds``; no flags without holidays."""
    t = F.datediff("ds", origin).cast("double")
    terms = {"t": t / 365.25}
    for period, order, tag in ((365.25, yearly, "y"), (7.0, weekly, "w")):
        for k in range(1, order + 1):
            angle = t * F.lit(2 * 3.141592653589793 * k / period)
            terms[f"{tag}_sin{k}"], terms[f"{tag}_cos{k}"] = F.sin(angle), F.cos(angle)
    if holidays is None:
        return days.withColumns(terms)
    names = sorted(HOLIDAYS)
    flags = (
        holidays.groupBy("ds")
        .agg(*[F.max((F.col("holiday") == n).cast("double")).alias(f"h_{n}") for n in names])
    )
    return (
        days.join(F.broadcast(flags), "ds", "left")
        .withColumns({f"h_{n}": F.coalesce(F.col(f"h_{n}"), F.lit(0.0)) for n in names})
        .withColumns(terms)
    )


def forecast(daily: DataFrame, holidays: DataFrame, horizon: int = 90, z: float = 1.2815515655446004) -> DataFrame:
    """Revenue of the next days with an 80% interval, never below zero.

    A regression on trend, seasons and holidays; ``daily`` has one row per calendar day.
    """
    ends = daily.agg(F.struct(F.min("ds").alias("a"), F.max("ds").alias("b")).alias("e")).scalar()
    train = seasonal_features(daily.withColumn("_e", ends), holidays, F.col("_e.a"))
    inputs = [c for c in train.columns if c == "t" or c.startswith(("h_", "y_", "w_"))]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    frame = assembler.transform(train.withColumn("label", F.col("y").cast("double")))
    model = LinearRegression(featuresCol="features", labelCol="label", regParam=0.01, solver="normal").fit(frame)
    spread = z * model.summary.rootMeanSquaredError
    span = daily.agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    future = span.select(
        F.struct("a", "b").alias("_e"),
        F.explode(F.sequence(F.date_add("b", 1), F.date_add("b", horizon))).alias("ds"),
    )
    predicted = model.transform(assembler.transform(seasonal_features(future, holidays, F.col("_e.a"))))
    yhat = F.col("prediction")
    return predicted.select(
        "ds",
        F.greatest(yhat, F.lit(0.0)).alias("yhat"),
        F.greatest(yhat - spread, F.lit(0.0)).alias("yhat_lower"),
        (yhat + spread).alias("yhat_upper"),
    )
