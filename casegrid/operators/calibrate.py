"""Confidence: features, calibrated scores, path priors and reason buckets, all fitted on our own tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..config import DEFAULT, EngineConfig


def features(chosen: DataFrame) -> DataFrame:
    """One row per case: means and minima of scores and agreements over its fields, and counts. Cases without fields
    have no row."""
    return chosen.groupBy("case_id").agg(
        F.avg("score").alias("mean_score"),
        F.min("score").cast("double").alias("min_score"),
        F.avg("agreement").alias("mean_agreement"),
        F.min("agreement").cast("double").alias("min_agreement"),
        F.count(F.lit(1)).cast("double").alias("n_fields"),
        F.count_if("ambiguous").cast("double").alias("n_ambiguous"),
        F.count_if(F.col("rank") == 1).cast("double").alias("n_first"),
    )


FEATURES = ["mean_score", "min_score", "mean_agreement", "min_agreement", "n_fields", "n_ambiguous", "n_first"]


def logistic(columns: dict[str, tuple[float, float, float]], bias: float) -> Column:
    """The logistic of standardised features: name -> (mean, deviation, weight)."""
    z = F.lit(float(bias))
    for name, (mu, sd, w) in columns.items():
        z = z + (F.coalesce(F.col(name), F.lit(0.0)) - mu) / sd * w
    return 1 / (1 + F.exp(-z))


def isotonic(p: Column, steps: list[float]) -> Column:
    """A calibration table read at the floor of p's place in it."""
    k = len(steps)
    at = F.least(F.floor(p * (k - 1)).cast("int"), F.lit(k - 1)) + 1
    return F.element_at(F.array(*[F.lit(float(x)) for x in steps]), at)


def met(decisions: DataFrame, truth: DataFrame) -> DataFrame:
    """The rows of decisions beside each adjudication of their case_id, and n, how many pairs of cases that is: rows stand
    for n_cases, and the truths of cases that share an id are counted before they meet."""
    counts = truth.groupBy("case_id", "adjudication").agg(F.count(F.lit(1)).alias("_m"))
    return decisions.join(counts, "case_id").withColumn("n", F.col("n_cases") * F.col("_m")).drop("_m")


def path_priors(decisions: DataFrame, truth: DataFrame, prior: int = 10) -> DataFrame:
    """path, n, accuracy: the share of right decisions on a path, smoothed towards the share overall and clipped."""
    right = F.sum(F.when(F.col("decision") == F.col("adjudication"), F.col("n")).otherwise(0)).cast("double")
    by = met(decisions, truth).groupBy("path").agg(F.sum("n").alias("n"), right.alias("k"))
    # paths are a few dozen rows, whatever the batch
    by = by.withColumn("overall", F.sum("k").over(Window.partitionBy()) / F.sum("n").over(Window.partitionBy()))
    smooth = (F.col("k") + prior * F.col("overall")) / (F.col("n") + prior)
    return by.select("path", "n", F.least(F.lit(0.98), F.greatest(F.lit(0.02), smooth)).alias("accuracy"))


def reason_buckets(decisions: DataFrame, truth: DataFrame, low: float = 0.07, high: float = 0.93) -> DataFrame:
    """decision, reason, n, accuracy, decisive: how often a decision for a reason was right, and whether so nearly
    always or never that it overrides a score."""
    reason = F.split_part(F.try_element_at("reasons", F.lit(1)), F.lit(":"), F.lit(1))
    right = F.sum(F.when(F.col("decision") == F.col("adjudication"), F.col("n")).otherwise(0)).cast("double")
    by = met(decisions, truth).groupBy("decision", reason.alias("reason")).agg(F.sum("n").alias("n"), (right / F.sum("n")).alias("accuracy"))
    return by.withColumn("decisive", (F.col("accuracy") >= high) | (F.col("accuracy") <= low))


def confidence(rows: DataFrame, buckets: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """rows (case_id, decision, reasons, calibrated, has_note) with confidence: the calibrated score, floors and fixed
    values of certain reasons, then shrunk to a decisive bucket's accuracy, clamped, rounded half to even."""
    reason = F.split_part(F.coalesce(F.try_element_at("reasons", F.lit(1)), F.lit("")), F.lit(":"), F.lit(1))
    c = F.col("calibrated")
    c = F.when(F.col("has_note"), F.greatest(c, F.lit(0.98))).otherwise(c)
    c = F.when(reason == "recovered_adjudicator_note", F.greatest(c, F.lit(0.9))).when(reason == "fee_prior_approval", F.lit(0.75)).when(reason == "strike_cancellation_guard", F.lit(0.15)).otherwise(c)
    known = buckets.where("decisive").select("decision", "reason", F.col("n").alias("_n"), F.col("accuracy").alias("_acc"))
    # decisions by reasons are a few dozen rows, whatever the batch
    out = rows.withColumn("reason", reason).withColumn("_c", c).join(F.broadcast(known), ["decision", "reason"], "left")
    weight = F.col("_n") / (F.col("_n") + config.bucket_prior)
    shrunk = F.when(F.col("_n").isNotNull(), weight * F.col("_acc") + (1 - weight) * F.col("_c")).otherwise(F.col("_c"))
    return out.withColumn("confidence", F.bround(F.least(F.lit(0.99), F.greatest(F.lit(0.02), shrunk)), 3)).drop("_c", "_n", "_acc")


def fitted(rows: DataFrame, label: str, folds: int = 5) -> DataFrame:
    """One row per fold with the Brier score of a logistic model, isotonically calibrated, on the fold kept out; rows
    have FEATURES, the 0/1 label and a fold number, and should be materialized, as each fit reads them many times."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    table = VectorAssembler(inputCols=FEATURES, outputCol="raw").transform(rows.withColumn("label", F.col(label).cast("double")))
    table = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(table).transform(table).select("case_id", "fold", "label", "features")
    out = None
    for k in range(folds):
        learn, test = table.where(F.col("fold") != k), table.where(F.col("fold") == k)
        model = LogisticRegression(regParam=1e-3, maxIter=30).fit(learn)
        scored = lambda t: model.transform(t).select("case_id", "label", vector_to_array("probability")[1].alias("p"))  # noqa: B023, E731
        curve = IsotonicRegression(featuresCol="p", labelCol="label").fit(scored(learn))
        row = curve.transform(scored(test)).agg(F.lit(k).alias("fold"), F.count(F.lit(1)).alias("n"), F.avg(F.pow(F.col("prediction") - F.col("label"), 2)).alias("brier"))
        out = row if out is None else out.unionByName(row)
    return out
