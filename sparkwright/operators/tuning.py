"""Feature preparation, learning-rate tuning and model registration.

* ``prepare_features``: documents joined to their labels, checked (required columns,
  no NULL features) and turned into numeric features with built-in functions;
  ``write_features`` stores the set once for all that reads it.
* ``tune_learning_rate``: one logistic model per learning rate by full-batch gradient descent. Each round is one
  aggregate over the training rows that serves all rates; only its twelve sums reach the driver. Features
  and predictions are rounded to integers and summed exactly, and weights are rounded after each step, so the
  result doesn't depend on how the rows are laid out. Rows are split by their id; the models are scored by exact
  accuracy on the held-out rows.
* ``best_candidate``: the highest accuracy; the first rate in grid order wins ties.
* ``register``: saves the winning model's weights under a new version and appends one registry row.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.operators.quality import Check, dq_report
from sparkwright.sinks.tables import path_exists

# Fixed value: the learning-rate grid of the tuning step.
LEARNING_RATES = (0.01, 0.05, 0.1)
MODEL_NAME = "document_quality"

FEATURES = ("n_chars", "n_words", "n_digits")
WORD = r"[^ \t\n\r\f\x0B]+"  # a maximal run of non-whitespace characters
DIGIT = r"[0-9]"

ROUNDS = 8
STEP = 50.0  # the learning rates' scale
UNIT = 100_000  # a feature is round(ln(1 + value) / 10 * UNIT)
CHANCE = 1_000_000  # a prediction is round(probability * CHANCE)
FOLDS = 4  # rows whose id modulo FOLDS is FOLDS - 1 are held out


def prepare_features(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """doc_id, label and numeric text features for every labelled document."""
    missing = {"doc_id", "text", "n_chars"} - set(docs.columns)
    if missing or {"doc_id", label_col} - set(labels.columns):
        raise ValueError(f"training input is missing columns: {sorted(missing) or [label_col]}")
    # Features are computed next to the scan, before the join: only four numbers per
    # document cross the join's exchange, never the (possibly very long) text.
    per_doc = docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.regexp_count(F.col("text"), F.lit(WORD)).cast("double").alias("n_words"),
        F.regexp_count(F.col("text"), F.lit(DIGIT)).cast("double").alias("n_digits"),
    )
    joined = per_doc.join(labels.select("doc_id", F.col(label_col).alias("label")), "doc_id")
    return joined.select("doc_id", "label", *FEATURES)


def write_features(features: DataFrame, root: str) -> DataFrame:
    """Stores the feature set at ``root``/features and returns a read of it."""
    path = os.path.join(root, "features")
    features.write.mode("overwrite").parquet(path)
    return features.sparkSession.read.schema(features.schema).parquet(path)


def feature_checks(features: DataFrame) -> DataFrame:
    """Validation report of the feature set (NULL features / labels, duplicate ids)."""
    checks = [Check(c, "not_null") for c in ("doc_id", "label", *FEATURES)] + [Check("doc_id", "unique")]
    return dq_report(features, "training_features", checks)


def feature_profile(features: DataFrame) -> DataFrame:
    """rows, feature_count and path (below the registry) of the prepared set (one row)."""
    return features.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(FEATURES)).alias("feature_count"),
                        F.lit("features").alias("path"))


def _whole(c):
    """Halves up to the next integer, as bigint."""
    return F.floor(c + 0.5).cast("bigint")


def _score(weights: tuple[float, ...]):
    z = F.lit(weights[0])
    for w, name in zip(weights[1:], FEATURES):
        z = z + F.lit(w) * (F.col(f"x_{name}") / F.lit(float(UNIT)))
    return z


def tune_learning_rate(features: DataFrame, rates=LEARNING_RATES, rounds: int = ROUNDS) -> tuple[dict[float, tuple[float, ...]], DataFrame]:
    """Fit one model per rate; returns ({rate: weights, intercept first}, scores DataFrame).

    scores: learning_rate, accuracy (rounded to 4 places; NULL without held-out rows), grid_order. Rows with a NULL
    label, id or feature are left out. ``features`` is read once a round: give a stored set.
    """
    rows = features.dropna(subset=["doc_id", "label", *FEATURES]).select(
        F.pmod("doc_id", F.lit(FOLDS)).alias("fold"), F.col("label").cast("bigint").alias("y"),
        *[_whole(F.log(F.col(c) + 1.0) / 10.0 * float(UNIT)).alias(f"x_{c}") for c in FEATURES])
    train, held_out = rows.where(F.col("fold") < FOLDS - 1), rows.where(F.col("fold") == FOLDS - 1)
    weights = {r: (0.0,) * (len(FEATURES) + 1) for r in rates}
    exact = "decimal(38,0)"
    for _ in range(rounds):
        sums = [F.count(F.lit(1)).alias("n")]
        for k, r in enumerate(rates):
            error = _whole(F.lit(float(CHANCE)) / (F.lit(1.0) + F.exp(-_score(weights[r])))) - F.col("y") * CHANCE
            sums.append(F.sum(error.cast(exact)).alias(f"g{k}_0"))
            sums += [F.sum((error * F.col(f"x_{c}")).cast(exact)).alias(f"g{k}_{j}") for j, c in enumerate(FEATURES, 1)]
        got = train.agg(*sums).first()
        if not got["n"]:
            break
        for k, r in enumerate(rates):
            new = []
            for j, w in enumerate(weights[r]):
                unit = float(CHANCE) * (float(UNIT) if j else 1.0)
                moved = w - r * STEP * (float(got[f"g{k}_{j}"]) / unit / float(got["n"]))
                new.append(math.floor(moved * 1e6 + 0.5) / 1e6)
            weights[r] = tuple(new)
    n = F.count(F.lit(1))
    right = [F.sum(((_score(weights[r]) >= 0).cast("bigint") == F.col("y")).cast("bigint")).alias(f"r{k}") for k, r in enumerate(rates)]
    got = held_out.agg(n.alias("n"), *right).first()
    scores = [(float(r), math.floor(got[f"r{k}"] * 10000.0 / got["n"] + 0.5) / 10000.0 if got["n"] else None, k) for k, r in enumerate(rates)]
    return weights, features.sparkSession.createDataFrame(scores, "learning_rate double, accuracy double, grid_order int")


def best_candidate(scores: DataFrame) -> DataFrame:
    """The row with the highest accuracy; the earliest grid entry wins a tie."""
    best = scores.agg(F.max_by(F.struct("learning_rate", "accuracy"),
                               F.struct(F.col("accuracy"), -F.col("grid_order"))).alias("b"))
    return best.select("b.learning_rate", "b.accuracy")


def mock_candidate_scores(grid: DataFrame) -> DataFrame:
    """The placeholder score of the source pipeline: round(0.91 - |lr - 0.05| * 2, 4)."""
    return grid.withColumn("accuracy", F.round(F.lit(0.91) - F.abs(F.col("learning_rate") - F.lit(0.05)) * 2, 4))


def claim_version(spark: SparkSession, registry_path: str, name: str = MODEL_NAME, after: int = 0) -> int:
    """The next free version of a model: a file of the version's name, which only one run can create."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = path_of(os.path.join(registry_path, "claims", name))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    version = max([after, *(int(s.getPath().getName()[1:]) for s in fs.listStatus(folder))]) + 1
    while not fs.createNewFile(path_of(folder, f"v{version:04d}")):
        version += 1
    return version


def register(weights: dict[float, tuple[float, ...]], best: DataFrame, registry_path: str, name: str = MODEL_NAME, as_of=None) -> DataFrame:
    """Save the model of ``best``'s rate as the next free version (two runs never share one) and append its registry row (model_path is relative to
    the registry); returns the registry."""
    spark = best.sparkSession
    rows_path = os.path.join(registry_path, "registry")
    last = spark.read.parquet(rows_path).agg(F.max("version")).first()[0] if path_exists(spark, rows_path) else None
    version = claim_version(spark, registry_path, name, last or 0)
    winner = best.first()
    model_path = f"models/{name}/v{version:04d}"
    spark.createDataFrame(list(zip(("intercept", *FEATURES), weights[winner["learning_rate"]])), "term string, weight double") \
        .write.mode("overwrite").parquet(os.path.join(registry_path, model_path))
    stamp = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    (spark.createDataFrame([winner], "learning_rate double, accuracy double")
     .select(F.lit(name).alias("model_name"), F.lit(version).alias("version"),
             F.lit(model_path).alias("model_path"), "learning_rate", "accuracy", stamp.alias("registered_at"))
     .write.mode("append").parquet(rows_path))
    return spark.read.parquet(rows_path)
