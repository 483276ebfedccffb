"""Fitted features and a learning-rate search over boosted trees.

* ``fit_features``: a ``Pipeline`` of text counts, hashed word counts, imputation and scaling; what must be learned (means of known
  values, largest values) is learned on the training folds only. The fitted ``PipelineModel`` takes raw documents and
  is stored next to the model, so that scoring uses what training used.
* ``boost``: gradient-boosted trees (logistic loss, second order), one model for each learning rate, grown side by
  side. Features are cut into quantile bins once. Each level of all rates' trees is one grouped aggregate, sums of gradients by
  (feature, bin) for each node; gradients are whole numbers, so sums, splits and leaves don't depend on how the rows are laid out.
  The driver sees sums of bins, never rows.
* ``register_boosted``: claims a version, saves trees and features, appends the registry row.

As in boosting by step size, the first tree counts in full and each later one by the learning rate.
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, Imputer, MaxAbsScaler, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwright.operators.tuning import DIGIT, FOLDS, LEARNING_RATES, WORD, claim_version
from sparkwright.session import scratch_path

HASHED = 84  # buckets of hashed word counts; with the three counts, 87 features
COUNTS = ("chars", "words", "digits")
TREES, DEPTH, BINS = 5, 2, 16
UNIT = 1_000_000  # of gradients
CALM = 1.0  # added to a leaf's second-order sum
MODEL_NAME = "document_quality_boosted"


# -- features -------------------------------------------------------------------------------------


def _text_stages() -> list:
    """What needs the text: nothing is learned here, so it runs next to the scan."""
    sql = lambda pattern: "r'" + pattern + "'"
    return [SQLTransformer(statement=(
                f"SELECT *, CAST(n_chars AS DOUBLE) AS _chars, CAST(regexp_count(text, {sql(WORD)}) AS DOUBLE) AS _words, "
                f"CAST(regexp_count(text, {sql(DIGIT)}) AS DOUBLE) AS _digits, coalesce(text, '') AS _text FROM __THIS__")),
            RegexTokenizer(inputCol="_text", outputCol="_tokens", pattern=WORD, gaps=False, toLowercase=False, minTokenLength=1),
            HashingTF(inputCol="_tokens", outputCol="_hashed", numFeatures=HASHED)]


def fit_features(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> tuple[PipelineModel, DataFrame]:
    """(fitted pipeline: documents -> vector ``features``, rows (doc_id, label, fold, x) of every labelled document).

    Rows without id or label are left out. A null n_chars or text is imputed with the training folds' mean; a
    feature without any known value there is an error. Text doesn't cross the exchange of the join.
    """
    missing = {"doc_id", "text", "n_chars"} - set(docs.columns)
    if missing or {"doc_id", label_col} - set(labels.columns):
        raise ValueError(f"training input is missing columns: {sorted(missing) or [label_col]}")
    first = PipelineModel(_text_stages())
    counted = first.transform(docs.select("doc_id", "text", "n_chars")).select("doc_id", *[f"_{c}" for c in COUNTS], "_hashed")
    known = labels.select("doc_id", F.col(label_col).cast("bigint").alias("label")).where(F.col("label").isNotNull())
    path = scratch_path(docs.sparkSession, "counted_features")  # the texts are counted once, not once for each stage that learns
    counted.join(known, "doc_id").withColumn("fold", F.pmod("doc_id", F.lit(FOLDS))).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    learned = Pipeline(stages=[
        Imputer(inputCols=[f"_{c}" for c in COUNTS], outputCols=[f"_{c}_known" for c in COUNTS], strategy="mean"),
        VectorAssembler(inputCols=[*[f"_{c}_known" for c in COUNTS], "_hashed"], outputCol="_raw"),
        MaxAbsScaler(inputCol="_raw", outputCol="features")]).fit(rows.where(F.col("fold") < FOLDS - 1))
    out = learned.transform(rows).select("doc_id", "label", "fold", vector_to_array("features").alias("x"))
    return PipelineModel([*first.stages, *learned.stages]), out


# -- trees ----------------------------------------------------------------------------------------


@dataclass
class Tree:
    """A binary tree of ``DEPTH`` levels: node k has the children 2k + 1 and 2k + 2. A row goes left if its bin is at most the split's."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)  # node -> (feature, bin)
    values: dict[int, float] = field(default_factory=dict)  # leaf -> margin

    def walk(self, goes_left, at_leaf, node: int = 0):
        if node not in self.splits:
            return at_leaf(node)
        return F.when(goes_left(*self.splits[node]), self.walk(goes_left, at_leaf, 2 * node + 1)).otherwise(self.walk(goes_left, at_leaf, 2 * node + 2))


def _in_bins(f: int, b: int) -> Column:
    return F.col("b")[f] <= b


def _margin(start: float, trees: list[Tree], goes_left=_in_bins) -> Column:
    out = F.lit(start)
    for tree in trees:
        out = out + tree.walk(goes_left, lambda n, t=tree: F.lit(t.values.get(n, 0.0)))
    return out


def quantile_cuts(rows: DataFrame, bins: int = BINS) -> list[list[float]]:
    """For each feature of ``x``, up to ``bins`` - 1 values of it that cut the rows evenly (exact, of distinct values with counts)."""
    counts = rows.select(F.posexplode("x").alias("f", "v")).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("f").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of_all = Window.partitionBy("f")
    below = counts.select("f", "v", F.sum("n").over(upto).alias("upto"), F.sum("n").over(of_all).alias("total"), F.max("v").over(of_all).alias("most"))
    # v is the cut for every quantile j that its rows reach first.
    cuts = below.select("f", "v", F.explode(F.sequence(F.lit(1), F.lit(bins - 1))).alias("j"), "upto", "total", "most").where(
        (F.col("upto") * bins >= F.col("total") * F.col("j")) & (F.col("v") < F.col("most"))).groupBy("f", "j").agg(F.min("v").alias("v"))
    found: dict[int, set] = {}
    for r in cuts.select("f", "v").distinct().collect():  # at most features * bins
        found.setdefault(r["f"], set()).add(r["v"])
    return [sorted(found.get(f, ())) for f in range(max(found, default=-1) + 1)]


def binned(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """``rows`` with ``b``: for each feature, how many of its cuts its value is above."""
    all_cuts = F.array(*[F.array(*map(F.lit, c)).cast("array<double>") for c in cuts])
    below = lambda v, i: F.size(F.filter(F.get(all_cuts, i), lambda cut: v > cut))
    return rows.withColumn("b", F.transform(F.slice("x", 1, len(cuts)), below) if cuts else F.array().cast("array<int>"))


def boost(rows: DataFrame, rates=LEARNING_RATES, trees: int = TREES, depth: int = DEPTH) -> tuple[float, dict[float, list[Tree]], DataFrame]:
    """(starting margin, {rate: trees}, scores) from rows (label 0/1, fold, b); give a stored table: each level reads it once.

    scores: learning_rate, accuracy on the held-out fold (4 places; NULL without such rows), grid_order.
    """
    spark = rows.sparkSession
    train, held_out = rows.where(F.col("fold") < FOLDS - 1), rows.where(F.col("fold") == FOLDS - 1)
    n, ones = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    start = round(math.log((ones + 1) / (n - ones + 1)), 6)
    models: dict[float, list[Tree]] = {r: [] for r in rates}
    for k in range(trees if n else 0):
        grown = {r: Tree() for r in rates}
        frontier = {r: [0] for r in rates}
        for level in range(depth):
            sums = _node_sums(train, start, models, grown, frontier)
            for r in rates:
                frontier[r] = _grow(grown[r], frontier[r], sums[r], level + 1 == depth, 1.0 if k == 0 else r)
            if not any(frontier.values()):
                break
        for r in rates:
            models[r].append(grown[r])
    right = [F.sum(((_margin(start, models[r]) >= 0).cast("bigint") == F.col("label")).cast("bigint")).alias(f"r{i}") for i, r in enumerate(rates)]
    got = held_out.agg(F.count(F.lit(1)).alias("n"), *right).first()
    scores = [(float(r), math.floor(got[f"r{i}"] * 10000.0 / got["n"] + 0.5) / 10000.0 if got["n"] else None, i) for i, r in enumerate(rates)]
    return start, models, spark.createDataFrame(scores, "learning_rate double, accuracy double, grid_order int")


def _node_sums(train: DataFrame, start: float, models: dict, grown: dict, frontier: dict) -> dict:
    """{rate: {(node, feature, bin): (gradients, second-order sums, rows)}}, by one aggregate for all rates."""
    columns, sums = [], []
    for i, r in enumerate(models):
        chance = F.floor(F.lit(float(UNIT)) / (F.lit(1.0) + F.exp(-_margin(start, models[r]))) + 0.5).cast("bigint")
        columns += [chance.alias(f"p{i}"), grown[r].walk(_in_bins, lambda node: F.lit(node)).alias(f"node{i}")]
        for node in frontier[r]:
            own, p = F.col(f"node{i}") == node, F.col(f"p{i}")
            # Whole numbers of at most UNIT a row: 64 bits hold the sums of 10^12 rows, and an overflow fails.
            sums += [F.sum(F.when(own, p - F.col("label") * UNIT)).alias(f"g{i}_{node}"),
                     F.sum(F.when(own, F.greatest(F.expr(f"p{i} * ({UNIT} - p{i}) div {UNIT}"), F.lit(1)))).alias(f"h{i}_{node}"),
                     F.count(F.when(own, 1)).alias(f"n{i}_{node}")]
    cells = train.select("label", "b", *columns).select("label", *[c for i in range(len(models)) for c in (f"p{i}", f"node{i}")], F.posexplode("b").alias("f", "bin"))
    out: dict = {r: {} for r in models}
    for row in cells.groupBy("f", "bin").agg(*sums).collect():  # a row for each feature and bin
        for i, r in enumerate(models):
            for node in frontier[r]:
                if row[f"n{i}_{node}"]:
                    out[r][node, row["f"], row["bin"]] = int(row[f"g{i}_{node}"]), int(row[f"h{i}_{node}"]), row[f"n{i}_{node}"]
    return out


def _grow(tree: Tree, frontier: list[int], sums: dict, last: bool, weight: float) -> list[int]:
    """Splits the frontier's nodes, or gives them their values; returns the new frontier. On the ``last`` level the
    children get their values from the split's own sums."""
    calm, new = CALM * UNIT, []
    value = lambda g, h: math.floor(-weight * g / (h + calm) * 1e6 + 0.5) / 1e6
    for node in frontier:
        by_feature: dict[int, dict[int, tuple]] = {}
        for (at, f, b), s in sums.items():
            if at == node:
                by_feature.setdefault(f, {})[b] = s
        if not by_feature:
            tree.values[node] = 0.0
            continue
        g, h, _ = (sum(x) for x in zip(*by_feature[min(by_feature)].values()))
        best = (0.0, None)
        for f in sorted(by_feature):
            left_g = left_h = 0
            for b in sorted(by_feature[f])[:-1]:
                left_g, left_h = left_g + by_feature[f][b][0], left_h + by_feature[f][b][1]
                gain = left_g ** 2 / (left_h + calm) + (g - left_g) ** 2 / (h - left_h + calm) - g ** 2 / (h + calm)
                if gain > best[0]:
                    best = (gain, (f, b), left_g, left_h)
        if best[1] is None:
            tree.values[node] = value(g, h)
            continue
        tree.splits[node] = best[1]
        if last:
            tree.values[2 * node + 1], tree.values[2 * node + 2] = value(best[2], best[3]), value(g - best[2], h - best[3])
        else:
            new += [2 * node + 1, 2 * node + 2]
    return new


# -- registry -------------------------------------------------------------------------------------


def register_boosted(pipeline: PipelineModel, cuts: list[list[float]], start: float, models: dict[float, list[Tree]], best: DataFrame,
                     registry_path: str, name: str = MODEL_NAME, as_of=None) -> DataFrame:
    """Saves the winner's trees (splits by value) and the fitted features under a version of their own, appends the registry row
    (paths are relative to the registry), and returns the registry."""
    spark = best.sparkSession
    winner = best.first()
    version = claim_version(spark, registry_path, name)
    place = f"models/{name}/v{version:04d}"
    rows = [(-1, 0, None, None, start)]
    for k, tree in enumerate(models[winner["learning_rate"]]):
        rows += [(k, node, f, cuts[f][b], None) for node, (f, b) in tree.splits.items()]
        rows += [(k, node, None, None, v) for node, v in tree.values.items()]
    spark.createDataFrame(rows, "tree int, node int, feature int, cut double, value double").coalesce(1).write.parquet(os.path.join(registry_path, place, "trees"))
    pipeline.write().save(os.path.join(registry_path, place, "features"))
    stamp = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    (spark.createDataFrame([winner], "learning_rate double, accuracy double")
     .select(F.lit(name).alias("model_name"), F.lit(version).alias("version"), F.lit(f"{place}/trees").alias("model_path"),
             F.lit(f"{place}/features").alias("features_path"), "learning_rate", "accuracy", stamp.alias("registered_at"))
     .write.mode("append").parquet(os.path.join(registry_path, "boosted_registry")))
    return spark.read.parquet(os.path.join(registry_path, "boosted_registry"))


def score_documents(spark: SparkSession, registry_path: str, entry, docs: DataFrame) -> DataFrame:
    """doc_id, margin, predicted of raw documents, by the stored features and trees of a registry row."""
    pipeline = PipelineModel.load(os.path.join(registry_path, entry["features_path"]))
    trees: dict[int, Tree] = {}
    cut_of: dict[tuple[int, int], float] = {}
    start = 0.0
    for r in spark.read.parquet(os.path.join(registry_path, entry["model_path"])).collect():  # a row for each node
        tree = trees.setdefault(r["tree"], Tree())
        if r["tree"] < 0:
            start = r["value"]
        elif r["feature"] is None:
            tree.values[r["node"]] = r["value"]
        else:
            tree.splits[r["node"]] = (r["feature"], len(cut_of))
            cut_of[r["feature"], len(cut_of)] = r["cut"]
    own = [trees[k] for k in sorted(trees) if k >= 0]
    margin = _margin(start, own, lambda f, key: F.col("x")[f] <= cut_of[f, key])
    rows = pipeline.transform(docs.select("doc_id", "text", "n_chars")).select("doc_id", vector_to_array("features").alias("x"))
    return rows.select("doc_id", margin.alias("margin"), (margin >= 0).cast("int").alias("predicted"))
