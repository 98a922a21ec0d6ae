"""Training, scoring and tuning jobs on MLlib's tree learners."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, ratio, require_some
from ..session import materialize, scratch_path
from .gain import BREAK_EVEN, best_point, gain_at_threshold, gain_curve, gain_sum, plateau_gain
from .labels import CONTACT, HIT
from .ordering import rank_counts, running_totals
from .sampling import canaries, partition

FEATURES, LABEL, WEIGHT = "features", "target", "weight"
MISSING = -999.0

Maker = Callable[[int], Estimator]


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), missing: float = MISSING) -> DataFrame:
    """Feature vector and the columns a job needs, nothing else; a missing value becomes a value below all."""
    require_some(features, "assemble")
    filled = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(missing)).alias(f"_f_{c}") for c in features])
    vector = VectorAssembler(inputCols=[f"_f_{c}" for c in features], outputCol=FEATURES).transform(filled)
    return vector.select(*keep, FEATURES)


def boosted_trees(**params: Any) -> Maker:
    return lambda seed: GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=seed, **params)


def random_forest(**params: Any) -> Maker:
    return lambda seed: RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=seed, **params)


def single_tree(**params: Any) -> Maker:
    return lambda seed: DecisionTreeClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=seed, **params)


def subspace_trees(n_trees: int, column_share: float = 0.5, **params: Any) -> Maker:
    """Bagged trees that see a share of the columns."""
    return random_forest(numTrees=n_trees, featureSubsetStrategy=str(column_share), **params)


def scaled_min_leaf(min_leaf: int, ratio: float) -> int:
    """Rows per leaf for the whole data, tuned on a sample of the given ratio."""
    if ratio <= 0:
        raise ValueError("the sampling ratio must be positive")
    return max(1, round(min_leaf / ratio))


def scaled_min_leaf_column(min_leaf: Column, ratio: float) -> Column:
    """The same for a column of sizes, of any size."""
    if ratio <= 0:
        raise ValueError("the sampling ratio must be positive")
    return F.greatest(F.lit(1), F.rint(min_leaf / F.lit(float(ratio))).cast("int"))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def fit_seeds(matrix: DataFrame, maker: Maker, seeds: Iterable[int], folder: str | None = None) -> dict[int, Model]:
    """One model per seed. With ``folder`` they are saved there, and a model already there is not trained again.

    A saved model is known by its learner, parameters, features, seed and training rows, in any order.
    """
    spark, models = matrix.sparkSession, {}
    rows = _digest(matrix) if folder else None
    for seed in seeds:
        path = f"{folder}/model-{seed}-{_fingerprint(maker(seed), matrix, rows)}" if folder else None
        # a save that was cut short leaves no success mark and is done again
        if path and _exists(spark, f"{path}/metadata/_SUCCESS") and _exists(spark, f"{path}/data/_SUCCESS"):
            models[seed] = _load(path, maker(seed))
            continue
        models[seed] = maker(seed).fit(matrix)
        if path:
            models[seed].write().overwrite().save(path)
    return models


def _digest(matrix: DataFrame) -> str:
    """Count and sum of the rows' hashes: the same for any order of the same rows, in one pass without a shuffle of rows."""
    row = F.struct(*[vector_to_array(c).alias(c) if c == FEATURES else F.col(c) for c in sorted(matrix.columns)])
    hashes = [F.sum(F.xxhash64(row, F.lit(i)).cast("decimal(38,0)")).cast("string") for i in (0, 1)]
    return "|".join(str(v) for v in matrix.agg(F.count(F.lit(1)).cast("string"), *hashes).first())


def _fingerprint(estimator: Estimator, matrix: DataFrame, rows: str) -> str:
    params = sorted((p.name, repr(v)) for p, v in estimator.extractParamMap().items())
    columns = json.dumps(matrix.schema[FEATURES].metadata, sort_keys=True)
    return hashlib.sha256(repr((type(estimator).__name__, params, columns, rows)).encode()).hexdigest()[:32]


def _load(path: str, estimator: Estimator) -> Model:
    from pyspark.ml import classification

    return getattr(classification, type(estimator).__name__.replace("Classifier", "ClassificationModel")).load(path)


def probability(model: Model, matrix: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(matrix).select(*keep, vector_to_array("probability")[1].alias("prob"))


def score(models: Mapping[int, Model], matrix: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Long prediction table: ``model``, key columns, ``prob``. All models are applied in one pass over the matrix."""
    wide, entries = matrix, []
    for number, (seed, model) in enumerate(models.items()):
        name = f"_probability_{number}"
        own = model.copy().setProbabilityCol(name).setRawPredictionCol("").setPredictionCol("")
        wide = own.transform(wide)
        entries.append(F.struct(F.lit(seed).alias("model"), vector_to_array(name)[1].alias("prob")))
    long = wide.select(*keep, F.explode(F.array(*entries)).alias("_s"))
    return long.select(F.col("_s.model").alias("model"), *keep, F.col("_s.prob").alias("prob"))


def node_table(spark: SparkSession, model: Model, path: str) -> DataFrame:
    """Nodes of every tree, read from the model's own saved form: tree, node, feature, threshold, leaf."""
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        nodes = nodes.select(F.lit(0).alias("tree"), "*")
    split = F.col("split")
    return nodes.select("tree", F.col("id").alias("node"), (F.col("leftChild") < 0).alias("leaf"), "impurity",
                        F.col("rawCount").alias("rows"),
                        F.when(F.col("leftChild") >= 0, split.featureIndex).alias("feature"),
                        F.when((F.col("leftChild") >= 0) & (split.numCategories == -1),
                               split.leftCategoriesOrThreshold[0]).alias("threshold"))


def split_points(nodes: DataFrame, features: Sequence[str], feature: str) -> DataFrame:
    """Where the trees cut one feature, and how often."""
    at = list(features).index(feature)
    return nodes.filter(F.col("feature") == at).groupBy("threshold").agg(F.count(F.lit(1)).alias("n"))


def tree_shapes(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("nodes"), F.count_if("leaf").alias("leaves"))


def importances(spark: SparkSession, model: Model, features: Sequence[str], top: int | None = None) -> DataFrame:
    """Features by gain-type importance, largest first."""
    values = model.featureImportances.toArray()
    rows = sorted(zip(features, (float(v) for v in values)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


def split_importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features by how often the trees split on them, and by the rows that those splits saw; unused ones have 0."""
    names = F.array(*[F.lit(f) for f in features])
    used = nodes.filter(F.col("feature").isNotNull()).groupBy("feature").agg(F.count(F.lit(1)).alias("splits"), F.sum("rows").alias("cover"))
    every = nodes.sparkSession.range(len(features)).withColumnRenamed("id", "feature")
    return every.join(used, "feature", "left").select(
        F.get(names, F.col("feature").cast("int")).alias("feature"),
        F.coalesce("splits", F.lit(0)).alias("splits"), F.coalesce("cover", F.lit(0)).cast("long").alias("cover"))


def leaf_features(train: DataFrame, df: DataFrame, features: Sequence[str], keep: Sequence[str], n_trees: int = 20,
                  depth: int = 4, seed: int = 1, prefix: str = "rf") -> DataFrame:
    """0/1 columns ``rf_{tree}_{leaf}`` of a forest's leaves.

    The column list comes from the trees, so every month has every column whether or not a row falls there.
    """
    forest = RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=seed, numTrees=n_trees, maxDepth=depth,
                                    leafCol="_leaves").fit(assemble(train, features, [LABEL]))
    at = leaves(forest, assemble(df, features, keep), keep)
    names = []
    for tree, leaf_count in enumerate(leaf_counts(forest)):
        names += [(tree, leaf) for leaf in range(leaf_count)]
    return at.select(*keep, *[(F.col("leaves")[t] == leaf).cast("int").alias(f"{prefix}_{t + 1:03d}_{leaf:03d}")
                              for t, leaf in names])


def leaf_counts(forest: RandomForestClassificationModel) -> list[int]:
    # a binary tree has one leaf more than it has splits
    return [(tree.numNodes + 1) // 2 for tree in forest.trees]


def leaves(forest: RandomForestClassificationModel, matrix: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Leaf number of every tree, as an array per row."""
    quiet = forest.copy().setLeafCol("_leaves").setProbabilityCol("").setRawPredictionCol("").setPredictionCol("")
    scored = quiet.transform(matrix)
    return scored.select(*keep, F.transform(vector_to_array("_leaves"), lambda x: x.cast("int")).alias("leaves"))


def leaf_probabilities(spark: SparkSession, forest: RandomForestClassificationModel, path: str) -> DataFrame:
    """One row with an array per tree: the probability of label 1 in every leaf, in the order of ``leaves``.

    Its size is that of the forest. Leaves are numbered from left to right, as the saved nodes are.
    """
    forest.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").filter("leftChild < 0")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda s, x: s + x)
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct(
        "id", F.try_divide(F.col("impurityStats")[1], total).alias("p")))).alias("found"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", F.col("found.p").alias("p")))).alias("trees")).select(
        F.col("trees.p").alias("probabilities"))


def tree_votes(forest: RandomForestClassificationModel, matrix: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Probability of label 1 in every tree of a fitted forest, as an array ``votes`` per row."""
    spark = matrix.sparkSession
    table = leaf_probabilities(spark, forest, scratch_path(spark, "forest")).scalar()
    placed = leaves(forest, matrix, keep).withColumn("_table", table)
    return placed.select(*keep, F.zip_with("leaves", "_table", lambda leaf, p: F.get(p, leaf)).alias("votes"))


def forest_growth(forest: RandomForestClassificationModel, matrix: DataFrame, truth: str,
                  sizes: Sequence[int] = tuple(2**i for i in range(10))) -> DataFrame:
    """Gain at break-even of a fitted forest's first 1, 2, 4, ... trees: ``tree, ganancia``.

    The trees between two sizes sum their votes while they score, so no row is moved; sizes beyond the forest are left out.
    """
    sizes = sorted({s for s in sizes if s <= forest.getNumTrees})
    require_some(sizes, "forest_growth")
    trees = forest._java_obj.trees()
    rows, votes, gains = matrix.select(truth, FEATURES), F.lit(0.0), []
    for number, (before, size) in enumerate(zip([0, *sizes], sizes)):
        more = forest_of([trees[i] for i in range(before, size)], forest.numFeatures, forest.numClasses)
        rows = more.setRawPredictionCol(f"_s{number}").setProbabilityCol("").setPredictionCol("").transform(rows)
        votes = votes + F.get(vector_to_array(f"_s{number}"), F.lit(1))
        gains.append((size, votes))
    # one sum per size is made before the sums are compared, so none is made twice
    rows = rows.select(truth, *[v.alias(f"_v{size}") for size, v in gains])
    sums = [F.struct(F.lit(size).alias("tree"), gain_sum(F.col(f"_v{size}") > F.lit(size * BREAK_EVEN), truth).alias("ganancia"))
            for size, _ in gains]
    return rows.agg(F.array(*sums).alias("g")).select(F.explode("g").alias("g")).select("g.*")


def forest_of(trees: Sequence[Any], num_features: int, num_classes: int) -> RandomForestClassificationModel:
    """A forest of fitted trees, given as they stand in the JVM."""
    context = SparkSession.active().sparkContext
    kinds = context._jvm.org.apache.spark.ml.classification
    held = context._gateway.new_array(kinds.DecisionTreeClassificationModel, len(trees))
    for at, tree in enumerate(trees):
        held[at] = tree
    forest = kinds.RandomForestClassificationModel(held, num_features, num_classes)
    forest.set(forest.numTrees(), len(trees))
    return RandomForestClassificationModel(forest).setFeaturesCol(FEATURES)


def fit_in_blocks(matrix: DataFrame, make: Callable[[int], Maker], n_trees: int, seed: int,
                  block: int = 64) -> RandomForestClassificationModel:
    """A forest of many trees from fits of at most ``block`` trees each; ``make(n)`` makes the learner of n trees.

    The learner holds one bag count per row and tree, so what a row takes while a block is fitted does not grow with the forest.
    """
    parts = -(-n_trees // block)
    sizes = [n_trees * (i + 1) // parts - n_trees * i // parts for i in range(parts)]
    # the learner's bags are seeded by seed + partition, so seeds of blocks lie far apart
    forests = [make(size)(seed + 1_000_003 * i).fit(matrix) for i, size in enumerate(sizes)]
    held = [(forest, forest._java_obj.trees()) for forest in forests]
    trees = [trees[i] for forest, trees in held for i in range(forest.getNumTrees)]
    return forest_of(trees, forests[0].numFeatures, max(f.numClasses for f in forests))


def canary_selection(df: DataFrame, features: Sequence[str], n_canaries: int, seed: int, depth: int = 5,
                     n_trees: int = 20, keys: Keys = KEYS) -> DataFrame:
    """Features with their importance and whether they beat the best pure-noise column."""
    noisy = canaries(df, n_canaries, seed, keys=keys)
    noise = [f"canarito_{i}" for i in range(1, n_canaries + 1)]
    names = [*noise, *features]
    forest = random_forest(numTrees=n_trees, maxDepth=depth)(seed).fit(assemble(noisy, names, [LABEL]))
    values = dict(zip(names, (float(v) for v in forest.featureImportances.toArray())))
    bar = max(values[c] for c in noise)
    rows = sorted(((c, values[c], values[c] > bar) for c in features), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, kept boolean")


class GainEvaluator(Evaluator):
    """Best point of the gain curve (or its plateau), for MLlib's tuning classes."""

    def __init__(self, ties: Sequence[str], window: int | None = None, share: float = 1.0):
        super().__init__()
        self.ties, self.window, self.share = list(ties), window, share

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(*self.ties, LABEL, vector_to_array("probability")[1].alias("prob"))
        curve = gain_curve(scored, "prob", LABEL, self.ties)
        if self.window:
            found = plateau_gain(curve, self.window).first()[0]
        else:
            found = best_point(curve, "prob").first()["ganancia_max"]
        return float(found or 0.0) / self.share

    def isLargerBetter(self) -> bool:
        return True


def cross_validate(df: DataFrame, features: Sequence[str], strata: Sequence[str], maker: Maker,
                   grid: Mapping[str, Sequence[Any]], folds: int = 5, seed: int = 1, weight: str | None = None,
                   keys: Keys = KEYS) -> DataFrame:
    """Gain of every parameter setting over stratified folds, brought to the size of the whole."""
    folded = partition(df, [1] * folds, strata, seed, first=0, keys=keys)
    keep = [*keys.pair, LABEL, "fold", *([weight] if weight else [])]
    matrix = materialize(assemble(folded, features, keep), "cv")
    estimator = maker(seed)
    if weight:
        estimator = estimator.setWeightCol(weight)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    settings = builder.build()
    sizes = {r["fold"]: r["count"] for r in matrix.groupBy("fold").count().collect()}
    for fold in range(folds):
        if sizes.get(fold, 0) in (0, sum(sizes.values())):
            raise ValueError(f"fold {fold} leaves no rows to train or to validate on")
    # every row is scored by the models that have not seen it, and all curves are drawn in one pass
    scored = reduce(DataFrame.unionByName, [
        _scores_of_settings(estimator, settings, matrix.filter(F.col("fold") != fold), matrix.filter(F.col("fold") == fold), [*keys.pair, LABEL, "fold"])
        for fold in range(folds)])
    by = ["fold", "_setting"]
    best = best_point(gain_curve(scored, "prob", LABEL, keys.pair, by=by), "prob", by).collect()
    gains = [[0.0] * len(settings) for _ in range(folds)]
    for r in best:
        gains[r["fold"]][r["_setting"]] = float(r["ganancia_max"] or 0.0) / (1 / folds)
    means = [sum(column) / folds for column in zip(*gains)]
    rows = [(*[s[estimator.getParam(n)] for n in grid], g) for s, g in zip(settings, means)]
    return df.sparkSession.createDataFrame(rows, [*grid, "ganancia"])


def _scores_of_settings(estimator: Estimator, settings: Sequence[Mapping[Any, Any]], train: DataFrame, unseen: DataFrame,
                        keep: Sequence[str]) -> DataFrame:
    """``keep``, ``_setting`` and ``prob`` of the unseen rows under every setting.

    Single trees that differ in their depth only are one tree, cut: the deepest is fitted for all of them.
    """
    alike: dict[tuple, list[int]] = {}
    for number, setting in enumerate(settings):
        alone = () if isinstance(estimator, DecisionTreeClassifier) else (number,)
        rest = sorted((p.name, repr(v)) for p, v in setting.items() if p.name != "maxDepth")
        alike.setdefault((*alone, *rest), []).append(number)
    wide, entries = unseen, []

    def entry(number: int, prob: Column) -> Column:
        return F.struct(F.lit(number).alias("_setting"), prob.alias("prob"))

    for numbers in alike.values():
        depths = {n: estimator.copy(settings[n]).getOrDefault("maxDepth") for n in numbers} if len(numbers) > 1 else {}
        deepest = max(numbers, key=lambda n: depths.get(n, 0))
        model = estimator.fit(train, settings[deepest])
        if depths and model.numClasses <= 2:
            leaf = f"_leaf_{deepest}"
            wide = model.copy().setLeafCol(leaf).setProbabilityCol("").setRawPredictionCol("").setPredictionCol("").transform(wide)
            found = leaf_probabilities_at(train.sparkSession, model, [depths[n] for n in numbers])
            table = train.sparkSession.createDataFrame([(found,)], "t array<array<double>>").scalar()
            wide = wide.withColumn(f"_table_{deepest}", table)
            entries += [entry(n, F.get(F.get(f"_table_{deepest}", F.lit(i)), F.col(leaf).cast("int"))) for i, n in enumerate(numbers)]
            continue
        for n in numbers:
            own = model if n == deepest else estimator.fit(train, settings[n])
            wide = own.copy().setProbabilityCol(f"_p_{n}").setRawPredictionCol("").setPredictionCol("").transform(wide)
            entries.append(entry(n, vector_to_array(f"_p_{n}")[1]))
    return wide.select(*keep, F.explode(F.array(*entries)).alias("_s")).select(*keep, "_s.*")


def sampled_settings(ranges: Mapping[str, tuple[float, float]], n: int, seed: int,
                     whole: Iterable[str] = ()) -> list[dict[str, float]]:
    """Random-search settings; a range named ``*_exp`` is searched as a power of two."""
    import random

    draw, out = random.Random(seed), []
    for _ in range(n):
        setting = {}
        for name, (low, high) in ranges.items():
            value = draw.uniform(low, high)
            if name.endswith("_exp"):
                name, value = name[:-4], 2**value
            setting[name] = int(round(value)) if name in set(whole) else value
        out.append(setting)
    return out


def search(train: DataFrame, validate: DataFrame, features: Sequence[str], make: Callable[..., Maker],
           settings: Sequence[Mapping[str, Any]], seeds: Sequence[int], window: int | None = None,
           fits: Callable[[Mapping[str, Any], int], bool] | None = None, keys: Keys = KEYS) -> DataFrame:
    """Trial table: gain of the seed ensemble under every setting, and its mean AUC.

    ``fits(setting, rows)`` rejects a setting before it is trained, e.g. when leaves times rows per leaf
    exceed the table. Both matrices are written once and reused by all trials.
    """
    spark = train.sparkSession
    matrix = materialize(assemble(train, features, [LABEL]), "train")
    target = materialize(assemble(validate, features, [*keys.pair, LABEL]), "validate")
    n_train = matrix.count()
    if not n_train or target.isEmpty():
        raise ValueError("search needs rows to train and to validate on")
    # equal settings are one model
    names = [repr(sorted(s.items())) for s in settings]
    wanted = {name: s for name, s in zip(names, settings) if not fits or fits(s, n_train)}
    todo, results = list(wanted), {}
    for start in range(0, len(todo), TRIALS_AT_ONCE):
        some = todo[start:start + TRIALS_AT_ONCE]
        found = _trials(target, [fit_seeds(matrix, make(**wanted[name]), seeds) for name in some], keys, window)
        results |= {name: found[i] for i, name in enumerate(some)}
    rows = [(number, {k: float(v) for k, v in setting.items()}, *results.get(name, (None, None)), "COMPLETE" if name in results else "PRUNED")
            for number, (name, setting) in enumerate(zip(names, settings))]
    return spark.createDataFrame(
        rows, "trial_number int, params map<string,double>, value double, auc double, state string")


TRIALS_AT_ONCE = 8


def _trials(target: DataFrame, ensembles: Sequence[Mapping[int, Model]], keys: Keys, window: int | None) -> dict[int, tuple[float, float]]:
    """Gain and AUC of several seed ensembles: one pass scores the rows, one joins repeated keys, one orders them all."""
    entity, wide, sums = [*keys.pair, LABEL], target, []
    for number, models in enumerate(ensembles):
        votes = []
        for seed, model in models.items():
            votes.append(f"_p_{number}_{seed}")
            wide = model.copy().setProbabilityCol(votes[-1]).setRawPredictionCol("").setPredictionCol("").transform(wide)
        sums.append(reduce(lambda a, b: a + b, [vector_to_array(v)[1] for v in votes]).alias(f"_s{number}"))
    counted = wide.select(*entity, *sums).groupBy(*entity).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))])
    means = F.array(*[F.struct(F.lit(i).alias("trial"), ratio(F.col(f"_s{i}"), F.col("_n") * len(models)).alias("prob")) for i, models in enumerate(ensembles)])
    long = materialize(counted.select(*entity, F.explode(means).alias("_t")).select(*entity, "_t.*"), "trials")
    curve = gain_curve(long, "prob", LABEL, keys.pair, by=["trial"])
    if window:
        values = {r["trial"]: r["ganancia_meseta"] for r in plateau_gain(curve, window, by=["trial"]).collect()}
    else:
        values = {r["trial"]: r["ganancia_max"] for r in best_point(curve, "prob", ["trial"]).collect()}
    areas = {r["trial"]: r for r in _areas(long).collect()}
    return {i: (float(values[i]), _area(areas[i])) for i in values}


def _areas(long: DataFrame) -> DataFrame:
    """Per trial its positives, negatives, and twice the pairs that the score puts in order; scores are counted before they are ordered."""
    counts = long.groupBy("trial", "prob").agg(F.count_if(F.col(LABEL) == 1).alias("_y"), F.count_if(F.coalesce(F.col(LABEL) != 1, F.lit(True))).alias("_x"))
    ordered = running_totals(counts, "prob", [], by=["trial"], sums={"_upto": "_x"})
    pairs = F.sum(F.col("_y").cast("decimal(19,0)") * (2 * F.col("_upto") - F.col("_x")).cast("decimal(19,0)"))
    return ordered.groupBy("trial").agg(F.sum("_y").alias("pos"), F.sum("_x").alias("neg"), pairs.cast("double").alias("pairs"))


def _area(r: Any) -> float:
    # without one of the labels the curve runs along an edge, as the learner's evaluator has it
    return r["pairs"] / (2.0 * r["pos"] * r["neg"]) if r["pos"] and r["neg"] else float(not r["neg"])


def auc(df: DataFrame, prob: str, label: str = LABEL) -> float:
    """Area under the curve over all distinct scores."""
    scored = df.select(F.col(prob).cast("double").alias("p"), F.col(label).cast("double").alias("y"))
    return BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0).evaluate(scored)


def auc_by(df: DataFrame, prob: str, label: str, by: Sequence[str]) -> DataFrame:
    """Exact area under the curve of every group, ``auc``, by the rank sum of its positives; ties share their mean rank.

    Rows without score or label are left out; a group without both labels has no area (null).
    """
    by = list(by)
    known = df.filter(F.col(prob).isNotNull() & F.col(label).isNotNull()).select(*by, F.col(prob).alias("_p"), (F.col(label) == 1).alias("_y"))
    ranked = rank_counts(known, "_p", by)
    # twice the mean rank is a whole number, so the sum is exact
    sums = ranked.groupBy(*by).agg(F.sum(F.when(F.col("_y"), (2 * F.col("_rank") + F.col("_ties") - 1).cast("decimal(38,0)"))).alias("_r"),
                                   F.count_if("_y").alias("_pos"), F.count_if(~F.col("_y")).alias("_neg"))
    above = F.col("_r") - F.col("_pos").cast("decimal(18,0)") * (F.col("_pos") + 1).cast("decimal(18,0)")
    return sums.select(*by, F.try_divide(above.cast("double"), F.lit(2.0) * F.col("_pos") * F.col("_neg")).alias("auc"))


def depth_sweep(train: DataFrame, test: DataFrame, features: Sequence[str], depths: Iterable[int],
                seed: int = 1) -> DataFrame:
    """Train and test gain of one tree per depth: where it starts to overfit.

    A tree grows level by level, so the tree of a smaller depth is the deepest one cut there. That one is trained, the
    test rows are counted in its leaves, and all depths are read off its nodes; the driver holds no more than the tree.
    """
    depths = list(depths)
    fitted, unseen = materialize(assemble(train, features, [LABEL]), "train"), materialize(assemble(test, features, [LABEL]), "test")
    model = single_tree(maxDepth=max(depths), minInstancesPerNode=1)(seed).fit(fitted)
    gains = tree_cut_gains(model, unseen, depths)
    rows = [(depth, *gains[depth]) for depth in depths]
    return train.sparkSession.createDataFrame(rows, "max_depth int, ganancia_train double, ganancia_test double")


def tree_cut_gains(model: Model, unseen: DataFrame, depths: Iterable[int]) -> dict[int, tuple[float, float]]:
    """Gain at break-even on the training rows and on others of a fitted tree cut at each depth, as the learner would
    have grown it: leaves of one prediction beside each other are one leaf."""
    import numpy as np

    left, right, trained = _saved_nodes(unseen.sparkSession, model)
    # leaves are numbered from left to right, as the saved nodes are
    placed = model.copy().setLeafCol("_leaf").setProbabilityCol("").setRawPredictionCol("").setPredictionCol("").transform(unseen)
    met = placed.groupBy(F.col("_leaf").cast("long").alias("leaf"), F.coalesce((F.col(LABEL) == 1).cast("int"), F.lit(0)).alias("y")).agg(
        F.count(F.lit(1)).alias("n")).toArrow()
    counted = np.zeros_like(trained)
    counted[np.flatnonzero(left < 0)[met["leaf"].to_numpy()], met["y"].to_numpy()] = met["n"].to_numpy()
    levels = _levels(left, right)
    for level in reversed(levels):
        inner = level[left[level] >= 0]
        counted[inner] = counted[left[inner]] + counted[right[inner]]
    chosen = trained[:, 1] / trained.sum(axis=1) > BREAK_EVEN
    earned = [n @ np.array([-CONTACT, HIT]) for n in (trained, counted)]
    found = {}
    for depth in depths:
        last = np.zeros(len(left), dtype=bool)
        last[np.unique(_leaves_at(left, right, trained, levels, depth)[left < 0])] = True
        found[depth] = tuple(float(e[last & chosen].sum()) for e in earned)
    return found


def leaf_probabilities_at(spark: SparkSession, model: Model, depths: Sequence[int]) -> list[list[float]]:
    """Probability of label 1 that a fitted tree of two classes, cut at each depth, gives the rows of each of its leaves."""
    left, right, trained = _saved_nodes(spark, model)
    levels, share = _levels(left, right), trained[:, 1] / trained.sum(axis=1)
    return [share[_leaves_at(left, right, trained, levels, depth)[left < 0]].tolist() for depth in depths]


def _saved_nodes(spark: SparkSession, model: Model) -> tuple:
    """Children and label counts of a tree's nodes, from its saved form."""
    import numpy as np

    path = scratch_path(spark, "tree")
    model.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data")
    saved = (saved.select("nodeData.*") if "nodeData" in saved.columns else saved).select(
        "id", "leftChild", "rightChild", F.col("impurityStats")[0].alias("n0"), F.coalesce(F.get("impurityStats", F.lit(1)), F.lit(0.0)).alias("n1"))
    nodes = saved.orderBy("id").toArrow()
    left, right = (nodes[c].to_numpy().astype("int64") for c in ("leftChild", "rightChild"))
    return left, right, np.stack([nodes[c].to_numpy() for c in ("n0", "n1")], axis=1)


def _levels(left: Any, right: Any) -> list:
    import numpy as np

    levels = [np.array([0])]
    while (inner := levels[-1][left[levels[-1]] >= 0]).size:
        levels.append(np.concatenate([left[inner], right[inner]]))
    return levels


def _leaves_at(left: Any, right: Any, trained: Any, levels: Sequence[Any], depth: int) -> Any:
    """For every node the node that is its leaf when the tree is cut at a depth; those above the cut have themselves."""
    import numpy as np

    label, one = trained[:, 1] > trained[:, 0], left < 0  # nodes that are one leaf at this depth
    if depth < len(levels):
        one[levels[depth]] = True
    for level in reversed(levels[:depth]):
        inner = level[left[level] >= 0]
        a, b = left[inner], right[inner]
        one[inner] = one[a] & one[b] & (label[a] == label[b])
    owner, inside = np.arange(len(left)), np.zeros(len(left), dtype=bool)
    for level in levels:
        inner = level[left[level] >= 0]
        for child in (left[inner], right[inner]):
            inside[child] = inside[inner] | one[inner]
            owner[child] = np.where(inside[child], owner[inner], child)
    return owner


def repeated_holdout(df: DataFrame, features: Sequence[str], strata: Sequence[str], maker: Maker, seeds: Sequence[int],
                     train_share: int = 70, keys: Keys = KEYS) -> DataFrame:
    """Hold-out gain of one learner over several stratified splits, each brought to the size of the whole."""
    rows = []
    for seed in seeds:
        halves = partition(df, [train_share, 100 - train_share], strata, seed, keys=keys)
        matrix = materialize(assemble(halves, features, [LABEL, "fold"]), "holdout")
        model = maker(seed).fit(matrix.filter("fold = 1"))
        scored = probability(model, matrix.filter("fold = 2"), [LABEL])
        share = (100 - train_share) / 100
        rows.append((seed, float(gain_at_threshold(scored, "prob", LABEL, share=share).first()[0])))
    return df.sparkSession.createDataFrame(rows, "seed int, ganancia double")


def month_discriminator(df: DataFrame, features: Sequence[str], first: int, second: int, depth: int = 3, seed: int = 1,
                        keys: Keys = KEYS) -> tuple[float, DataFrame]:
    """Can a shallow tree tell two months apart? AUC and the features it uses."""
    two = df.filter(F.col(keys.month).isin(first, second)).withColumn(LABEL, (F.col(keys.month) == second).cast("int"))
    matrix = materialize(assemble(two, features, [LABEL]), "months")
    tree = single_tree(maxDepth=depth)(seed).fit(matrix)
    return auc(probability(tree, matrix, [LABEL]), "prob"), importances(df.sparkSession, tree, features)
