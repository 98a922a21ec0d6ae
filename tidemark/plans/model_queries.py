"""Registered queries: training, tuning and segmentation jobs.

Rows that depend on the learner have no SQL. Beside them stand queries whose data force what any learner must find.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from ..operators import gain, history, modeling, segments
from ..operators.aggregates import class_by_segment, medians_by
from ..operators.sampling import undersample_rows
from ..session import materialize, scratch_path
from . import chains
from .registry import query
from .tables import LABELLED, MEASURES, SCORED, SCORES, sql, u

KEY = ["id", "mes"]
FEATURES = [*MEASURES, "m_total_lag_1", "m_total_delta_1", "m_net_lag_1", "m_net_delta_1"]
SPLIT_MONTH = 199901
SEEDS = [11, 23, 37]
FIVE_SEEDS = [*SEEDS, 53, 71]


def features(t):
    """Panel with lags; the target is whether the customer's next row has a positive net amount."""
    lagged = history.lags(t.panel(), ["m_total", "m_net"], (1,))
    ahead = F.lead("m_net").over(Window.partitionBy("id").orderBy("periodo"))
    return lagged.withColumn("target", F.coalesce((ahead > 0).cast("int"), F.lit(0)))


def sets(t):
    df = materialize(features(t), "features")
    return df.filter(F.col("mes") < SPLIT_MONTH), df.filter(F.col("mes") >= SPLIT_MONTH)


def _fitted(t, maker, seeds, folder=None):
    train, future = sets(t)
    sampled = undersample_rows(train, "target", 0.5, 7)
    models = modeling.fit_seeds(modeling.assemble(sampled, FEATURES, ["target"]), maker, seeds, folder)
    return models, modeling.assemble(future, FEATURES, [*KEY, "target"])


@query("m1_train_per_seed")
def _(t):
    folder = scratch_path(t.spark, "models")
    models, future = _fitted(t, modeling.boosted_trees(maxIter=5, maxDepth=3), SEEDS[:2], folder)
    return modeling.score(models, future, [*KEY, "target"])


@query("m2_score_saved_models")
def _(t):
    folder, maker = scratch_path(t.spark, "models"), modeling.random_forest(numTrees=5, maxDepth=4)
    train, future = sets(t)
    matrix = modeling.assemble(train, FEATURES, ["target"])
    modeling.fit_seeds(matrix, maker, SEEDS, folder)
    saved = modeling.fit_seeds(matrix, maker, SEEDS, folder)
    scores = modeling.score(saved, modeling.assemble(future, FEATURES, [*KEY, "target"]), [*KEY, "target"])
    return gain.gain_at_cuts(gain.ensemble(scores, [*KEY, "target"], "prob"), "prob", "target", KEY, [50, 500])


@query("m3_leaf_features")
def _(t):
    train, future = sets(t)
    return modeling.leaf_features(train, future, FEATURES, KEY, n_trees=20, depth=4)


@query("m4_subspace_trees")
def _(t):
    models, future = _fitted(t, modeling.subspace_trees(8, 0.5, maxDepth=4), SEEDS[:1])
    return modeling.score(models, future, KEY)


@query("m5_canary_selection")
def _(t):
    return modeling.canary_selection(sets(t)[0], FEATURES, 10, 5, depth=4, n_trees=20)


@query("m6_importances")
def _(t):
    models, _ = _fitted(t, modeling.random_forest(numTrees=8, maxDepth=4), SEEDS[:1])
    return modeling.importances(t.spark, models[SEEDS[0]], FEATURES, 5)


def forced_tree(t):
    """A tree that one column decides: customers with two or more orders in the month."""
    names = ["c_total", "mes"]
    matrix = modeling.assemble(t.panel().withColumn("target", (F.col("c_total") >= 2).cast("int")), names, ["target"])
    model = modeling.single_tree(maxDepth=3, minInstancesPerNode=1)(1).fit(matrix)
    return modeling.node_table(t.spark, model, scratch_path(t.spark, "tree")), names


def forced(t, *keep):
    """Rows whose label one column gives away; ``doble`` says the same as ``c_total``."""
    return t.panel().select(*KEY, *keep, "c_total", (2 * F.col("c_total")).alias("doble"), F.lit(0).alias("constante"),
                            (F.col("c_total") >= 2).cast("int").alias("target"))


_FORCED = "forced AS (SELECT id, mes, CAST(c_total >= 2 AS INTEGER) AS y FROM panel)"
_PER_SEED = "SELECT model, id, mes, {} FROM forced, (SELECT unnest([11, 23, 37]) AS model)"


def forced_scores(t, maker, columns, folder=None):
    rows = forced(t)
    matrix = modeling.assemble(rows, columns, ["target"])
    if folder:
        modeling.fit_seeds(matrix, maker, SEEDS, folder)
    return modeling.score(modeling.fit_seeds(matrix, maker, SEEDS, folder), modeling.assemble(rows, columns, KEY), KEY)


@query("m1_forced_boosting", sql(_PER_SEED.format("y = 1 AS alto"), _FORCED))
def _(t):
    scores = forced_scores(t, modeling.boosted_trees(maxIter=5, maxDepth=3), ["c_total", "constante"])
    return scores.select("model", *KEY, (F.col("prob") > 0.5).alias("alto"))


@query("m2_forced_saved_models", sql(_PER_SEED.format("CAST(y AS DOUBLE) AS prob"), _FORCED))
def _(t):
    """Scores of models read back from their folder."""
    return forced_scores(t, modeling.random_forest(numTrees=5, maxDepth=3), ["c_total"], scratch_path(t.spark, "models"))


@query("m3_forced_leaves", sql("SELECT id, mes, " + ", ".join(
    f"1 - y AS rf_{i:03d}_000, y AS rf_{i:03d}_001" for i in range(1, 21)) + " FROM forced", _FORCED))
def _(t):
    return modeling.leaf_features(forced(t), forced(t), ["c_total"], KEY, n_trees=20, depth=4)


@query("m4_forced_subspace", sql(_PER_SEED.format("CAST(y AS DOUBLE) AS prob"), _FORCED))
def _(t):
    """Either of two columns decides, so trees that see one of them are right."""
    return forced_scores(t, modeling.subspace_trees(8, 0.5, maxDepth=4), ["c_total", "doble"])


@query("m5_forced_canaries", sql("SELECT unnest(['c_total', 'constante']) AS feature, unnest([true, false]) AS kept"))
def _(t):
    return modeling.canary_selection(forced(t), ["c_total", "constante"], 10, 5, depth=4, n_trees=20).select("feature", "kept")


@query("m6_forced_importances", sql("SELECT unnest(['c_total', 'constante']) AS feature, unnest([1e0, 0e0]) AS importance"))
def _(t):
    """Importance by gain: the whole of it belongs to the column that decides."""
    model = modeling.single_tree(maxDepth=3)(1).fit(modeling.assemble(forced(t), ["c_total", "constante"], ["target"]))
    return modeling.importances(t.spark, model, ["c_total", "constante"])


@query("m7_forced_folds", sql("SELECT CAST(d AS BIGINT) AS maxDepth, 780000e0 * p AS ganancia FROM (SELECT sum(y) AS p FROM forced), (SELECT unnest([2, 4]) AS d)", _FORCED))
def _(t):
    found = modeling.cross_validate(forced(t), ["c_total", "constante"], ["target"], modeling.single_tree(), {"maxDepth": [2, 4]}, folds=5)
    return found.withColumn("ganancia", F.round("ganancia", 2))


@query("m8_forced_search", sql("""SELECT CAST(i AS INTEGER) AS trial_number, CAST(780000 * p AS DOUBLE) AS value, 1e0 AS auc, 'COMPLETE' AS state
FROM (SELECT sum(y) AS p FROM forced), (SELECT unnest(range(3)) AS i)""", _FORCED))
def _(t):
    rows = materialize(forced(t), "forced")
    settings = modeling.sampled_settings({"maxDepth": (2, 4)}, 3, 1, whole=("maxDepth",))
    trials = modeling.search(rows, rows, ["c_total"], lambda **s: modeling.random_forest(numTrees=4, **s), settings, SEEDS[:2])
    return trials.select("trial_number", "value", "auc", "state")


@query("m13_forced_depths", sql("""SELECT CAST(d AS INTEGER) AS max_depth, g AS ganancia_train, h AS ganancia_test FROM (
  SELECT 780000e0 * count(*) FILTER (y = 1 AND mes < 199901) AS g, 780000e0 * count(*) FILTER (y = 1 AND mes >= 199901) AS h FROM forced), (SELECT unnest(range(2, 25)) AS d)""", _FORCED))
def _(t):
    rows = forced(t)
    return modeling.depth_sweep(rows.filter(F.col("mes") < SPLIT_MONTH), rows.filter(F.col("mes") >= SPLIT_MONTH), ["c_total"], list(range(2, 25)))


@query("m14_forced_holdout", sql("""SELECT CAST(s AS INTEGER) AS seed, round(g, 2) AS ganancia FROM (SELECT 780000e0 * count(*) / 0.3e0 AS g FROM (
  SELECT row_number() OVER () - 1 AS i FROM forced WHERE y = 1) WHERE i % 100 >= 70), (SELECT unnest([11, 23, 37, 53, 71]) AS s)""", _FORCED))
def _(t):
    found = modeling.repeated_holdout(forced(t), ["c_total"], ["target"], modeling.single_tree(maxDepth=4), FIVE_SEEDS)
    return found.withColumn("ganancia", F.round("ganancia", 2))


@query("d8_forced_months", sql("SELECT unnest(['periodo', 'constante']) AS feature, unnest([1e0, 0e0]) AS importance, 1e0 AS auc"))
def _(t):
    """A column that follows the month tells two months apart."""
    auc, used = modeling.month_discriminator(forced(t, "periodo"), ["periodo", "constante"], 199606, 199806)
    return used.withColumn("auc", F.lit(auc))


FOREST_SIZES = [2**i for i in range(10)]


@query("g16_forced_forest", sql(f"SELECT CAST(n AS INTEGER) AS tree, CAST(780000 * p AS BIGINT) AS ganancia FROM (SELECT sum(y) AS p FROM forced), (SELECT unnest({FOREST_SIZES}) AS n)", _FORCED))
def _(t):
    """A fitted forest of 512 trees that are all right."""
    rows = materialize(modeling.assemble(forced(t), ["c_total"], ["target"]), "forced")
    forest = modeling.fit_in_blocks(rows, lambda n: modeling.random_forest(numTrees=n, maxDepth=3), 512, 1)
    return modeling.forest_growth(forest, rows, "target", FOREST_SIZES)


@query("g16_forest_growth")
def _(t):
    """Trees that each see half of the columns, judged on later months."""
    train, future = sets(t)
    forest = modeling.fit_in_blocks(modeling.assemble(train, FEATURES, ["target"]), lambda n: modeling.subspace_trees(n, 0.5, maxDepth=4), 512, SEEDS[0])
    return modeling.forest_growth(forest, modeling.assemble(future, FEATURES, ["target"]), "target", FOREST_SIZES)


@query("m6_split_importances", sql("SELECT 'c_total' AS feature, CAST(1 AS BIGINT) AS splits, count(*) AS cover FROM panel UNION ALL SELECT 'mes', 0, 0"))
def _(t):
    return modeling.split_importances(*forced_tree(t))


@query("d9_forced_split_point", sql("SELECT 1.5e0 AS threshold, CAST(1 AS BIGINT) AS n"))
def _(t):
    return modeling.split_points(*forced_tree(t), "c_total")


@query("d11_forced_tree_shape", sql("SELECT 0 AS tree, CAST(3 AS BIGINT) AS nodes, CAST(2 AS BIGINT) AS leaves"))
def _(t):
    return modeling.tree_shapes(forced_tree(t)[0])


@query("m7_cross_validate")
def _(t):
    return modeling.cross_validate(sets(t)[0], FEATURES, ["target"], modeling.single_tree(), {"maxDepth": [2, 4]}, folds=5)


@query("m8_random_search")
def _(t):
    train, validate = sets(t)
    settings = modeling.sampled_settings({"maxDepth": (2, 4), "minInstancesPerNode_exp": (0, 6)}, 3, 1,
                                         whole=("maxDepth", "minInstancesPerNode"))
    trials = modeling.search(train, validate, FEATURES, lambda **s: modeling.random_forest(numTrees=4, **s), settings,
                             SEEDS[:2], window=2001, fits=lambda s, n: s["minInstancesPerNode"] * 2 ** s["maxDepth"] <= n)
    return trials.select("trial_number", "value", "auc", "state", F.map_keys("params").alias("names"))


@query("m9_forced_grid", sql("""SELECT CAST(d AS BIGINT) AS maxDepth, CAST(m AS BIGINT) AS minInstancesPerNode, 780000e0 * p AS ganancia
FROM (SELECT sum(y) AS p FROM forced), (SELECT unnest([2, 3]) AS d), (SELECT unnest([1, 2]) AS m)""", _FORCED))
def _(t):
    found = modeling.cross_validate(forced(t), ["c_total"], ["target"], modeling.single_tree(),
                                    {"maxDepth": [2, 3], "minInstancesPerNode": [1, 2]}, folds=5)
    return found.withColumn("ganancia", F.round("ganancia", 2))


@query("m9_grid_search")
def _(t):
    return modeling.cross_validate(sets(t)[0], FEATURES, ["target"], modeling.single_tree(),
                                   {"maxDepth": [2, 3], "minInstancesPerNode": [1, 50]}, folds=5)


@query("m11_scaled_min_leaf", sql("SELECT id, mes, CAST(greatest(1, round_even(c_total / 0.25e0, 0)) AS INTEGER) AS hoja FROM panel"))
def _(t):
    return t.panel().select("id", "mes", modeling.scaled_min_leaf_column(F.col("c_total"), 0.25).alias("hoja"))


@query("m11_scaled_amounts", sql("SELECT id, mes, CAST(greatest(1, round_even((m_total // 1000) / 0.1e0, 0)) AS INTEGER) AS hoja FROM panel"))
def _(t):
    """Sizes far beyond the usual ones."""
    return t.panel().select("id", "mes", modeling.scaled_min_leaf_column(F.expr("m_total div 1000"), 0.1).alias("hoja"))


@query("m12_auc")
def _(t):
    models, future = _fitted(t, modeling.random_forest(numTrees=5, maxDepth=4), SEEDS[:1])
    scores = modeling.score(models, future, [*KEY, "target"])
    return t.spark.createDataFrame([(SEEDS[0], modeling.auc(scores, "prob"))], "model int, auc double")


@query("m12_auc_by_model", sql("""SELECT model, (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2e0)
  / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)) AS auc FROM (SELECT model, y,
  rank() OVER (PARTITION BY model ORDER BY round(prob, 2)) + (count(*) OVER (PARTITION BY model, round(prob, 2)) - 1) / 2e0 AS r FROM scores) GROUP BY model""", SCORED, SCORES))
def _(t):
    """Scores of two digits, so that many rows tie."""
    return modeling.auc_by(t.scores().withColumn("prob", F.round("prob", 2)), "prob", "y", ["model"])


@query("m13_depth_sweep")
def _(t):
    return modeling.depth_sweep(*sets(t), FEATURES, list(range(2, 25)))


@query("m14_repeated_holdout")
def _(t):
    return modeling.repeated_holdout(sets(t)[0], FEATURES, ["target"], modeling.single_tree(maxDepth=4), FIVE_SEEDS)


@query("d8_month_discriminator")
def _(t):
    auc, used = modeling.month_discriminator(features(t), FEATURES, 199606, 199906)
    return used.withColumn("auc", F.lit(auc))


def _nodes(t):
    models, _ = _fitted(t, modeling.random_forest(numTrees=4, maxDepth=4), SEEDS[:1])
    return modeling.node_table(t.spark, models[SEEDS[0]], scratch_path(t.spark, "nodes"))


@query("d9_split_points")
def _(t):
    return modeling.split_points(_nodes(t), FEATURES, "m_total")


@query("d11_tree_shapes")
def _(t):
    return modeling.tree_shapes(_nodes(t))


@query("backtest")
def _(t):
    return chains.backtest(t.labelled(), MEASURES, "clase_ternaria", [199801, 199802, 199803], 199805, 199807,
                           modeling.random_forest(numTrees=4, maxDepth=4), SEEDS[:2], [5, 20, 60],
                           folder=scratch_path(t.spark, "models"))


# --- segments

TREES, LEAVES = 6, 8
_LEAVES = "leaves AS (SELECT id, mes, periodo, CAST(id % 3 AS INTEGER) AS grupo, [" + ", ".join(
    f"CAST(floor({u('id', 'mes', t)} * {LEAVES}) AS INTEGER)" for t in range(TREES)) + "] AS leaves FROM panel)"


def leaf_table(t):
    """A given leaf table: tree and leaf numbers drawn per row."""
    return t.panel().select(*KEY, "periodo", (F.col("id") % 3).cast("int").alias("grupo"), F.array(
        *[F.floor(hash_uniform("id", "mes", F.lit(i)) * LEAVES).cast("int") for i in range(TREES)]).alias("leaves"))


@query("c1_pair_proximity", sql(f"""SELECT a.id AS id_a, a.mes AS mes_a, b.id AS id_b, b.mes AS mes_b,
  ({' + '.join(f'CAST(a.leaves[{i}] = b.leaves[{i}] AS INTEGER)' for i in range(1, TREES + 1))}) / {TREES}e0 AS proximidad
FROM (SELECT *, lead(mes) OVER (PARTITION BY id ORDER BY periodo) AS siguiente FROM leaves) a JOIN leaves b ON b.id = a.id AND b.mes = a.siguiente""", _LEAVES))
def _(t):
    placed = leaf_table(t)
    following = F.lead("mes").over(Window.partitionBy("id").orderBy("periodo"))
    pairs = placed.select(F.col("id").alias("id_a"), F.col("mes").alias("mes_a"), F.col("id").alias("id_b"), following.alias("mes_b"))
    return segments.pair_proximity(placed, pairs.filter("mes_b is not null"), KEY)


@query("c1_group_proximity", sql(f"""SELECT a.id, a.mes, g.grupo, CAST(sum(n) AS DOUBLE) / (any_value(size) * {TREES}) AS proximidad FROM (SELECT id, mes, unnest(leaves) AS leaf, unnest(range({TREES})) AS tree FROM leaves) a
JOIN (SELECT grupo, tree, leaf, count(*) AS n FROM (SELECT grupo, unnest(leaves) AS leaf, unnest(range({TREES})) AS tree FROM leaves) GROUP BY ALL) g USING (tree, leaf)
JOIN (SELECT grupo, count(*) AS size FROM leaves GROUP BY grupo) s ON s.grupo = g.grupo GROUP BY 1, 2, 3""", _LEAVES))
def _(t):
    return segments.group_proximity(leaf_table(t).drop("periodo"), KEY, "grupo")


@query("c1_near_classes", sql(f"""SELECT array_to_string(x, ',') AS clase_a, array_to_string(z, ',') AS clase_b, igual / {TREES}e0 AS proximidad FROM (
  SELECT a.leaves AS x, b.leaves AS z, {' + '.join(f'CAST(a.leaves[{i}] = b.leaves[{i}] AS INTEGER)' for i in range(1, TREES + 1))} AS igual
  FROM (SELECT DISTINCT leaves FROM leaves) a JOIN (SELECT DISTINCT leaves FROM leaves) b ON a.leaves < b.leaves) WHERE igual >= 5""", _LEAVES))
def _(t):
    _, pairs = segments.near_classes(leaf_table(t), KEY, 5 / TREES)
    return pairs.select(*[F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) for c in ("clase_a", "clase_b")], "proximidad")


@query("c1_forest_proximity", sql("SELECT id, mes, y AS grupo, 1e0 AS proximidad FROM forced", _FORCED))
def _(t):
    """From a fitted forest: all trees put the rows of a group into the same leaf, and no others."""
    forest = modeling.random_forest(numTrees=20, maxDepth=3)(1).fit(modeling.assemble(forced(t), ["c_total"], ["target"]))
    placed = modeling.leaves(forest, modeling.assemble(forced(t), ["c_total"], [*KEY, "target"]), [*KEY, "target"])
    return segments.group_proximity(materialize(placed, "leaves"), KEY, "target")


PLACES = [0, 1, 10, 13]


def places(t):
    """Four points on a line."""
    return t.panel().select(*KEY, F.element_at(F.array(*[F.lit(p) for p in PLACES]), (F.col("id") % 4 + 1).cast("int")).alias("lugar"))


_PLACES = f"places AS (SELECT id, mes, {PLACES}[id % 4 + 1] AS lugar FROM panel)"


@query("c2_forced_segments", sql("SELECT CAST(k AS INTEGER) AS k, desde, hasta, n FROM (" + " UNION ALL ".join(
    f"SELECT {k} AS k, min(lugar) AS desde, max(lugar) AS hasta, count(*) AS n FROM places GROUP BY {by}"
    for k, by in ((2, "lugar < 5"), (3, "least(greatest(lugar, 1), 13)"), (4, "lugar"))) + ")", _PLACES))
def _(t):
    found = segments.nested_segments(places(t), ["lugar"], [*KEY, "lugar"], ks=(2, 3, 4))
    long = found.select("lugar", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"labels_{k}").alias("label")) for k in (2, 3, 4)])).alias("s"))
    return long.groupBy("s.k", "s.label").agg(F.min("lugar").alias("desde"), F.max("lugar").alias("hasta"), F.count(F.lit(1)).alias("n")).drop("label")


@query("c3_forced_segments", sql("SELECT lugar AS desde, lugar AS hasta, count(*) AS n FROM places GROUP BY lugar", _PLACES))
def _(t):
    found = segments.flat_segments(places(t), ["lugar"], [*KEY, "lugar"], k=4)
    return found.groupBy("segmento").agg(F.min("lugar").alias("desde"), F.max("lugar").alias("hasta"), F.count(F.lit(1)).alias("n")).drop("segmento")


@query("c4_forced_separation", sql("SELECT unnest(['lugar', 'constante']) AS feature, unnest([1e0, 0e0]) AS importance, CAST(s AS INTEGER) AS segmento FROM (SELECT unnest([0, 1, 10, 13]) AS s)"))
def _(t):
    rows = places(t).withColumns({"constante": F.lit(0), "segmento": F.col("lugar")})
    return segments.what_separates(rows, ["lugar", "constante"], "segmento", PLACES, n_trees=20, depth=5)


@query("c5_given_segments", sql("""SELECT segmento, count(*) FILTER (clase_ternaria = 'BAJA+1') AS "BAJA+1", count(*) FILTER (clase_ternaria = 'BAJA+2') AS "BAJA+2",
  count(*) FILTER (clase_ternaria = 'CONTINUA') AS "CONTINUA", sum(prob) / count(prob) AS prob_media, """ + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in MEASURES) + f"""
FROM (SELECT *, CAST(id % 4 AS INTEGER) AS segmento, {u('id', 'mes', 1)} AS prob FROM labelled) GROUP BY segmento""", LABELLED))
def _(t):
    return profile(t.labelled().withColumns({"segmento": (F.col("id") % 4).cast("int"), "prob": hash_uniform("id", "mes", F.lit(1))}))


@query("c2_nested_segments")
def _(t):
    return segments.nested_segments(t.panel(), MEASURES, KEY, ks=tuple(range(3, 11)))


def profile(placed):
    placed = materialize(placed, "profile")
    return class_by_segment(placed, "segmento", "clase_ternaria", "prob").join(medians_by(placed, MEASURES, ["segmento"]), "segmento")


@query("c3_flat_segments")
def _(t):
    return segments.flat_segments(t.panel(), MEASURES, KEY, k=15)


@query("c4_what_separates")
def _(t):
    placed = segments.flat_segments(t.panel(), MEASURES, [*KEY, *MEASURES], k=4)
    return segments.what_separates(placed, MEASURES, "segmento", range(4), n_trees=5, depth=3)


@query("c5_segment_profile")
def _(t):
    placed = segments.flat_segments(t.labelled(), MEASURES, [*KEY, "clase_ternaria", *MEASURES], k=4)
    return profile(placed.withColumn("prob", hash_uniform("id", "mes", F.lit(1))))
