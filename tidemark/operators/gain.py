"""From probabilities to contact lists: gain curves, cuts, thresholds, ensembles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio
from .labels import CONTACT, HIT, gain
from .ordering import running_totals

BREAK_EVEN = CONTACT / (HIT + CONTACT)


def _earned(truth: str, hit: int, contact: int) -> Column:
    return gain(F.col(truth) == 1, hit, contact)


def gain_of_prediction(df: DataFrame, predicted: str, truth: str, by: Sequence[str] = (), hit: int = HIT,
                       contact: int = CONTACT) -> DataFrame:
    """Total gain of the rows predicted 1."""
    earned = F.when(F.col(predicted) == 1, _earned(truth, hit, contact))
    return df.groupBy(*by).agg(F.coalesce(F.sum(earned), F.lit(0)).alias("ganancia"))


def gain_at_threshold(df: DataFrame, prob: str, truth: str, threshold: float = BREAK_EVEN, strict: bool = True,
                      share: float = 1.0, by: Sequence[str] = (), hit: int = HIT, contact: int = CONTACT) -> DataFrame:
    """Gain of everybody above (or at) a probability, scaled up from a sample of the given share."""
    above = F.col(prob) > threshold if strict else F.col(prob) >= threshold
    earned = F.sum(F.when(above, _earned(truth, hit, contact)))
    return df.groupBy(*by).agg((F.coalesce(earned, F.lit(0)) / F.lit(share)).alias("ganancia"))


def scaled_up(column: Column, share: float) -> Column:
    """Gain of a hold-out brought to the size of the whole."""
    return column / F.lit(share)


def gain_curve(df: DataFrame, prob: str, truth: str, ties: Sequence[str], by: Sequence[str] = (), hit: int = HIT,
               contact: int = CONTACT, top: int | None = None) -> DataFrame:
    """``pos`` and ``gan_acum`` of each row in descending probability, ties by key, per group."""
    earned = df.withColumn("_gain", _earned(truth, hit, contact))
    return running_totals(earned, prob, ties, by=by, sums={"gan_acum": "_gain"}, descending=True, top=top).drop("_gain")


def truth_of_weight(weight: str, mark: float, within: float = 1e-7) -> Column:
    """1 where a row weight carries the mark of the rows that earn, for metrics that are handed weights only."""
    return (F.abs(F.col(weight) - F.lit(mark)) < within).cast("int")


def best_point(curve: DataFrame, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Highest point of a curve, the earliest if several: gain, position, probability, rows."""
    best = F.max(F.struct("gan_acum", (-F.col("pos")).alias("minus_pos"), F.col(prob).alias("prob")))
    return (curve.groupBy(*by).agg(best.alias("b"), F.count(F.lit(1)).alias("filas"))
            .select(*by, F.col("b.gan_acum").alias("ganancia_max"), (-F.col("b.minus_pos")).alias("pos_max"),
                    F.col("b.prob").alias("umbral"), "filas"))


def study_report(df: DataFrame, prob: str, truth: str, ties: Sequence[str], threshold: float = BREAK_EVEN,
                 hit: int = HIT, contact: int = CONTACT) -> DataFrame:
    """One row: class distribution, optimum of the curve, gain at the threshold."""
    best = best_point(gain_curve(df, prob, truth, ties, hit=hit, contact=contact), prob)
    fixed = df.agg(F.count_if(F.col(truth) == 1).alias("positivos"),
                   F.coalesce(F.sum(F.when(F.col(prob) > threshold, _earned(truth, hit, contact))), F.lit(0)).alias("ganancia_umbral"))
    row = fixed.select(F.struct("positivos", "ganancia_umbral")).scalar()
    return best.withColumns({"positivos": row["positivos"], "ganancia_umbral": row["ganancia_umbral"]})


def plateau(curve: DataFrame, window: int = 2001, edges: str = "partial", by: Sequence[str] = ()) -> DataFrame:
    """Centred mean of ``window`` points of the curve at every position.

    Positions are cut into stretches much longer than the window; each stretch borrows half a window from
    its neighbours, so its means need no other rows. ``edges="drop"`` keeps only full windows.
    """
    if window % 2 == 0:
        raise ValueError("the window must be odd")
    if edges not in ("partial", "drop"):
        raise ValueError("edges is 'partial' or 'drop'")
    half = window // 2
    stretch = max(1024, 16 * window)
    home = F.floor(F.col("pos") / stretch)
    reach = F.sequence(F.floor((F.col("pos") - half) / stretch), F.floor((F.col("pos") + half) / stretch))
    copies = curve.select(*by, "pos", "gan_acum", home.alias("_home"), F.explode(reach).alias("_stretch"))
    stretch_rows = Window.partitionBy(*by, "_stretch")
    ordered = stretch_rows.orderBy("pos")
    # sums from the start of the stretch, counted from its first point to keep them small; a window's sum is
    # the difference of two of them, so its length costs nothing
    local = copies.withColumns({
        "_base": F.first("gan_acum").over(ordered), "_from": F.min("pos").over(stretch_rows), "_to": F.max("pos").over(stretch_rows),
    }).withColumn("_upto", F.sum(F.col("gan_acum") - F.col("_base")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    summed = local.select(
        *by, "pos", "_home", "_stretch", "_base",
        (F.least(F.col("pos") + half, "_to") - F.greatest(F.col("pos") - half, "_from") + 1).alias("_n"),
        (F.coalesce(F.lead("_upto", half).over(ordered), F.sum(F.col("gan_acum") - F.col("_base")).over(stretch_rows))
         - F.coalesce(F.lag("_upto", half + 1).over(ordered), F.lit(0))).alias("_sum"),
    ).filter("_home = _stretch")
    total = F.col("_base").cast("decimal(20,0)") * F.col("_n").cast("decimal(10,0)") + F.col("_sum")
    means = summed.withColumn("meseta", total.cast("double") / F.col("_n"))
    if edges == "drop":
        means = means.filter(F.col("_n") == window)
    return means.select(*by, "pos", "meseta")


def plateau_gain(curve: DataFrame, window: int = 2001, edges: str = "partial", by: Sequence[str] = ()) -> DataFrame:
    return plateau(curve, window, edges, by).groupBy(*by).agg(F.max("meseta").alias("ganancia_meseta"))


def gain_at_cuts(df: DataFrame, prob: str, truth: str, ties: Sequence[str], cuts: Sequence[int],
                 by: Sequence[str] = (), clip: bool = False, hit: int = HIT, contact: int = CONTACT) -> DataFrame:
    """Gain of contacting the first ``corte`` rows, for every cut; null beyond the table, or its end with ``clip``.

    Only the rows up to the largest cut are ordered.
    """
    curve = gain_curve(df, prob, truth, ties, by, hit, contact, top=max(cuts))
    picked = [F.max(F.when(F.col("pos") == c, F.col("gan_acum"))) for c in cuts]
    if clip:
        end = F.max_by("gan_acum", "pos")
        picked = [F.coalesce(p, F.when(F.max("pos") < c, end)) for p, c in zip(picked, cuts)]
    wide = curve.groupBy(*by).agg(*[p.alias(f"_c{c}") for p, c in zip(picked, cuts)])
    rows = F.array(*[F.struct(F.lit(c).alias("corte"), F.col(f"_c{c}").alias("ganancia")) for c in cuts])
    return wide.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def best_cut(gains: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean gain per cut over repetitions, and the cut with the best mean (the smaller of equals)."""
    means = gains.groupBy(*by, "corte").agg(ratio(F.sum("ganancia"), F.count("ganancia")).alias("_mean"))
    best = F.max(F.struct("_mean", (-F.col("corte")).alias("minus")))
    return means.groupBy(*by).agg(best.alias("b")).select(
        *by, (-F.col("b.minus")).alias("corte"), F.col("b._mean").alias("ganancia_media"))


def _boundary(df: DataFrame, prob: str, ties: Sequence[str], cuts: Sequence[int]) -> Column:
    """The row at each cut as a scalar: only rows up to the largest cut are ordered."""
    top = running_totals(df.select(prob, *ties), prob, ties, descending=True, top=max(cuts))
    at = [F.max(F.when(F.col("pos") == c, F.struct(prob, *ties))).alias(f"c{c}") for c in cuts]
    return top.agg(*at).select(F.struct(*[f"c{c}" for c in cuts]).alias("rows")).scalar()


def label_top(df: DataFrame, prob: str, ties: Sequence[str], cuts: int | Sequence[int],
              out: str = "Predicted") -> DataFrame:
    """1 for the first N rows, 0 for the rest; several cuts give ``{out}_{cut}``.

    The N-th row is found first; every row is then compared with it in place, so the table itself is neither
    shuffled nor sorted. A table of fewer than N rows is all 1. Null scores come last, null ties first.
    """
    wanted = [cuts] if isinstance(cuts, int) else list(cuts)
    rows = _boundary(df, prob, ties, wanted)
    new = {}
    for c in wanted:
        row = rows[f"c{c}"]
        before = F.coalesce(F.col(prob) > row[prob], F.col(prob).isNotNull() & row[prob].isNull())
        same = F.col(prob).eqNullSafe(row[prob])
        for t in ties:
            before = before | (same & F.coalesce(F.col(t) < row[t], F.col(t).isNull() & row[t].isNotNull()))
            same = same & F.col(t).eqNullSafe(row[t])
        name = out if isinstance(cuts, int) else f"{out}_{c}"
        new[name] = F.when(row.isNull() | before | same, 1).otherwise(0)
    return df.withColumns(new)


def label_by_thresholds(df: DataFrame, prob: str, thresholds: Sequence[float]) -> DataFrame:
    """Every row once per threshold with its 0/1 label."""
    return (df.withColumn("umbral", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
            .withColumn("Predicted", (F.col(prob) >= F.col("umbral")).cast("int")))


def threshold_summary(df: DataFrame, prob: str, thresholds: Sequence[float]) -> DataFrame:
    """Number and share of positives per threshold, in one pass without multiplying the rows."""
    one = df.agg(F.count(prob).alias("_n"), *[
        F.count(F.when(F.col(prob) >= t, 1)).alias(f"_t{i}") for i, t in enumerate(thresholds)])
    rows = F.array(*[F.struct(F.lit(float(t)).alias("umbral"), F.col(f"_t{i}").alias("positivos"))
                     for i, t in enumerate(thresholds)])
    return one.select("_n", F.explode(rows).alias("r")).select(
        "r.*", ratio(F.col("r.positivos"), F.col("_n")).alias("share"))


def sweep_below(df: DataFrame, column: str, truth: str, thresholds: Sequence[float], hit: int = HIT,
                contact: int = CONTACT) -> DataFrame:
    """Gain of contacting everybody with ``column < t``, for every t.

    Rows fall between thresholds, are summed there in one map-side combined pass, and the few sums are
    accumulated.
    """
    steps = sorted({float(t) for t in thresholds})
    known = df.filter(F.col(column).isNotNull()).withColumn("_x", F.col(column).cast("double"))
    cut = Bucketizer(inputCol="_x", outputCol="_step", splits=[float("-inf"), *steps, float("inf")],
                     handleInvalid="keep").transform(known)
    sums = cut.groupBy(F.col("_step").cast("int").alias("_step")).agg(F.sum(_earned(truth, hit, contact)).alias("_g"))
    one = sums.agg(*[F.coalesce(F.sum(F.when(F.col("_step") <= i, F.col("_g"))), F.lit(0)).alias(f"_t{i}")
                     for i in range(len(steps))])
    rows = F.array(*[F.struct(F.lit(t).alias("umbral"), F.col(f"_t{i}").alias("ganancia")) for i, t in enumerate(steps)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def confusion(df: DataFrame, predicted: str, truth: str, by: Sequence[str] = (), guard: float = 0.0) -> DataFrame:
    """TP, FP, TN, FN and the four rates; ``guard`` as in ``rates``."""
    p, t = F.col(predicted) == 1, F.col(truth) == 1
    cells = {"tp": p & t, "fp": p & ~t, "tn": ~p & ~t, "fn": ~p & t}
    return rates(df.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in cells.items()]), guard)


def rates(cells: DataFrame, guard: float = 0.0) -> DataFrame:
    """Accuracy, precision, recall and F1 from the four counts; ``guard`` is added to the denominators."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    g = F.lit(guard)
    base = cells.withColumns({"accuracy": ratio(tp + tn, tp + fp + tn + fn), "precision": ratio(tp, tp + fp + g),
                              "recall": ratio(tp, tp + fn + g)})
    pr, rc = F.col("precision"), F.col("recall")
    return base.withColumn("f1", ratio(2 * pr * rc, pr + rc + g))


def rates_of_top(df: DataFrame, prob: str, truth: str, ties: Sequence[str], top: int, by: Sequence[str],
                 guard: float = 0.0) -> DataFrame:
    """Confusion of each model's own first ``top`` rows.

    Only those rows are ordered; the others are known from the totals.
    """
    by = list(by)
    hit = (F.col(truth) == 1).cast("long")
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.sum(hit).alias("_pos"))
    first = running_totals(df.select(*by, prob, truth, *[t for t in ties if t not in by]), prob, ties, by=by,
                           descending=True, top=top)
    chosen = first.groupBy(*by).agg(F.sum(hit).alias("tp"), F.sum(1 - hit).alias("fp"))
    return rates(chosen.join(sizes, by).select(
        *by, "tp", "fp", (F.col("_n") - F.col("_pos") - F.col("fp")).alias("tn"), (F.col("_pos") - F.col("tp")).alias("fn")), guard)


def predicted_counts(df: DataFrame, predicted: str) -> DataFrame:
    counts = df.groupBy(predicted).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", ratio(F.col("n"), counts.agg(F.sum("n")).scalar()))


def ensemble(scores: DataFrame, entity: Sequence[str], prob: str, out: str = "prob") -> DataFrame:
    """Mean probability per customer over all models and files."""
    return scores.groupBy(*entity).agg(ratio(F.sum(prob), F.count(prob)).alias(out))


def contact_list(scores: DataFrame, future: DataFrame, entity: str, prob: str, top: int) -> DataFrame:
    """Ensemble, restricted to the customers of the future month, first ``top`` of them."""
    alive = future.select(entity).distinct()
    mean = ensemble(scores, [entity], prob, "prob").join(alive, entity, "left_semi")
    return running_totals(mean, "prob", [entity], descending=True, top=top)


def nearest_to_gain(curves: DataFrame, target: Column, model: str) -> DataFrame:
    """Model and position whose running gain lies nearest to ``target``, the first if several."""
    distance = F.struct(F.abs(F.col("gan_acum") - target).alias("distancia"), model, "pos")
    return curves.agg(F.min(distance).alias("d")).select("d.*")


def submission_of_nearest(curves: DataFrame, target: Column, model: str, entity: str) -> DataFrame:
    """Contact list of the nearest run, cut at the nearest position."""
    pick = nearest_to_gain(curves, target, model).select(F.struct(model, "pos")).scalar()
    run = curves.filter(F.col(model) == pick[model])
    return run.select(entity, (F.col("pos") <= pick["pos"]).cast("int").alias("Predicted"))


def gain_sum(chosen: Column, truth: str, hit: int = HIT, contact: int = CONTACT) -> Column:
    """Aggregate: gain of the chosen rows, 0 for none."""
    return F.coalesce(F.sum(F.when(chosen, _earned(truth, hit, contact))), F.lit(0))


def growing_ensemble(votes: DataFrame, entity: Sequence[str], tree: str, prob: str, truth: str,
                     sizes: Sequence[int], hit: int = HIT, contact: int = CONTACT) -> DataFrame:
    """Gain at break-even after 1, 2, 4, ... trees: the running mean probability of each customer."""
    upto = Window.partitionBy(*entity).orderBy(tree).rowsBetween(Window.unboundedPreceding, 0)
    running = votes.withColumn("_sum", F.sum(prob).over(upto)).filter(F.col(tree).isin(list(sizes)))
    chosen = F.col("_sum") > F.col(tree) * F.lit(BREAK_EVEN)
    return running.groupBy(tree).agg(gain_sum(chosen, truth, hit, contact).alias("ganancia"))


def relevant_part(curve: DataFrame, share: float = 0.6, by: Sequence[str] = ()) -> DataFrame:
    """Points of the curve that reach a share of its maximum."""
    best = curve.groupBy(*by).agg(F.max("gan_acum").alias("_best"))
    if by:
        return curve.join(best, list(by)).filter(F.col("gan_acum") >= F.col("_best") * F.lit(share)).drop("_best")
    return curve.filter(F.col("gan_acum") >= best.scalar() * F.lit(share))


def curve_stretch(curve: DataFrame, first: int, last: int) -> DataFrame:
    return curve.filter(F.col("pos").between(first, last))


def count_above(df: DataFrame, prob: str, threshold: float = BREAK_EVEN) -> DataFrame:
    return df.agg(F.count_if(F.col(prob) > threshold).alias("n"))


def gain_of_rule(df: DataFrame, rules: dict[str, Column], truth: str, hit: int = HIT, contact: int = CONTACT) -> DataFrame:
    """Rows, class share, lift over the whole and gain of each predicate, all in one pass."""
    hits = F.col(truth) == 1
    one = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(hits).alias("_h"), *[e for i, r in enumerate(rules.values()) for e in (
        F.count_if(r).alias(f"_n{i}"), F.count_if(r & hits).alias(f"_h{i}"),
        F.coalesce(F.sum(F.when(r, _earned(truth, hit, contact))), F.lit(0)).alias(f"_g{i}"))])
    rows = F.array(*[F.struct(F.lit(name).alias("regla"), F.col(f"_n{i}").alias("filas"), F.col(f"_h{i}").alias("aciertos"),
                              F.col(f"_g{i}").alias("ganancia")) for i, name in enumerate(rules)])
    return one.select("_n", "_h", F.explode(rows).alias("r")).select(
        "r.*", ratio(F.col("r.aciertos"), F.col("r.filas")).alias("share"),
        F.try_divide(ratio(F.col("r.aciertos"), F.col("r.filas")), ratio(F.col("_h"), F.col("_n"))).alias("lift"))
