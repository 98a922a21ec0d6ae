"""Public/private leaderboards and paired comparison of models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, ratio
from ..functions.stats import EXACT_UP_TO, normal_upper_tail, signed_rank_exact_p, signed_rank_normal_p, signed_rank_permutation_p
from ..session import materialize
from .gain import BREAK_EVEN
from .labels import gain
from .ordering import exact_quantiles, rank_counts, running_totals
from .sampling import border_lists, over_splits, partition, split_sums

PUBLIC_SHARE = 0.3


def leaderboard(df: DataFrame, predicted: str, label: str, seed: int, positive: str = "BAJA+2",
                division: Sequence[int] = (3, 7), keys: Keys = KEYS) -> DataFrame:
    """Gain of one submission on a stratified public and private part, each scaled to the whole."""
    folded = partition(df, division, [label], seed, keys=keys)
    earned = F.when(F.col(predicted) == 1, gain(F.coalesce(F.col(label) == positive, F.lit(False))))
    share = [d / sum(division) for d in division]
    return folded.agg(*[
        (F.coalesce(F.sum(F.when(F.col("fold") == i + 1, earned)), F.lit(0)) / F.lit(s)).alias(name)
        for i, (name, s) in enumerate(zip(("public", "private"), share))],
        F.coalesce(F.sum(earned), F.lit(0)).alias("total"))


def leaderboard_by_cut(df: DataFrame, prob: str, label: str, cuts: Sequence[int], seed: int,
                       positive: str = "BAJA+2", division: Sequence[int] = (3, 7), keys: Keys = KEYS) -> DataFrame:
    """The same for the first N rows of a score, for every cut N, in one pass over the first max(N)."""
    folded = partition(df, division, [label], seed, keys=keys)
    hit = F.coalesce(F.col(label) == positive, F.lit(False))
    top = running_totals(folded.withColumn("_gain", gain(hit)).select(*keys.pair, prob, "fold", "_gain"),
                         prob, keys.pair, descending=True, top=max(cuts))
    share = [d / sum(division) for d in division]
    one = top.agg(*[F.coalesce(F.sum(F.when((F.col("pos") <= c) & test, F.col("_gain"))), F.lit(0)).alias(f"_{name}{c}")
                    for c in cuts for name, test in (("p", F.col("fold") == 1), ("q", F.col("fold") == 2), ("t", F.lit(True)))])
    rows = F.array(*[F.struct(F.lit(c).alias("corte"), (F.col(f"_p{c}") / F.lit(share[0])).alias("public"),
                              (F.col(f"_q{c}") / F.lit(share[1])).alias("private"), F.col(f"_t{c}").alias("total"))
                     for c in cuts])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def simulate_cuts(df: DataFrame, prob: str, truth: str, cuts: Sequence[int], n_splits: int = 50,
                  public_share: float = PUBLIC_SHARE, seed: int = 42, keys: Keys = KEYS) -> DataFrame:
    """Gain of the first N rows of either side of many random splits: ``split, tipo, corte, ganancia``.

    A cut beyond the side contacts the whole side.
    """
    slim = materialize(df.select(*keys.pair, prob, truth), "scored")
    lists = border_lists(slim, n_splits, public_share, seed, [truth], keys)
    rows, most, least = slim.count(), max(cuts), min(public_share, 1 - public_share)
    take = min(rows, int(1.05 * most / least) + 1000) if least > 0 else rows
    while True:
        # the order of the scores is the same in every split: found once, it serves all as an even key
        ordered = running_totals(slim, prob, keys.pair, descending=True, position="_p", top=take, written=True)
        ordered = materialize(ordered.select(*keys.pair, truth, ((F.col("_p") - 1) / F.lit(max(take, 1))).alias("_order")), "ordered")
        public = F.coalesce(F.col("_drawn") <= F.col("_border"), F.lit(False))
        sided = over_splits(ordered, lists, seed, [truth], keys).select(
            "split", F.when(public, "public").otherwise("private").alias("tipo"), "_order", gain(F.col(truth) == 1).alias("_gain"))
        first = running_totals(sided, "_order", [], by=["split", "tipo"], uniform=True, top=most)
        wide = materialize(first.groupBy("split", "tipo").agg(F.count(F.lit(1)).alias("_rows"), *[
            F.coalesce(F.sum(F.when(F.col("pos") <= c, F.col("_gain"))), F.lit(0)).alias(f"_c{c}") for c in cuts]), "cuts")
        # rows after the first ones count for nothing once every side has enough
        if take == rows or wide.filter(F.col("_rows") >= most).count() == 2 * n_splits:
            break
        take = min(rows, 2 * take)
    rows = F.array(*[F.struct(F.lit(c).alias("corte"), F.col(f"_c{c}").alias("ganancia")) for c in cuts])
    return wide.select("split", "tipo", F.explode(rows).alias("r")).select("split", "tipo", "r.*")


def summarise_cuts(simulation: DataFrame) -> DataFrame:
    """Mean public and private gain per cut and the private-to-public difference in percent."""
    def mean(side: str) -> Column:
        part = F.when(F.col("tipo") == side, F.col("ganancia"))
        return ratio(F.sum(part), F.count(part)).alias(side)

    means = simulation.groupBy("corte").agg(mean("public"), mean("private"))
    delta = F.try_divide(100 * (F.col("private") - F.col("public")), F.col("public"))
    return means.withColumn("delta_pct", delta).orderBy("corte")


def models_over_splits(scores: DataFrame, prob: str, truth: str, model: str = "model", n_splits: int = 50,
                       public_share: float = PUBLIC_SHARE, seed: int = 42, threshold: float = BREAK_EVEN,
                       keys: Keys = KEYS) -> DataFrame:
    """Scaled gain at a threshold of every model on both sides of common random splits.

    A split is drawn once per customer row, so all models meet the same sides. A customer's row holds the gain of
    every model; models are few. Public gains are sums over the public side, found in the pass that finds its border,
    and the private ones what is left of the total.
    """
    kind = scores.schema[model].dataType
    names = [F.lit(r[0]).cast(kind) for r in scores.select(model).distinct().collect()] or [F.lit(None).cast(kind)]
    earned = F.when(F.col(prob) >= threshold, gain(F.col(truth) == 1))
    own = [F.col(model).eqNullSafe(name) for name in names]
    customers = scores.groupBy(*keys.pair).agg(
        F.max(truth).alias("_truth"), *[F.coalesce(F.sum(F.when(o, earned)), F.lit(0)).alias(f"_g{i}") for i, o in enumerate(own)],
        *[F.count_if(o).alias(f"_n{i}") for i, o in enumerate(own)])
    parts = [f"_{x}{i}" for x in "gn" for i in range(len(names))]
    # a row without key takes a place in its split, but is no customer
    known = F.col(keys.id).isNotNull() & F.col(keys.month).isNotNull()
    customers = materialize(customers.withColumns({c: F.when(known, F.col(c)).otherwise(F.lit(0)) for c in parts}), "customers")
    public = split_sums(customers, n_splits, public_share, seed, parts, ["_truth"], keys)
    public = materialize(public.withColumnsRenamed({c: f"_p{c}" for c in parts}), "public")
    totals = materialize(customers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts]), "totals")
    splits = scores.sparkSession.range(n_splits).select(F.col("id").cast("int").alias("split"))
    sums = splits.join(public, "split", "left").crossJoin(totals).fillna(0, [f"_p{c}" for c in parts])
    sides = []
    for i, name in enumerate(names):
        sides.append(F.struct(name.alias("model"), F.lit("public").alias("tipo"), (F.col(f"_p_g{i}") / F.lit(public_share)).alias("ganancia"), F.col(f"_p_n{i}").alias("n")))
        sides.append(F.struct(name.alias("model"), F.lit("private").alias("tipo"),
                              ((F.col(f"_g{i}") - F.col(f"_p_g{i}")) / F.lit(1 - public_share)).alias("ganancia"), (F.col(f"_n{i}") - F.col(f"_p_n{i}")).alias("n")))
    # a side without rows has no gain to speak of
    return sums.select("split", F.explode(F.array(*sides)).alias("r")).filter("r.n > 0").select(
        F.col("r.model").alias(model), "split", "r.tipo", "r.ganancia")


def best_public_vs_private(results: DataFrame, model: str = "model") -> DataFrame:
    """How often each pair (best public model, best private model) occurs over the splits."""
    winners = results.groupBy("split").agg(*[
        F.max_by(F.when(F.col("tipo") == side, F.col(model)),
                 F.when(F.col("tipo") == side, F.struct("ganancia", (-F.col(model)).alias("m")))).alias(side)
        for side in ("public", "private")])
    return winners.groupBy("public", "private").agg(F.count(F.lit(1)).alias("n"))


def to_long_results(wide: DataFrame, ids: Sequence[str], pattern: str = "_") -> DataFrame:
    """Columns named ``model_side`` to rows (model, side, value)."""
    columns = [c for c in wide.columns if c not in ids]
    long = wide.unpivot(list(ids), columns, "_name", "value")
    part = F.split("_name", pattern)
    return long.select(*ids, part[0].alias("model"), part[1].alias("tipo"), "value")


def signed_ranks(pairs: DataFrame, x: str, y: str, by: Sequence[str], listed: bool = False) -> DataFrame:
    """Rank sums of the paired differences of every group: ``n``, ``w_plus``, ``w_minus``, tie term, zeros.

    ``listed`` adds ``_doubled``, twice each mean rank: for groups that are the runs of a comparison.
    """
    by = list(by)
    diff = pairs.withColumn("_d", F.col(x).cast("double") - F.col(y).cast("double")).withColumn("_a", F.abs("_d"))
    ranked = rank_counts(diff.filter("_d <> 0").select(*by, "_d", "_a"), "_a", by)
    mean_rank = F.col("_rank") + (F.col("_ties") - 1) / 2
    sums = ranked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("_d") > 0, mean_rank).otherwise(0.0)).alias("w_plus"),
        F.sum(F.when(F.col("_d") < 0, mean_rank).otherwise(0.0)).alias("w_minus"),
        # each of t tied rows adds t^2 - 1, together t^3 - t
        F.sum((F.col("_ties") * F.col("_ties") - 1).cast("double")).alias("tie_term"),
        *([F.collect_list((2 * F.col("_rank") + F.col("_ties") - 1).cast("long")).alias("_doubled")] if listed else []))
    zeros = diff.groupBy(*by).agg(F.count_if(F.col("_d") == 0).alias("zeros"))
    joined = zeros.join(sums, by, "left")
    return joined.select(*by, F.coalesce("n", F.lit(0)).alias("n"), "zeros",
                         *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("w_plus", "w_minus", "tie_term")],
                         *(["_doubled"] if listed else []))


def _p_value(correction: bool, method: str, exact_up_to: int) -> Column:
    if method not in ("auto", "exact", "normal"):
        raise ValueError("method must be auto, exact or normal")
    n, w = F.col("n").cast("int"), F.least("w_plus", "w_minus")
    if method == "exact":
        return F.when(n == 0, F.lit(1.0)).otherwise(signed_rank_permutation_p(F.col("_doubled"), w))
    # with shared or left out ranks the approximation is usual
    exact = (F.col("tie_term") == 0) & (F.col("zeros") == 0)
    exact &= n <= exact_up_to if method == "auto" else F.lit(False)
    return (F.when(n == 0, F.lit(1.0))
            .when(exact, signed_rank_exact_p(F.when(exact, n).otherwise(1), F.when(exact, w).otherwise(0).cast("int")))
            .otherwise(signed_rank_normal_p(n, w, F.col("tie_term"), correction)))


def wilcoxon(pairs: DataFrame, x: str, y: str, by: Sequence[str], correction: bool = False,
             method: str = "auto", exact_up_to: int = EXACT_UP_TO) -> DataFrame:
    """Paired signed-rank test per group: statistic and two-sided p.

    ``method`` is ``exact``, ``normal`` (the approximation) or ``auto``: exact for up to ``exact_up_to`` differences
    without ties and zeros, else the approximation. ``exact`` never falls back: zeros are left out, and ranks that
    are shared count with their mean in the distribution over all signs.
    """
    # the pairs are read several times over: paid for once
    ranks = signed_ranks(materialize(pairs.select(*by, x, y), "pairs"), x, y, by, listed=method == "exact")
    found = ranks.withColumns({"estadistico": F.least("w_plus", "w_minus"), "p": _p_value(correction, method, exact_up_to)})
    return found.drop("_doubled")


def model_pairs(results: DataFrame, model: str, run: str, value: str) -> DataFrame:
    """Values of every two models on the same run; models are few, runs may be many."""
    a = results.select(run, F.col(model).alias("model_a"), F.col(value).alias("x"))
    b = results.select(run, F.col(model).alias("model_b"), F.col(value).alias("y"))
    return a.join(b, run).filter("model_a < model_b")


def compare_models(results: DataFrame, model: str = "model", run: str = "run", value: str = "ganancia") -> DataFrame:
    """Signed-rank test of every pair of models."""
    return wilcoxon(model_pairs(results, model, run, value), "x", "y", ["model_a", "model_b"])


def rank_models(results: DataFrame, model: str = "model", run: str = "run", value: str = "ganancia",
                alpha: float = 0.05) -> DataFrame:
    """Models by significant wins, then by median. A significant pair goes to the higher median."""
    results = materialize(results.select(model, run, value), "results")
    medians = exact_quantiles(results, [value], [0.5], [model], written=True).select(model, F.col("q0").alias("mediana"))
    tests = compare_models(results, model, run, value).filter(F.col("p") < alpha)
    a = medians.select(F.col(model).alias("model_a"), F.col("mediana").alias("_ma"))
    b = medians.select(F.col(model).alias("model_b"), F.col("mediana").alias("_mb"))
    winners = tests.join(a, "model_a").join(b, "model_b").select(
        F.when(F.col("_ma") > F.col("_mb"), F.col("model_a")).otherwise(F.col("model_b")).alias(model))
    wins = winners.groupBy(model).agg(F.count(F.lit(1)).alias("victorias"))
    return (medians.join(wins, model, "left")
            .select(model, F.coalesce("victorias", F.lit(0)).alias("victorias"), "mediana")
            .orderBy(F.desc("victorias"), F.desc("mediana"), model))


def win_probability(pairs: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """Share of runs in which the first model gains more, and both means."""
    wins = (F.col(x) > F.col(y)).cast("long")
    return pairs.groupBy(*by).agg(
        ratio(F.sum(wins), F.count(F.lit(1))).alias("p_gana"),
        ratio(F.sum(x), F.count(x)).alias("m1"), ratio(F.sum(y), F.count(y)).alias("m2"))


def sequential_comparison(pairs: DataFrame, x: str, y: str, run: str, by: Sequence[str], alpha: float = 0.05,
                          cap: int = 50, correction: bool = True) -> DataFrame:
    """Stop at the first number of runs whose signed-rank test is significant, or at ``cap`` runs.

    ``out`` is 1 or 2 for the better model, 0 if undecided. All prefixes of the runs are tested in one
    grouped pass; a run belongs to the at most ``cap`` prefixes that contain it.
    """
    by = list(by)
    pairs = materialize(pairs.select(*by, run, x, y), "pairs")
    numbered = running_totals(pairs, run, [run], by=by, position="_i", top=cap, written=True)
    prefixes = numbered.withColumn("n_runs", F.explode(F.sequence(F.col("_i").cast("int"), F.lit(cap))))
    lengths = numbered.groupBy(*by).agg(F.max("_i").alias("_len"))
    prefixes = prefixes.join(lengths, by).filter(F.col("n_runs") <= F.col("_len"))
    tests = wilcoxon(prefixes, x, y, [*by, "n_runs"], correction)
    means = prefixes.groupBy(*by, "n_runs").agg(ratio(F.sum(x), F.count(x)).alias("m1"), ratio(F.sum(y), F.count(y)).alias("m2"))
    found = tests.join(means, [*by, "n_runs"])
    # the first significant prefix, or else the longest one
    order = F.struct((F.col("p") >= alpha).alias("late"), F.when(F.col("p") < alpha, F.col("n_runs")).otherwise(-F.col("n_runs")).alias("at"))
    chosen = found.groupBy(*by).agg(F.min_by(F.struct("n_runs", "p", "m1", "m2"), order).alias("c")).select(*by, "c.*")
    sure = F.col("p") < alpha
    return chosen.withColumn("out", F.when(sure & (F.col("m1") > F.col("m2")), 1).when(sure & (F.col("m1") < F.col("m2")), 2).otherwise(0))


def proportion_z(groups: DataFrame, best: str, rest_mean: str, n: str) -> DataFrame:
    """One-proportion z of a winner's rate against the mean rate of the rest, with its upper tail p."""
    se = F.sqrt(F.col(rest_mean) * (1 - F.col(rest_mean)) / F.col(n))
    z = F.try_divide(F.col(best) - F.col(rest_mean), se)
    return groups.withColumn("z", z).withColumn("p", normal_upper_tail(F.col("z")))


def winner_vs_rest(scores: DataFrame, by: Sequence[str], hits: str, shots: str) -> DataFrame:
    """z-test of each group's best player, who is compared with the mean rate of all the others.

    ``percentil`` is the share of players with a lower rate, in percent.
    """
    by = list(by)
    rate = scores.withColumn("_rate", ratio(F.col(hits), F.col(shots)))
    totals = rate.groupBy(*by).agg(F.count(F.lit(1)).alias("jugadores"), F.sum("_rate").alias("_sum"),
                                   F.max(F.struct("_rate", shots)).alias("_b"))
    best = totals.select(*by, "jugadores", F.col("_b._rate").alias("mejor"), F.col(f"_b.{shots}").alias("tiros"),
                         ratio(F.col("_sum") - F.col("_b._rate"), F.col("jugadores") - 1).alias("resto"))
    lower = (rate.join(best.select(*by, "mejor"), by).groupBy(*by)
             .agg((ratio(F.count_if(F.col("_rate") < F.col("mejor")), F.count(F.lit(1))) * 100).alias("percentil")))
    return proportion_z(best.join(lower, by), "mejor", "resto", "tiros")


def running_mean_by_runs(results: DataFrame, run: str, value: str, by: Sequence[str]) -> DataFrame:
    """Mean of the first i runs, for every i: how the estimate settles as seeds are added."""
    summed = running_totals(results, run, [run], by=by, sums={"_sum": value}, position="n_runs")
    return summed.select(*by, "n_runs", ratio(F.col("_sum"), F.col("n_runs")).alias("media"))
