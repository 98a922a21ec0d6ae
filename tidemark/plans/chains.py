"""Whole chains: features from a raw panel, and a back-test from features to a contact list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, amount_columns, numeric_columns
from ..operators import gain, history, labels, modeling, ranks, sampling
from ..session import materialize


def engineer_features(df: DataFrame, n_lags: int = 1, window: int = 3, mode: str = "positive",
                      keys: Keys = KEYS) -> DataFrame:
    """Label, rank the amounts within their month, then moving means, lags and deltas of every numeric column.

    The history features share one window, so the chain sorts by customer once for all of them.
    """
    labelled = labels.churn_label(df, tail="stays", keys=keys)
    amounts = amount_columns(df.columns, keys=keys)
    ranked = ranks.signed_rank(labelled, amounts, mode, keys=keys) if amounts else labelled
    columns = numeric_columns(ranked, [keys.id, keys.month, keys.period])
    means = history.rolling_mean(ranked, columns, window, keys)
    return history.lags(means, columns, range(1, n_lags + 1), keys=keys)


def backtest(df: DataFrame, features: Sequence[str], label: str, train: Sequence[int], validate: int, future: int,
             maker: modeling.Maker, seeds: Sequence[int], cuts: Sequence[int], fraction: float = 0.5, seed: int = 1,
             folder: str | None = None, keys: Keys = KEYS) -> DataFrame:
    """Train on past months, choose the cut on the validation month, label the future month with it.

    Returns the future customers with their ensemble probability and ``Predicted``.
    """
    # fractions of a month's rows in every branch: written once
    sets = sampling.split_by_month(materialize(df, "backtest"), label, train, [validate], [future], fraction, seed, keys=keys)
    models = modeling.fit_seeds(modeling.assemble(sets["train"], features, ["target"]), maker, seeds, folder)
    means = {}
    for name in ("validate", "future"):
        keep = [*keys.pair, "target"]
        scores = modeling.score(models, modeling.assemble(sets[name], features, keep), keep)
        means[name] = materialize(gain.ensemble(scores, keep, "prob"), name)
    best = gain.best_cut(gain.gain_at_cuts(means["validate"], "prob", "target", keys.pair, cuts)).first()["corte"]
    return gain.label_top(means["future"], "prob", keys.pair, best).withColumn("corte", F.lit(best))
