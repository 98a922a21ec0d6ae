"""Registered queries: gain curves, cuts, ensembles, leaderboards, paired tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from ..operators import gain, history, leaderboard, ranks
from ..operators.labels import gain as gain_of
from ..session import materialize
from .registry import query
from .tables import GAIN, LABELLED, SCORED, SCORES, TRAIN_MONTH, sql, u

TIES = ["id", "mes"]
CUTS = [10, 100, 1000, 5000, 1000000]
ORDER = "ORDER BY prob DESC, id, mes"

CURVE = f"""curve AS (SELECT *, row_number() OVER ({ORDER}) AS pos,
  CAST(sum({GAIN}) OVER ({ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gan_acum FROM scored)"""
CURVES = f"""curves AS (SELECT *, row_number() OVER (PARTITION BY model {ORDER}) AS pos,
  CAST(sum({GAIN}) OVER (PARTITION BY model {ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gan_acum FROM scores)"""


def curve(t, **options):
    return gain.gain_curve(t.scored(), "prob", "y", TIES, **options)


def curves(t):
    return gain.gain_curve(t.scores(), "prob", "y", TIES, ["model"])


@query("g1_gain_of_prediction", sql(f"SELECT CAST(sum({GAIN}) FILTER (prob > 0.8) AS BIGINT) AS ganancia FROM scored", SCORED))
def _(t):
    return gain.gain_of_prediction(t.scored().withColumn("p", (F.col("prob") > 0.8).cast("int")), "p", "y")


@query("g2_gain_at_threshold", sql(f"""SELECT model, CAST(coalesce(sum({GAIN}) FILTER (prob > 0.025e0), 0) AS DOUBLE) / 0.3e0 AS ganancia
FROM scores GROUP BY model""", SCORES))
def _(t):
    return gain.gain_at_threshold(t.scores(), "prob", "y", share=0.3, by=["model"])


@query("g3_gain_curve", sql("SELECT * FROM curve", SCORED, CURVE))
def _(t):
    return curve(t)


@query("g3_gain_curve_by_model", sql("SELECT * FROM curves", SCORES, CURVES))
def _(t):
    return curves(t)


@query("g3_documents_by_length", """SELECT doc_id, n_chars, quality, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS pos,
  CAST(sum(CASE WHEN quality = 1 THEN 780000 ELSE -20000 END) OVER (ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gan_acum
FROM labels JOIN documents USING (doc_id)""")
def _(t):
    known = t.table("labels").join(t.table("documents").select("doc_id", "n_chars"), "doc_id")
    return gain.gain_curve(known.select("doc_id", "n_chars", "quality"), "n_chars", "quality", ["doc_id"])


@query("g4_best_point", sql("""SELECT gan_acum AS ganancia_max, pos AS pos_max, prob AS umbral, (SELECT count(*) FROM curve) AS filas
FROM curve ORDER BY gan_acum DESC, pos LIMIT 1""", SCORED, CURVE))
def _(t):
    return gain.best_point(curve(t), "prob")


@query("g5_curve_maximum", sql("SELECT model, max(gan_acum) AS ganancia_max FROM curves GROUP BY model", SCORES, CURVES))
def _(t):
    return gain.best_point(curves(t), "prob", ["model"]).select("model", "ganancia_max")


_PLATEAU = """plateau AS (SELECT pos, CAST(sum(gan_acum) OVER w AS DOUBLE) / count(*) OVER w AS meseta, count(*) OVER w AS n
  FROM curve WINDOW w AS (ORDER BY pos ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING))"""


@query("g5_weight_coded_gain", sql("SELECT CAST(sum(CASE WHEN y = 1 THEN 780000 ELSE -20000 END) FILTER (prob > 0.5e0) AS DOUBLE) AS ganancia FROM scored", SCORED))
def _(t):
    """A metric that sees weights only: those of the rows that earn carry a mark."""
    weighted = t.scored().select("prob", F.when(F.col("y") == 1, 1.00002).otherwise(1.0).alias("peso"))
    return gain.gain_at_threshold(weighted.withColumn("y", gain.truth_of_weight("peso", 1.00002)), "prob", "y", 0.5)


@query("g6_plateau", sql("SELECT pos, meseta FROM plateau", SCORED, CURVE, _PLATEAU))
def _(t):
    return gain.plateau(curve(t), 101)


@query("g6_plateau_gain", sql("SELECT max(meseta) AS ganancia_meseta FROM plateau WHERE n = 101", SCORED, CURVE, _PLATEAU))
def _(t):
    return gain.plateau_gain(curve(t), 101, "drop")


@query("g6_plateau_gain_2001", sql("""SELECT max(meseta) AS ganancia_meseta FROM (SELECT CAST(sum(gan_acum) OVER w AS DOUBLE) / count(*) OVER w AS meseta
  FROM curve WINDOW w AS (ORDER BY pos ROWS BETWEEN 1000 PRECEDING AND 1000 FOLLOWING))""", SCORED, CURVE))
def _(t):
    return gain.plateau_gain(curve(t))


_CUTS = f"(SELECT unnest({CUTS}) AS corte)"


@query("g7_gain_at_cuts", sql(f"SELECT CAST(corte AS INTEGER) AS corte, gan_acum AS ganancia FROM {_CUTS} LEFT JOIN curve ON pos = corte", SCORED, CURVE))
def _(t):
    return gain.gain_at_cuts(t.scored(), "prob", "y", TIES, CUTS)


@query("g7_gain_at_cuts_by_model", sql("""SELECT m.model, CAST(corte AS INTEGER) AS corte, gan_acum AS ganancia
FROM (SELECT DISTINCT model FROM scores) m CROSS JOIN (SELECT unnest([50, 500, 1500]) AS corte)
LEFT JOIN curves c ON c.model = m.model AND pos = corte""", SCORES, CURVES))
def _(t):
    return gain.gain_at_cuts(t.scores(), "prob", "y", TIES, [50, 500, 1500], ["model"])


@query("g8_gain_of_top", sql(f"""SELECT CAST(corte AS INTEGER) AS corte, gan_acum AS ganancia FROM {_CUTS}
JOIN curve ON pos = least(corte, (SELECT count(*) FROM curve))""", SCORED, CURVE))
def _(t):
    return gain.gain_at_cuts(t.scored(), "prob", "y", TIES, CUTS, clip=True)


@query("g9_best_cut", sql("""SELECT corte, ganancia_media FROM (SELECT CAST(pos AS INTEGER) AS corte, CAST(sum(gan_acum) AS DOUBLE) / count(*) AS ganancia_media
  FROM curves WHERE pos IN (50, 500, 1000) GROUP BY pos) ORDER BY ganancia_media DESC, corte LIMIT 1""", SCORES, CURVES))
def _(t):
    return gain.best_cut(gain.gain_at_cuts(t.scores(), "prob", "y", TIES, [50, 500, 1000], ["model"]))


@query("g10_label_top", sql("SELECT id, mes, prob, y, CASE WHEN pos <= 1000 THEN 1 ELSE 0 END AS Predicted FROM curve", SCORED, CURVE))
def _(t):
    return gain.label_top(t.scored(), "prob", TIES, 1000)


@query("g10_label_top_null_scores", sql("""SELECT id, mes, prob, CASE WHEN pos <= (SELECT count(*) - 100 FROM scored) THEN 1 ELSE 0 END AS Predicted FROM (
  SELECT id, mes, prob, row_number() OVER (ORDER BY prob DESC NULLS LAST, id, mes) AS pos FROM (SELECT id, mes, CASE WHEN id % 3 > 0 THEN prob END AS prob FROM scored))""", SCORED))
def _(t):
    df = t.scored().select("id", "mes", F.when(F.col("id") % 3 > 0, F.col("prob")).alias("prob"))
    return gain.label_top(df, "prob", TIES, df.count() - 100)


@query("g11_label_by_thresholds", sql("""SELECT id, mes, prob, CAST(umbral AS DOUBLE) AS umbral, CAST(prob >= umbral AS INTEGER) AS Predicted
FROM scored, (SELECT unnest([0.025e0, 0.25e0, 0.9e0]) AS umbral)""", SCORED))
def _(t):
    return gain.label_by_thresholds(t.scored().select("id", "mes", "prob"), "prob", [0.025, 0.25, 0.9])


@query("g11_threshold_summary", sql("""SELECT umbral, count(*) FILTER (prob >= umbral) AS positivos,
  CAST(count(*) FILTER (prob >= umbral) AS DOUBLE) / count(*) AS share FROM scored, (SELECT unnest([0.025e0, 0.25e0, 0.9e0]) AS umbral) GROUP BY umbral""", SCORED))
def _(t):
    return gain.threshold_summary(t.scored(), "prob", [0.025, 0.25, 0.9])


@query("g12_label_by_cuts", sql("""SELECT id, mes, prob, CASE WHEN pos <= 100 THEN 1 ELSE 0 END AS Predicted_100,
  CASE WHEN pos <= 2500 THEN 1 ELSE 0 END AS Predicted_2500, 1 AS Predicted_1000000 FROM curve""", SCORED, CURVE))
def _(t):
    return gain.label_top(t.scored().select("id", "mes", "prob"), "prob", TIES, [100, 2500, 1000000])


_TARGET = """target AS (SELECT max(media) AS meta FROM (SELECT pos, CAST(sum(gan_acum) AS DOUBLE) / count(*) AS media
  FROM curves WHERE pos IN (50, 500, 1000) GROUP BY pos)),
nearest AS (SELECT abs(gan_acum - meta) AS distancia, model, pos FROM curves, target ORDER BY 1, 2, 3 LIMIT 1)"""


def _mean_best(t):
    cuts = gain.gain_at_cuts(t.scores(), "prob", "y", TIES, [50, 500, 1000], ["model"])
    return gain.best_cut(cuts).select("ganancia_media").scalar()


@query("g13_nearest_to_mean_best", sql("SELECT * FROM nearest", SCORES, CURVES, _TARGET))
def _(t):
    return gain.nearest_to_gain(curves(t), _mean_best(t), "model")


@query("g13_submission_of_nearest", sql("""SELECT c.id, CAST(c.pos <= n.pos AS INTEGER) AS Predicted
FROM curves c JOIN nearest n ON n.model = c.model""", SCORES, CURVES, _TARGET))
def _(t):
    return gain.submission_of_nearest(curves(t), _mean_best(t), "model", "id")


@query("g14_seed_ensemble", sql("SELECT id, mes, sum(prob) / count(prob) AS prob FROM scores GROUP BY id, mes", SCORES))
def _(t):
    return gain.ensemble(t.scores(), ["id", "mes"], "prob")


@query("g15_contact_list", sql(f"""SELECT id, prob, row_number() OVER (ORDER BY prob DESC, id) AS pos FROM (
  SELECT id, sum(prob) / count(prob) AS prob FROM scores GROUP BY id)
WHERE id IN (SELECT id FROM panel WHERE mes = {TRAIN_MONTH}) ORDER BY prob DESC, id LIMIT 100""", SCORES))
def _(t):
    future = t.panel().filter(F.col("mes") == TRAIN_MONTH)
    return gain.contact_list(t.scores(), future, "id", "prob", 100)


@query("g16_growing_ensemble", sql(f"""SELECT tree, CAST(coalesce(sum({GAIN}) FILTER (acum > tree * 0.025e0), 0) AS BIGINT) AS ganancia FROM (
  SELECT id, mes, y, model AS tree, sum(prob / 16) OVER (PARTITION BY id, mes ORDER BY model ROWS UNBOUNDED PRECEDING) AS acum FROM scores)
WHERE tree IN (1, 2, 4) GROUP BY tree""", SCORES))
def _(t):
    votes = t.scores().select("id", "mes", "y", F.col("model").alias("tree"), (F.col("prob") / 16).alias("prob"))
    return gain.growing_ensemble(votes, TIES, "tree", "prob", "y", [1, 2, 4])


_FOLDED = f"""folded AS (SELECT l.id, l.mes, l.clase_ternaria, {u('l.id', 'l.mes', 1)} AS prob,
  CASE WHEN (row_number() OVER (PARTITION BY clase_ternaria ORDER BY {u('l.id', 'l.mes', 77)}, l.id, l.mes) - 1) % 10 < 3 THEN 1 ELSE 2 END AS fold,
  CASE WHEN clase_ternaria = 'BAJA+2' THEN 780000 ELSE -20000 END AS g FROM labelled l)"""


def labelled_scores(t):
    return t.labelled().select("id", "mes", "clase_ternaria", hash_uniform("id", "mes", F.lit(1)).alias("prob"))


@query("g17_leaderboard", sql("""SELECT CAST(sum(g) FILTER (fold = 1) AS DOUBLE) / 0.3e0 AS public, CAST(sum(g) FILTER (fold = 2) AS DOUBLE) / 0.7e0 AS private,
  CAST(sum(g) AS BIGINT) AS total FROM folded WHERE prob > 0.6""", LABELLED, _FOLDED))
def _(t):
    contacted = labelled_scores(t).withColumn("Predicted", (F.col("prob") > 0.6).cast("int"))
    return leaderboard.leaderboard(contacted, "Predicted", "clase_ternaria", 77)


@query("g29_leaderboard_by_cut", sql("""SELECT CAST(corte AS INTEGER) AS corte, CAST(coalesce(sum(g) FILTER (fold = 1), 0) AS DOUBLE) / 0.3e0 AS public,
  CAST(coalesce(sum(g) FILTER (fold = 2), 0) AS DOUBLE) / 0.7e0 AS private, CAST(sum(g) AS BIGINT) AS total
FROM (SELECT unnest([200, 1000, 4000]) AS corte) JOIN (SELECT *, row_number() OVER (ORDER BY prob DESC, id, mes) AS pos FROM folded) ON pos <= corte
GROUP BY corte""", LABELLED, _FOLDED))
def _(t):
    return leaderboard.leaderboard_by_cut(labelled_scores(t), "prob", "clase_ternaria", [200, 1000, 4000], 77)


SPLITS = 50
_SPLIT = f"""split AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY split, y ORDER BY r, id, mes)
    <= round(count(*) OVER (PARTITION BY split, y) * 0.3e0) THEN 'public' ELSE 'private' END AS tipo
  FROM (SELECT *, {u('id', 'mes', 'split', 42)} AS r FROM scored, (SELECT CAST(unnest(range(0, {SPLITS})) AS INTEGER) AS split)))"""
_SIMULATED = f"""simulated AS (SELECT split, tipo, CAST(corte AS INTEGER) AS corte, CAST(sum({GAIN}) AS BIGINT) AS ganancia
  FROM (SELECT *, row_number() OVER (PARTITION BY split, tipo {ORDER}) AS pos FROM split) JOIN (SELECT unnest([100, 1000, 100000]) AS corte) ON pos <= corte
  GROUP BY 1, 2, 3)"""


def _simulation(t):
    return leaderboard.simulate_cuts(t.scored(), "prob", "y", [100, 1000, 100000], SPLITS)


@query("g18_simulate_cuts", sql("SELECT * FROM simulated", SCORED, _SPLIT, _SIMULATED))
def _(t):
    return _simulation(t)


@query("g19_summarise_cuts", sql("""SELECT *, 100 * (private - public) / nullif(public, 0) AS delta_pct FROM (SELECT corte,
  CAST(sum(ganancia) FILTER (tipo = 'public') AS DOUBLE) / count(*) FILTER (tipo = 'public') AS public,
  CAST(sum(ganancia) FILTER (tipo = 'private') AS DOUBLE) / count(*) FILTER (tipo = 'private') AS private FROM simulated GROUP BY corte)""",
    SCORED, _SPLIT, _SIMULATED))
def _(t):
    return leaderboard.summarise_cuts(_simulation(t))


N_RUNS = 50
_RESULTS = f"""drawn AS (SELECT *, {u('id', 'mes', 'split', 42)} AS r FROM (SELECT id, mes, y FROM scored), (SELECT CAST(unnest(range(0, {N_RUNS})) AS INTEGER) AS split)),
sides AS (SELECT id, mes, split, CASE WHEN row_number() OVER (PARTITION BY split, y ORDER BY r, id, mes)
    <= round(count(*) OVER (PARTITION BY split, y) * 0.3e0) THEN 'public' ELSE 'private' END AS tipo FROM drawn),
results AS (SELECT model, split, tipo, CAST(coalesce(sum({GAIN}) FILTER (prob >= 0.8e0), 0) AS DOUBLE)
    / CASE WHEN tipo = 'public' THEN 0.3e0 ELSE 1 - 0.3e0 END AS ganancia
  FROM scores JOIN sides USING (id, mes) GROUP BY model, split, tipo)"""


def results(t):
    return leaderboard.models_over_splits(t.scores(), "prob", "y", n_splits=N_RUNS, threshold=0.8)


def public_results(t):
    return results(t).filter("tipo = 'public'").select("model", F.col("split").alias("run"), "ganancia")


@query("g20_models_over_splits", sql("SELECT * FROM results", SCORED, SCORES, _RESULTS))
def _(t):
    return results(t)


@query("a17_best_public_vs_private", sql("""SELECT public, private, count(*) AS n FROM (SELECT split,
  (SELECT model FROM results b WHERE b.split = a.split AND tipo = 'public' ORDER BY ganancia DESC, model LIMIT 1) AS public,
  (SELECT model FROM results b WHERE b.split = a.split AND tipo = 'private' ORDER BY ganancia DESC, model LIMIT 1) AS private
  FROM (SELECT DISTINCT split FROM results) a) GROUP BY 1, 2""", SCORED, SCORES, _RESULTS))
def _(t):
    return leaderboard.best_public_vs_private(results(t))


@query("a18_long_results", sql("""SELECT split, split_part(name, '_', 1) AS model, split_part(name, '_', 2) AS tipo, value FROM (
  SELECT split, 'm' || model || '_' || tipo AS name, ganancia AS value FROM results)""", SCORED, SCORES, _RESULTS))
def _(t):
    names = [f"m{m}_{side}" for m in range(1, 6) for side in ("public", "private")]
    named = results(t).withColumn("name", F.concat(F.lit("m"), "model", F.lit("_"), "tipo"))
    wide = named.groupBy("split").pivot("name", names).agg(F.first("ganancia"))
    return leaderboard.to_long_results(wide, ["split"])





def _upper(z: str) -> str:
    t = f"(1 / (1 + 0.2316419e0 * abs({z})))"
    series = f"{t} * (0.319381530e0 + {t} * (-0.356563782e0 + {t} * (1.781477937e0 + {t} * (-1.821255978e0 + {t} * 1.330274429e0))))"
    tail = f"exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * {series}"
    return f"CASE WHEN {z} >= 0 THEN {tail} ELSE 1 - {tail} END"


def _tests(pairs: str, keys: str, correction: float) -> list[str]:
    return [f"""exact_counts(n, s, ways) AS (SELECT 0, 0, 1e0
  UNION ALL SELECT n, s, CAST(sum(ways) AS DOUBLE) FROM (
    SELECT n + 1 AS n, s, ways FROM exact_counts WHERE n < 50 UNION ALL SELECT n + 1, s + n + 1, ways FROM exact_counts WHERE n < 50) GROUP BY n, s)""",
            f"diffs AS (SELECT {keys}, x - y AS d FROM {pairs})",
            f"""ranked AS (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY abs(d)) + (count(*) OVER (PARTITION BY {keys}, abs(d)) - 1) / 2e0 AS r,
  count(*) OVER (PARTITION BY {keys}, abs(d)) AS t FROM diffs WHERE d <> 0)""",
            f"""sums AS (SELECT {keys}, count(*) AS n, coalesce(sum(r) FILTER (d > 0), 0) AS w_plus, coalesce(sum(r) FILTER (d < 0), 0) AS w_minus,
  CAST(sum(t * t - 1) AS DOUBLE) AS tie_term FROM ranked GROUP BY ALL)""",
            f"""ranks AS (SELECT {keys}, coalesce(n, 0) AS n, zeros, coalesce(w_plus, 0e0) AS w_plus, coalesce(w_minus, 0e0) AS w_minus,
  coalesce(tie_term, 0e0) AS tie_term, least(coalesce(w_plus, 0e0), coalesce(w_minus, 0e0)) AS estadistico
  FROM (SELECT {keys}, count(*) FILTER (d = 0) AS zeros FROM diffs GROUP BY ALL) LEFT JOIN sums USING ({keys}))""",
            f"""scaled AS (SELECT *, sqrt(n * (n + 1) * (2 * n + 1) / 24e0 - tie_term / 48) AS sd,
  abs(estadistico - n * (n + 1) / 4e0) - {correction}e0 AS gap FROM ranks)""",
            f"""tests AS (SELECT {keys}, n, zeros, w_plus, w_minus, tie_term, estadistico, CASE WHEN n = 0 THEN 1e0
  WHEN n <= 50 AND tie_term = 0 AND zeros = 0 THEN least(1, 2 * (SELECT sum(ways) FROM exact_counts e WHERE e.n = scaled.n AND e.s <= estadistico) / pow(2e0, n))
  WHEN sd > 0 THEN least(1e0, 2 * ({_upper('gap / sd')})) ELSE 1e0 END AS p FROM scaled)"""]


_PAIRS = """pairs AS (SELECT a.model AS model_a, b.model AS model_b, a.split AS run, a.ganancia AS x, b.ganancia AS y
  FROM results a JOIN results b ON a.split = b.split AND a.tipo = b.tipo AND a.model < b.model WHERE a.tipo = 'public')"""
_TESTS = [SCORED, SCORES, _RESULTS, _PAIRS, *_tests("pairs", "model_a, model_b", 0.0)]


def recursive(body: str, *ctes: str) -> str:
    return sql(body, *ctes).replace("WITH ", "WITH RECURSIVE ", 1)


@query("g21_wilcoxon", recursive("SELECT * EXCLUDE (p), round(p, 9) AS p FROM tests", *_TESTS))
def _(t):
    tests = leaderboard.compare_models(public_results(t))
    return tests.withColumn("p", F.round("p", 9))


@query("g22_rank_models", recursive("""SELECT m.model, coalesce(victorias, 0) AS victorias, mediana
FROM (SELECT model, quantile_cont(ganancia, 0.5) AS mediana FROM results WHERE tipo = 'public' GROUP BY model) m
LEFT JOIN (SELECT CASE WHEN ma.mediana > mb.mediana THEN model_a ELSE model_b END AS model, count(*) AS victorias FROM tests
  JOIN (SELECT model AS model_a, quantile_cont(ganancia, 0.5) AS mediana FROM results WHERE tipo = 'public' GROUP BY model) ma USING (model_a)
  JOIN (SELECT model AS model_b, quantile_cont(ganancia, 0.5) AS mediana FROM results WHERE tipo = 'public' GROUP BY model) mb USING (model_b)
  WHERE p < 0.05 GROUP BY 1) v ON v.model = m.model""", *_TESTS))
def _(t):
    return leaderboard.rank_models(public_results(t))


@query("g23_win_probability", sql("""SELECT model_a, model_b, CAST(count(*) FILTER (x > y) AS DOUBLE) / count(*) AS p_gana, round(sum(x) / count(x), 4) AS m1,
  round(sum(y) / count(y), 4) AS m2 FROM pairs GROUP BY 1, 2""", SCORED, SCORES, _RESULTS, _PAIRS))
def _(t):
    pairs = leaderboard.model_pairs(public_results(t), "model", "run", "ganancia")
    won = leaderboard.win_probability(pairs, "x", "y", ["model_a", "model_b"])
    return won.withColumns({"m1": F.round("m1", 4), "m2": F.round("m2", 4)})


@query("g24_sequential_comparison", recursive("""SELECT model_a, model_b, n_runs, round(p, 9) AS p, round(m1, 4) AS m1, round(m2, 4) AS m2,
  CAST(CASE WHEN p < 0.05 AND m1 > m2 THEN 1 WHEN p < 0.05 AND m1 < m2 THEN 2 ELSE 0 END AS INTEGER) AS out
FROM (SELECT *, row_number() OVER (PARTITION BY model_a, model_b ORDER BY p >= 0.05, CASE WHEN p < 0.05 THEN n_runs ELSE -n_runs END) AS k
  FROM tests JOIN (SELECT model_a, model_b, n_runs, sum(x) / count(x) AS m1, sum(y) / count(y) AS m2 FROM prefixes GROUP BY 1, 2, 3) USING (model_a, model_b, n_runs))
WHERE k = 1""", SCORED, SCORES, _RESULTS, _PAIRS,
    f"""prefixes AS (SELECT pairs.*, n_runs FROM pairs JOIN (SELECT CAST(unnest(range(1, {N_RUNS + 1})) AS INTEGER) AS n_runs) ON run < n_runs)""",
    *_tests("prefixes", "model_a, model_b, n_runs", 0.5)))
def _(t):
    pairs = leaderboard.model_pairs(public_results(t), "model", "run", "ganancia")
    found = leaderboard.sequential_comparison(pairs, "x", "y", "run", ["model_a", "model_b"])
    return found.withColumns({"p": F.round("p", 9), "m1": F.round("m1", 4), "m2": F.round("m2", 4)})


_PLAYERS = "players AS (SELECT mes, id, c_final AS aciertos, c_total + 10 AS tiros FROM panel)"


@query("g25_winner_vs_rest", sql(f"""SELECT mes, jugadores, mejor, tiros, round(resto, 12) AS resto, round(percentil, 9) AS percentil, round(z, 9) AS z, round({_upper('z')}, 9) AS p
FROM (SELECT *, (mejor - resto) / nullif(sqrt(resto * (1 - resto) / tiros), 0) AS z FROM (
  SELECT mes, count(*) AS jugadores, max(tasa) AS mejor, arg_max(tiros, (tasa, tiros)) AS tiros, (sum(tasa) - max(tasa)) / nullif(count(*) - 1, 0) AS resto,
    (SELECT CAST(count(*) AS DOUBLE) FROM rated r WHERE r.mes = q.mes AND r.tasa < (SELECT max(tasa) FROM rated s WHERE s.mes = q.mes)) / count(*) * 100 AS percentil
  FROM rated q GROUP BY mes))""", _PLAYERS, "rated AS (SELECT *, CAST(aciertos AS DOUBLE) / tiros AS tasa FROM players)"))
def _(t):
    players = t.panel().select("mes", "id", F.col("c_final").alias("aciertos"), (F.col("c_total") + 10).alias("tiros"))
    found = leaderboard.winner_vs_rest(players, ["mes"], "aciertos", "tiros")
    return found.withColumns({c: F.round(c, d) for c, d in (("resto", 12), ("percentil", 9), ("z", 9), ("p", 9))})


@query("g26_scaled_holdout", sql(f"""SELECT CAST(sum({GAIN}) FILTER (prob > 0.8) AS DOUBLE) / 0.3e0 AS ganancia
FROM scored WHERE {u('id', 'mes', 99)} < 0.3e0""", SCORED))
def _(t):
    held_out = t.scored().filter(hash_uniform("id", "mes", F.lit(99)) < 0.3)
    total = gain.gain_of_prediction(held_out.withColumn("p", (F.col("prob") > 0.8).cast("int")), "p", "y")
    return total.select(gain.scaled_up(F.col("ganancia"), 0.3).alias("ganancia"))


@query("g27_count_above", sql("SELECT count(*) FILTER (prob > 0.025e0) AS n FROM scored", SCORED))
def _(t):
    return gain.count_above(t.scored(), "prob")


@query("g27_relevant_part", sql("SELECT * FROM curve WHERE gan_acum >= 0.6e0 * (SELECT max(gan_acum) FROM curve)", SCORED, CURVE))
def _(t):
    return gain.relevant_part(curve(t))


@query("g27_curve_stretch", sql("SELECT * FROM curve WHERE pos BETWEEN 400 AND 2000", SCORED, CURVE))
def _(t):
    return gain.curve_stretch(curve(t, top=2000), 400, 2000)


@query("g28_curve_by_fold", sql(f"""SELECT id, mes, prob, y, fold, row_number() OVER w AS pos,
  CAST(sum({GAIN}) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) / 0.5e0 AS gan_acum
FROM (SELECT *, CAST(1 + floor({u('id', 'mes', 31)} * 2) AS INTEGER) AS fold FROM scored)
WINDOW w AS (PARTITION BY fold ORDER BY prob DESC, id, mes)""", SCORED))
def _(t):
    folded = t.scored().withColumn("fold", (1 + F.floor(hash_uniform("id", "mes", F.lit(31)) * 2)).cast("int"))
    by_fold = gain.gain_curve(folded, "prob", "y", TIES, ["fold"])
    return by_fold.withColumn("gan_acum", gain.scaled_up(F.col("gan_acum"), 0.5))


# --- flagship: label, history, ranks, ensemble and gain in one chain

_FLAG_W = "(PARTITION BY id ORDER BY periodo)"


@query("flagship", sql(f"""SELECT clase_ternaria, count(*) AS filas, count(m_total_lag_1) AS con_historia,
  CAST(sum(m_total_delta_1) AS BIGINT) AS cambio, round(sum(tend), 3) AS tendencia, round(sum(rango), 6) AS rango,
  count(*) FILTER (pos <= 1000) AS contactados, CAST(coalesce(sum(CASE WHEN clase_ternaria = 'BAJA+2' THEN 780000 ELSE -20000 END) FILTER (pos <= 1000), 0) AS BIGINT) AS ganancia
FROM (SELECT l.*, lag(m_total) OVER {_FLAG_W} AS m_total_lag_1, m_total - lag(m_total) OVER {_FLAG_W} AS m_total_delta_1,
    CASE WHEN count(m_total) OVER f >= 2 THEN CAST(count(m_total) OVER f * sum(rn * m_total) OVER f - sum(rn) OVER f * sum(m_total) OVER f AS DOUBLE)
      / (count(m_total) OVER f * sum(rn * rn) OVER f - sum(rn) OVER f * sum(rn) OVER f) END AS tend,
    CASE WHEN m_net = 0 THEN 0 ELSE percent_rank() OVER (PARTITION BY mes, sign(m_net) ORDER BY m_net) - CASE WHEN m_net < 0 THEN 1 ELSE 0 END END AS rango,
    row_number() OVER (ORDER BY e.prob DESC, id, mes) AS pos
  FROM (SELECT *, row_number() OVER {_FLAG_W} AS rn FROM labelled) l
  JOIN (SELECT id, mes, sum(prob) / count(prob) AS prob FROM scores GROUP BY id, mes) e USING (id, mes)
  WINDOW f AS (PARTITION BY id ORDER BY periodo ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
GROUP BY clase_ternaria""", LABELLED, SCORES))
def _(t):
    featured = history.trend_pack(history.lags(t.labelled(), ["m_total"]), ["m_total"], 6)
    ranked = ranks.signed_rank(featured, ["m_net"], "signed", replace=False)
    scored = materialize(ranked.join(gain.ensemble(t.scores(), TIES, "prob"), TIES).select(
        *TIES, "prob", "clase_ternaria", "m_total_lag_1", "m_total_delta_1", "m_total_tend6", "pct_rank_m_net"), "flagship")
    labelled = gain.label_top(scored, "prob", TIES, 1000, out="contactado")
    contacted = F.col("contactado") == 1
    return labelled.groupBy("clase_ternaria").agg(
        F.count(F.lit(1)).alias("filas"), F.count("m_total_lag_1").alias("con_historia"),
        F.sum("m_total_delta_1").alias("cambio"), F.round(F.sum("m_total_tend6"), 3).alias("tendencia"),
        F.round(F.sum("pct_rank_m_net"), 6).alias("rango"), F.count_if(contacted).alias("contactados"),
        F.coalesce(F.sum(F.when(contacted, gain_of(F.coalesce(F.col("clase_ternaria") == "BAJA+2", F.lit(False))))), F.lit(0)).alias("ganancia"))
