"""Hyper-parameter search and model leaderboards over MLlib estimators.

Each trial is a distributed MLlib fit; the trial list itself is tiny (tens of rows) and lives
on the driver, the data never does. Candidates come from a seeded generator so searches are
reproducible.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions import hashing as H
from driftline.operators.models import regression_metrics
from driftline.operators.trees import (DecisionTreeClassifier, DecisionTreeRegressor, GBTClassifier, GBTRegressor,
                                       RandomForestClassifier, RandomForestRegressor)
from driftline.session import materialize_small, work_dir


def sample_space(space: dict, rng: random.Random) -> dict:
    out = {}
    for name, spec in space.items():
        kind = spec[0]
        if kind == "uniform":
            out[name] = rng.uniform(spec[1], spec[2])
        elif kind == "loguniform":
            out[name] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        elif kind == "quniform":
            out[name] = round(rng.uniform(spec[1], spec[2]) / spec[3]) * spec[3]
        elif kind == "choice":
            out[name] = rng.choice(spec[1])
        else:
            raise ValueError(kind)
    return out


ROWS_PER_FILE = 250_000
ROWS_AT_ONCE = 16_000_000


def training_table(df: DataFrame, name: str = "training") -> DataFrame:
    """``df`` written once and read back: a fit makes four passes over its input before its own loop
    starts, and a search does so for every trial. Files of equal numbers of rows let Spark deal the rows
    evenly to its tasks."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return spark.read.parquet(path)


def prepared(prepare: list, train: DataFrame, others: list[DataFrame], keep: list[str]) -> tuple[PipelineModel, list[DataFrame]]:
    """Stages ``prepare`` fitted on ``train`` only, and ``train`` and ``others`` as written tables of
    ``keep`` and the features, for any number of fits."""
    model = Pipeline(stages=prepare).fit(train)
    return model, [training_table(model.transform(d).select(*keep, "features")) for d in (train, *others)]


def trials_at_once(table: DataFrame, most: int) -> int:
    """How many trials over the rows of a written ``table`` fit at the same time, ``most`` at best.
    MLlib keeps the binned rows of every running tree fit in the executors' memory; a large table fills
    it, and all cores, with one trial, and more of them push each other's rows to disk."""
    return max(1, min(most, ROWS_AT_ONCE // max(1, table.count())))


def seeded_candidates(spark: SparkSession, space: dict, n: int, seed: int = 42) -> DataFrame:
    """(trial_id, <params>) rows drawn from ``space`` with a fixed seed."""
    rng = random.Random(seed)
    rows = [(i, *[float(v) for v in sample_space(space, rng).values()]) for i in range(n)]
    schema = "trial_id long, " + ", ".join(f"{k} double" for k in space)
    return spark.createDataFrame(rows, schema)


def random_search(spark: SparkSession, df: DataFrame, indexer, assembler, label: str, space: dict,
                  n_trials: int = 4, seed: int = 42, max_bins: int = 32, parallelism: int = 4) -> DataFrame:
    """Seeded random search for a forest: fit on train, score on validation (never on the
    training rows), refit the best on train + validation and report its test RMSE.

    The search is not adaptive, so every trial's settings are drawn first and up to
    ``parallelism`` trials fit at once (concurrent Spark jobs from driver threads). The indexer is
    fitted once for all trials, on train, and once more for the refit."""
    train, val, test = H.hash_split3(df, "l_orderkey")
    _, [fit_on, score_on] = prepared([indexer, assembler], train, [val], [label])
    rng = random.Random(seed)
    settings = [sample_space(space, rng) for _ in range(n_trials)]

    def trial(t):
        p = settings[t]
        rf = RandomForestRegressor(labelCol=label, maxDepth=int(p["maxDepth"]), numTrees=int(p["numTrees"]),
                                   maxBins=max_bins, seed=seed)
        m = regression_metrics(rf.fit(fit_on).transform(score_on), label, "prediction").first()
        return (t, int(p["maxDepth"]), int(p["numTrees"]), float(m["rmse"]), float(m["r2"]))

    with ThreadPoolExecutor(max_workers=trials_at_once(fit_on, parallelism)) as pool:
        rows = list(pool.map(trial, range(n_trials)))
    best = min(rows, key=lambda r: r[3])
    rf = RandomForestRegressor(labelCol=label, maxDepth=best[1], numTrees=best[2], maxBins=max_bins, seed=seed)
    _, [fit_on, score_on] = prepared([indexer, assembler], train.unionByName(val), [test], [label])
    test_rmse = float(regression_metrics(rf.fit(fit_on).transform(score_on), label, "prediction").first()["rmse"])
    out = [(*r, r == best, test_rmse if r == best else None) for r in rows]
    return spark.createDataFrame(out, "trial int, max_depth int, num_trees int, val_rmse double, val_r2 double, "
                                      "is_best boolean, test_rmse double")


class FoldwiseCrossValidator(CrossValidator):
    """Cross-validation with preparing stages fitted on each fold's training rows, as if they stood in the
    estimator's pipeline, but once per fold and not again for every setting of the grid. ``fit_rows``
    splits ``rows``, and refits the best setting on all of them, prepared alike."""

    def __init__(self, prepare: list, rows: DataFrame, keep: list[str], **params):
        super().__init__(**params)
        self.prepare, self.rows, self.keep = prepare, rows, keep

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        return [tuple(prepared(self.prepare, train, [held_out], self.keep)[1]) for train, held_out in super()._kFold(self.rows)]

    def fit_rows(self):
        return self.fit(prepared(self.prepare, self.rows, [], self.keep)[1][0])


# ------------------------------------------------------------------------ adaptive search
MAX_TRIALS = 1000


def _scale(spec: tuple, v) -> float:
    return math.log(v) if spec[0] == "loguniform" else float(v)


def _kernels(spec: tuple, seen: list) -> list[tuple[float, float]]:
    """(centre, width) of one kernel per seen setting and a wide one for the whole range. A kernel reaches
    to the farther of its neighbours, but is never narrower than a share of the range."""
    lo, hi = (_scale(spec, x) for x in spec[1:3])
    span = (hi - lo) or 1.0
    at = sorted([_scale(spec, s) for s in seen] + [(lo + hi) / 2])
    wide = at.index((lo + hi) / 2)
    out = []
    for i, x in enumerate(at):
        reach = max(x - at[i - 1] if i else x - lo, at[i + 1] - x if i + 1 < len(at) else hi - x)
        out.append((x, span if i == wide else min(max(reach, span / min(100, 2 + len(at))), span)))
    return out


def _log_density(spec: tuple, v, seen: list) -> float:
    """Log density of a mixture around the seen settings, at ``v``."""
    if spec[0] == "choice":
        return math.log((seen.count(v) + 1 / len(spec[1])) / (len(seen) + 1))
    x, kernels = _scale(spec, v), _kernels(spec, seen)
    total = sum(math.exp(-0.5 * ((x - m) / w) ** 2) / w for m, w in kernels)
    return math.log(total / len(kernels) + 1e-300)


def _near(spec: tuple, seen: list, rng: random.Random):
    """A draw from the mixture around ``seen``."""
    if spec[0] == "choice":
        pick = rng.randrange(len(seen) + 1)
        return seen[pick] if pick < len(seen) else rng.choice(spec[1])
    lo, hi = (_scale(spec, x) for x in spec[1:3])
    m, w = rng.choice(_kernels(spec, seen))
    x = rng.gauss(m, w)
    for _ in range(20):  # within the range
        if lo <= x <= hi:
            break
        x = rng.gauss(m, w)
    x = min(max(x, lo), hi)
    x = math.exp(x) if spec[0] == "loguniform" else x
    return round(x / spec[3]) * spec[3] if spec[0] == "quniform" else x


def propose(space: dict, trials: list[tuple[dict, float]], n: int, rng: random.Random, draws: int = 24) -> list[dict]:
    """``n`` settings to try next. The finished trials are split into the best (the root
    of their number) and the rest; each parameter is drawn from a density around the good settings,
    and of ``draws`` draws the one is taken whose density among good settings, relative to that among
    bad ones, is largest. The last setting of a round is drawn at random, against early narrowing."""
    ranked = [s for s, _ in sorted(trials, key=lambda t: t[1])]
    cut = max(1, math.ceil(math.sqrt(len(ranked))))
    good, bad = ranked[:cut], ranked[cut:]
    out = []
    for i in range(n):
        if i and i == n - 1:
            out.append(sample_space(space, rng))
            continue
        pool = [{k: _near(spec, [g[k] for g in good], rng) for k, spec in space.items()} for _ in range(draws)]
        gain = lambda s: sum(_log_density(spec, s[k], [g[k] for g in good]) - _log_density(spec, s[k], [b[k] for b in bad])
                             for k, spec in space.items())
        out.append(max(pool, key=gain))
        bad = bad + [out[-1]]  # settings of one round keep apart
    return out


def adaptive_search(space: dict, losses, max_trials: int, startup: int = 8, batch: int = 4, seed: int = 42) -> list[tuple[dict, float]]:
    """Search that learns from its finished trials. ``losses(settings) -> list[float]`` runs a round of
    trials (distributed fits); the first ``startup`` settings are drawn at random, later rounds of
    ``batch`` come from :func:`propose`. Returns all trials in order; at most ``max_trials``."""
    if not 1 <= max_trials <= MAX_TRIALS:
        raise ValueError(f"max_trials must lie between 1 and {MAX_TRIALS}")
    rng = random.Random(seed)
    trials: list[tuple[dict, float]] = []
    while len(trials) < max_trials:
        n = min(startup if not trials else batch, max_trials - len(trials))
        settings = propose(space, trials, n, rng) if trials else [sample_space(space, rng) for _ in range(n)]
        trials += list(zip(settings, losses(settings), strict=True))
    return trials


# ------------------------------------------------------------------------ leaderboards
def _score_table(candidates: dict, prepare, train: DataFrame, test: DataFrame, keep: list[str], columns, parallelism: int) -> tuple[dict, DataFrame]:
    """Fit every candidate on ``train`` (up to ``parallelism`` at once) and write the scores of all models
    on ``test`` as one table partitioned by trial, which every metric is read from. ``prepare`` is fitted
    once, on ``train``, and both sides are written with their features and the columns ``keep``."""
    path = work_dir(train.sparkSession, "scores")
    first, [train, test] = prepared(prepare, train, [test], keep)

    def fit_one(item):
        name, est = item
        model = est.fit(train)
        columns(model.transform(test)).write.parquet(f"{path}/trial={name}")
        return name, PipelineModel(stages=[*first.stages, model])

    with ThreadPoolExecutor(max_workers=trials_at_once(train, parallelism)) as pool:
        models = dict(pool.map(fit_one, candidates.items()))
    return models, train.sparkSession.read.parquet(path)


def regression_candidates(label: str, max_bins: int = 32) -> dict:
    return {
        "linear_regression": LinearRegression(labelCol=label),
        "decision_tree": DecisionTreeRegressor(labelCol=label, maxDepth=5, maxBins=max_bins),
        "random_forest": RandomForestRegressor(labelCol=label, maxDepth=5, numTrees=20, maxBins=max_bins, seed=42),
        "gbt": GBTRegressor(labelCol=label, maxDepth=4, maxIter=20, maxBins=max_bins, seed=42),
    }


def leaderboard(df: DataFrame, indexer, assembler, label: str, max_bins: int = 32,
                primary_metric: str = "r2", parallelism: int = 4) -> DataFrame:
    """Try a fixed list of MLlib regressors (fitted concurrently, up to ``parallelism`` at
    once) and rank them by ``primary_metric`` on held-out rows: one grouped aggregate over the written
    scores of all models."""
    train, test = H.hash_split(df, "l_orderkey", 80)
    _, scores = _score_table(regression_candidates(label, max_bins), [indexer, assembler], train, test, [label],
                             lambda d: d.select(F.col(label).cast("double").alias("y"), "prediction"), parallelism)
    lb = regression_metrics(scores, "y", "prediction", ["trial"]).select(F.col("trial").alias("model"), "r2", "rmse", "mse", "mae")
    lb = materialize_small(lb)  # a row per candidate
    asc = primary_metric in ("rmse", "mse", "mae")
    order = F.asc(primary_metric) if asc else F.desc(primary_metric)
    return lb.withColumn("rank", F.row_number().over(Window.orderBy(order, "model")))


def classification_candidates(label: str, binary: bool, max_bins: int = 32) -> dict:
    """Fixed list, simplest first; boosted trees know two classes only."""
    found = {
        "logistic_regression": LogisticRegression(labelCol=label, maxIter=30, regParam=0.001),
        "decision_tree": DecisionTreeClassifier(labelCol=label, maxDepth=5, maxBins=max_bins, seed=42),
        "random_forest": RandomForestClassifier(labelCol=label, maxDepth=5, numTrees=20, maxBins=max_bins, seed=42),
        "decision_tree_deep": DecisionTreeClassifier(labelCol=label, maxDepth=10, maxBins=max_bins, seed=42),
        "random_forest_wide": RandomForestClassifier(labelCol=label, maxDepth=8, numTrees=40, maxBins=max_bins, seed=42),
    }
    if binary:
        found["gbt"] = GBTClassifier(labelCol=label, maxDepth=4, maxIter=20, maxBins=max_bins, seed=42)
    return found


def class_metrics(scores: DataFrame, keys: tuple[str, ...] = ("trial",), eps: float = 1e-15) -> DataFrame:
    """Accuracy, log loss and the class-weighted f1, precision and recall of (keys, y, prediction, p_true),
    p_true being the probability given to the true class: grouped counts per (keys, y, prediction),
    then per class, then per key. Rows are aggregated once; a class holding most rows is a count."""
    k = list(keys)
    loss = -F.log(F.greatest(F.least(F.col("p_true"), F.lit(1 - eps)), F.lit(eps)))
    cells = scores.groupBy(*k, "y", "prediction").agg(F.count(F.lit(1)).alias("n"), F.sum(loss).alias("loss"))
    # each cell counts for its true class and for the predicted one
    sides = F.array(F.struct(F.col("y").alias("c"), F.col("n").alias("true"), F.lit(0).cast("bigint").alias("said"), "loss"),
                    F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("true"), F.col("n").alias("said"), F.lit(0.0).alias("loss")))
    hit = F.when(F.col("y") == F.col("prediction"), F.col("n")).otherwise(0)
    per = (cells.select(*k, hit.alias("hit"), F.posexplode(sides).alias("side", "s"))
           .groupBy(*k, "s.c").agg(F.sum("s.true").alias("true"), F.sum("s.said").alias("said"), F.sum("s.loss").alias("loss"),
                                   F.sum(F.when(F.col("side") == 0, F.col("hit")).otherwise(0)).alias("hit")))
    zero = lambda e: F.coalesce(e, F.lit(0.0))
    total = F.sum("true")
    out = per.groupBy(*k).agg(
        total.alias("n"), (F.sum("hit") / total).alias("accuracy"), (F.sum("loss") / total).alias("log_loss"),
        (F.sum(F.col("true") * zero(F.try_divide(2.0 * F.col("hit"), F.col("true") + F.col("said")))) / total).alias("f1"),
        (F.sum(F.col("true") * zero(F.try_divide(1.0 * F.col("hit"), F.col("said")))) / total).alias("precision"),
        (F.sum("hit") / total).alias("recall"))
    return out


def class_leaderboard(df: DataFrame, prepare: list, label: str, key: str, primary_metric: str = "log_loss", max_trials: int = 6,
                      parallelism: int = 4, max_bins: int = 32) -> tuple[DataFrame, object, DataFrame]:
    """Leaderboard for classification: (leaderboard, best fitted model, written scores).

    ``prepare`` are the pipeline stages that make ``features``; ``label`` holds class numbers from 0. Up to
    ``max_trials`` candidates are fitted on the training rows (hash split on ``key``), scored once into
    a written table (trial, key, y, prediction, p_true), and ranked by ``primary_metric``."""
    if max_trials < 1:
        raise ValueError("max_trials must be at least 1")
    from pyspark.ml.functions import vector_to_array
    train, test = H.hash_split(df, key, 80)
    binary = (df.agg(F.max(label)).first()[0] or 0) < 2
    candidates = dict(list(classification_candidates(label, binary, max_bins).items())[:max_trials])
    p_true = F.coalesce(F.get(vector_to_array("probability"), F.col(label).cast("int")), F.lit(0.0))  # a class not met in training
    models, scores = _score_table(candidates, prepare, train, test, [key, label],
                                  lambda d: d.select(key, F.col(label).cast("double").alias("y"), "prediction", p_true.alias("p_true")), parallelism)
    board = materialize_small(class_metrics(scores))  # a row per candidate
    order = F.asc(primary_metric) if primary_metric == "log_loss" else F.desc(primary_metric)
    board = board.withColumn("rank", F.row_number().over(Window.orderBy(order, "trial")))
    best = board.filter("rank = 1").first()["trial"]
    return board, models[best], scores
