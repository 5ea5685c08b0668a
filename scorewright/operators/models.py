"""Training jobs: preprocessing and classifiers as MLlib pipelines over the feature columns.

Fits are actions. A table that is fitted several times should be checkpointed or read from a
written table, so that its lineage is not recomputed for every pass.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_order
from ..schema import PAY_STATUS, TARGET, UTILISATION_FEATURES
from ..session import reliable_checkpoint
from .boosting import TREES, Boosted, Spec, boost_many, many_predictions
from .confusion import classification_report, confusion, counts_at_thresholds, threshold_grid
from .curves import ranking_metrics
from .fairness import four_gaps
from .mitigation import equalised_odds, mixed_decision, reweigh
from .neighbours import oversample_minority
from .network import EPOCHS, Network, fit_network
from .ordering import by_hash_prefix, exact_quantiles
from .selection import choose_policy, select_preferred, union_frames

SEED = 42
# Learner settings.
LOGISTIC_ITERATIONS = 1500
FOREST_TREES, FOREST_LEAF = 120, 20


def split_types(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    types = dict(df.dtypes)
    text = [n for n in features if types[n] == "string"]
    return [n for n in features if n not in text], text


def preprocess_stages(df: DataFrame, features: list[str], output: str = "features") -> list:
    """Median and scaling for numbers; most frequent value and one-hot for text.

    Medians are exact, found at once on ``df``; a column without any value is filled with 0. Text levels
    are indexed by frequency, so an unseen or missing level gets a slot of its own.
    """
    numbers, text = split_types(df, features)
    stages, parts = [], []
    if numbers:
        filled = [f"{n}__filled" for n in numbers]
        present = df.select(*[F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double")).alias(n) for n in numbers])
        middle = {r["feature"]: r["quantiles"][0] for r in exact_quantiles(present, numbers, [0.5]).collect()}
        fill = ", ".join(f"coalesce(nullif(cast(`{n}` as double), double('NaN')), {middle.get(n, 0.0)!r}D) as `{f}`" for n, f in zip(numbers, filled))
        stages += [
            SQLTransformer(statement=f"select *, {fill} from __THIS__"),
            VectorAssembler(inputCols=filled, outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True),
        ]
        parts.append("scaled")
    if text:
        indexed, encoded = [f"{n}__index" for n in text], [f"{n}__levels" for n in text]
        stages += [
            StringIndexer(inputCols=text, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(
                inputCols=indexed, outputCols=encoded, dropLast=False, handleInvalid="keep"
            ),
        ]
        parts += encoded
    return [*stages, VectorAssembler(inputCols=parts, outputCol=output)]


def _as_double(df: DataFrame, features: list[str]) -> DataFrame:
    numbers, _ = split_types(df, features)
    return df.withColumns({n: F.col(n).cast("double") for n in numbers})


class Scored:
    """A fitted pipeline that adds ``probability`` (of class 1) to a table of features."""

    def __init__(self, pipeline: PipelineModel, features: list[str]):
        self.pipeline, self.features = pipeline, features

    def __call__(self, df: DataFrame) -> DataFrame:
        made = self.pipeline.transform(_as_double(df, self.features))
        score = vector_to_array("probability")[1]
        return made.withColumn("_p", score).select(*df.columns, F.col("_p").alias("probability"))

    def predictions(self, df: DataFrame, key: str, name: str, target: str = TARGET) -> DataFrame:
        """The scored contract: key, ``y_true, y_proba, model_name, split``."""
        return self(df).select(
            key,
            F.col(target).cast("int").alias("y_true"),
            F.col("probability").alias("y_proba"),
            F.lit(name).alias("model_name"),
            "split",
        )

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, features: list[str]) -> Scored:
        return cls(PipelineModel.load(path), features)


def matrix_scorer(model: Scored) -> Callable:
    """A fitted logistic model of numeric features as a function of a matrix without missing values."""
    scaler, learner = model.pipeline.stages[2], model.pipeline.stages[-1]
    mean, spread = scaler.mean.toArray(), scaler.std.toArray()
    slopes, intercept = learner.coefficients.toArray(), float(learner.intercept)
    factor = slopes / np.where(spread == 0, np.inf, spread)

    def score(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-((x - mean) @ factor + intercept)))

    return score


def _fit(df: DataFrame, features: list[str], estimator) -> Scored:
    """The vectors are written once; the learner's many passes read these."""
    table = _as_double(df, features)
    prepared = Pipeline(stages=preprocess_stages(df, features)).fit(table)
    kept = [estimator.getLabelCol(), *([estimator.getWeightCol()] if estimator.hasParam("weightCol") and estimator.isSet("weightCol") else [])]
    vectors = reliable_checkpoint(prepared.transform(table).select("features", *dict.fromkeys(kept)))
    return Scored(PipelineModel([*prepared.stages, estimator.fit(vectors)]), features)


def with_class_weight(df: DataFrame, positive: float | None, target: str = TARGET) -> DataFrame:
    """Adds ``weight``: the given positive weight, or balanced weights for ``None``."""
    if positive is not None:
        return df.withColumn(
            "weight", F.when(F.col(target) == 1, float(positive)).otherwise(1.0)
        )
    share = df.agg(F.avg(F.col(target).cast("double"))).scalar()
    with_share = df.withColumn("_share", share)
    side = F.when(F.col(target) == 1, F.col("_share")).otherwise(1 - F.col("_share"))
    return with_share.withColumn("weight", 0.5 / side).drop("_share")


def train_logistic(
    df: DataFrame, features: list[str], target: str = TARGET, weight: str | None = None,
    balanced: bool = True, iterations: int = LOGISTIC_ITERATIONS,
) -> Scored:
    """L2 logistic regression with unit strength on balanced classes."""
    table = df if weight or not balanced else with_class_weight(df, None, target)
    column = weight or ("weight" if balanced else None)
    total = table.agg(F.sum(column) if column else F.count("*")).first()[0]
    learner = LogisticRegression(
        labelCol=target, regParam=1.0 / float(total), elasticNetParam=0.0, maxIter=iterations,
        standardization=False,
    )
    if column:
        learner = learner.setWeightCol(column)
    return _fit(table, features, learner)


def train_boosted(
    df: DataFrame, features: list[str], target: str = TARGET, weight: str | None = None,
    positive_weight: float = 1.0, trees: int = TREES,
) -> Boosted:
    """Second-order boosted trees with row and column sampling and a positive-class weight."""
    spec = Spec(positive_weight, weight)
    return boost_many(df, features, {"boosted": spec}, target, trees)["boosted"]


def train_forest(df: DataFrame, features: list[str], target: str = TARGET) -> Scored:
    learner = RandomForestClassifier(
        labelCol=target, weightCol="weight", numTrees=FOREST_TREES,
        minInstancesPerNode=FOREST_LEAF, seed=SEED,
    )
    return _fit(with_class_weight(df, None, target), features, learner)


def train_mlp(
    df: DataFrame, features: list[str], target: str = TARGET, validation: DataFrame | None = None,
    balanced: bool = False, epochs: int = EPOCHS,
) -> Network:
    """A 64-32-16 network with batch normalisation, dropout and Adam; ``balanced`` weighs the classes alike.

    Stops at the best average precision on the ``validation`` rows; without these, on the train rows.
    """
    typed = _as_double(df, features)
    prepared = Pipeline(stages=preprocess_stages(df, features)).fit(typed)

    def vectors(table: DataFrame) -> DataFrame:
        made = prepared.transform(table.where(F.col(target).isin(0, 1)))
        return made.select(vector_to_array("features").alias("_x"), F.col(target).cast("double").alias("_y"))

    held = typed if validation is None else _as_double(validation, features)
    fitted = fit_network(vectors(typed), vectors(held), balanced, epochs)
    return Network(prepared, features, _as_double, *fitted)


Trainer = Callable[[DataFrame, list[str]], Scored]


def _side(df: DataFrame, *names: str) -> DataFrame:
    return df.where(F.col("split").isin(*names))


def fit_evaluate(
    split: DataFrame, features: list[str], trainer: Trainer, name: str, key: str,
    target: str = TARGET,
) -> tuple[Scored, DataFrame, DataFrame]:
    """Fit on train, score test: the model, the test predictions and their report row."""
    model = trainer(_side(split, "train", "validation"), features)
    predictions = model.predictions(_side(split, "test"), key, name, target)
    return model, predictions, classification_report(predictions, 0.50, ["model_name"])


def fit_many(jobs: dict[str, Callable[[], DataFrame]], at_once: int = 4) -> list[DataFrame]:
    """Run independent fits side by side; each job returns the table it made."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(lambda job: job(), jobs.values()))


def standard_compare(
    split: DataFrame, public: list[str], diagnostic: list[str], key: str,
    boosted: Trainer = train_boosted,
) -> DataFrame:
    """Logistic, boosted, and boosted with the protected attribute, best area first."""
    runs = {
        "logistic_public": (public, train_logistic),
        "boosted_public": (public, boosted),
        "boosted_full_diagnostic": (diagnostic, boosted),
    }
    rows = fit_many(
        {
            name: lambda name=name, f=f, t=t: fit_evaluate(split, f, t, name, key)[2].withColumn(
                "feature_count", F.lit(len(f))
            )
            for name, (f, t) in runs.items()
        }
    )
    return union_frames(rows).orderBy(F.desc("roc_auc"), F.desc("accuracy"))


def ablation_sets(features: list[str]) -> dict[str, list[str]]:
    """Feature lists with one group of columns left out."""
    groups = {
        "baseline_application_public": [],
        "without_repayment_status": PAY_STATUS,
        "without_utilization_ratios": UTILISATION_FEATURES,
        "without_profile_fields": ["AGE", "MARRIAGE", "EDUCATION"],
    }
    return {name: [f for f in features if f not in left] for name, left in groups.items()}


def ablation(split: DataFrame, features: list[str], key: str, trainer: Trainer = train_boosted):
    """Report row of every reduced feature set, best area first."""
    rows = fit_many(
        {
            name: lambda name=name, kept=kept: fit_evaluate(split, kept, trainer, name, key)[2]
            .withColumn("feature_count", F.lit(len(kept)))
            for name, kept in ablation_sets(features).items()
        }
    )
    return union_frames(rows).withColumnRenamed("model_name", "ablation").orderBy(F.desc("roc_auc"))


def importance(model: Scored | Boosted) -> DataFrame:
    """Feature importances of a tree model or coefficients of a linear one, largest first.

    Boosted trees: a feature's mean gain a split, as a share of all. For other models on numeric features, whose vector has one entry per feature.
    """
    if isinstance(model, Boosted):
        rows = [(n, float(v)) for n, v in model.importances().items()]
    else:
        learner = model.pipeline.stages[-1]
        linear = hasattr(learner, "coefficients")
        values = learner.coefficients if linear else learner.featureImportances
        rows = [(n, float(v)) for n, v in zip(model.features, values.toArray())]
    spark = SparkSession.getActiveSession()
    table = spark.createDataFrame(rows, "feature string, score double")
    return table.withColumn("absolute_score", F.abs("score")).orderBy(F.desc("absolute_score"))


def proxy_predictability(
    split: DataFrame, features: list[str], key: str, protected: str = "SEX"
) -> tuple[DataFrame, DataFrame]:
    """Can the protected attribute be told from the other features? Measures and importances.

    Needs exactly two classes in the train rows, else one ``skipped`` row.
    """
    spark = split.sparkSession
    train = _side(split, "train", "validation").where(F.col(protected).isNotNull())
    codes = sorted(r[0] for r in train.select(protected).distinct().limit(3).collect())
    if len(codes) != 2:
        reason = f"{protected} is not cleanly binary in the current split."
        skipped = spark.createDataFrame(
            [("proxy_logistic", "skipped", reason)], "model string, status string, reason string"
        )
        none = spark.createDataFrame([], "model string, feature string, score double, "
                                         "absolute_score double")
        return skipped, none
    labelled = split.withColumn("_label", (F.col(protected) == codes[-1]).cast("int"))

    def logistic(df, names):
        return train_logistic(df, names, "_label", balanced=False)

    def forest(df, names):
        return train_forest(df, names, "_label")

    reports, scores = [], []
    for name, trainer in (
        ("proxy_logistic_regression", logistic),
        ("proxy_random_forest", forest),
    ):
        model, _, report = fit_evaluate(labelled, features, trainer, name, key, "_label")
        reports.append(
            report.select(
                F.col("model_name").alias("model"),
                F.lit("completed").alias("status"),
                F.lit(int(codes[-1])).alias("positive_class_sex_code"),
                "accuracy",
                "roc_auc",
                "pr_auc",
            )
        )
        scores.append(importance(model).withColumn("model", F.lit(name)))
    return union_frames(reports), union_frames(scores).orderBy("model", F.desc("absolute_score"))


def _both_sides(split: DataFrame, fit_and_score: Callable[[tuple[str, ...], str], DataFrame]) -> DataFrame:
    """Predictions of the validation rows by models of the train rows, and of the test rows by models of both."""
    return union_frames(
        fit_many(
            {
                "inner": lambda: fit_and_score(("train",), "validation"),
                "final": lambda: fit_and_score(("train", "validation"), "test"),
            }
        )
    )


def weighted_scores(split: DataFrame, features: list[str], specs: dict[str, Spec], key: str, trees: int = TREES) -> DataFrame:
    """Held-out predictions of one boosted model a spec; the models of a side are fitted in the same passes."""

    def fit_and_score(train: tuple[str, ...], held: str) -> DataFrame:
        models = boost_many(_side(split, *train), features, specs, trees=trees)
        return many_predictions(models, _side(split, held), key)

    return _both_sides(split, fit_and_score)


def resampled_scores(split: DataFrame, features: list[str], specs: dict[str, Spec], key: str, trees: int = TREES) -> DataFrame:
    """The same with new minority rows among the train rows, made between neighbours in scaled features.

    Filling, scaling and new rows come from the train rows of the side alone.
    """

    def fit_and_score(train: tuple[str, ...], held: str) -> DataFrame:
        table = _as_double(split, features)
        prepared = Pipeline(stages=preprocess_stages(_side(split, *train), features)).fit(_side(table, *train))
        vectors = prepared.transform(table).select(key, TARGET, "split", vector_to_array("features").alias("_v"))
        width = len(vectors.select("_v").first()[0])
        names = [f"f{i}" for i in range(width)]
        wide = reliable_checkpoint(vectors.select(key, TARGET, "split", *[F.col("_v")[i].alias(n) for i, n in enumerate(names)]))
        own = _side(wide, *train)
        made = oversample_minority(own, names, TARGET, key)
        rows = reliable_checkpoint(own.select(*names, TARGET).unionByName(made.select(*names, TARGET)))
        return many_predictions(boost_many(rows, names, specs, trees=trees), _side(wide, held), key)

    return _both_sides(split, fit_and_score)


def recall_optimise(
    split: DataFrame, features: list[str], weights: list[float], key: str, trees: int = TREES, resample: bool = True,
) -> dict[str, DataFrame]:
    """Tune class weight and threshold on validation rows, then evaluate once on test rows.

    All class weights are boosted in the same passes. With ``resample`` two more candidates learn from rows
    with an oversampled minority, plain and with the best weight other than 1; they are reported, but never
    chosen. Returns the validation ``grid``, the ``preferred`` threshold of every candidate with its
    validation measures, the ``test`` measures at it, and the ``chosen`` candidate.
    """
    spark = split.sparkSession
    keys = ["model_name", "position", "class_weight"]

    def tagged(scores: DataFrame, names: list[str], values: list[float], first: int) -> DataFrame:
        tags = spark.createDataFrame(
            [(n, first + i, float(w)) for i, (n, w) in enumerate(zip(names, values))], "model_name string, position int, class_weight double"
        )
        return scores.join(F.broadcast(tags), "model_name")  # one row a candidate, written above

    def preferred_of(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
        validation = scores.where("split = 'validation'")
        grid = threshold_grid(validation, keys)
        ranks = ranking_metrics(validation, ["model_name"]).select("model_name", F.col("pr_auc").alias("validation_pr_auc"))
        return grid, select_preferred(grid, ["model_name"]).join(ranks, "model_name")

    names = [f"weight_{str(w).replace('.', '_')}" for w in weights]
    specs = {n: Spec(float(w)) for n, w in zip(names, weights)}
    # Written once: the grids and areas below read the predictions, not the models.
    scores = reliable_checkpoint(tagged(weighted_scores(split, features, specs, key, trees), names, weights, 0))
    grid, preferred = preferred_of(scores)
    pool = reliable_checkpoint(preferred.withColumn("resampled", F.lit(False)))
    chosen = choose_policy(pool, include_resampled=False).drop("resampled")
    if resample:
        heavier = pool.where("class_weight <> 1")
        best = choose_policy(heavier, include_resampled=False).select("model_name").collect()
        weight = float(dict(zip(names, weights))[best[0][0]]) if best else 1.0
        again = {"resampled": Spec(1.0), "resampled_weighted": Spec(weight)}
        more = tagged(resampled_scores(split, features, again, key, trees), list(again), [1.0, weight], len(names))
        scores = reliable_checkpoint(union_frames([scores, more]))
        grid, preferred = preferred_of(scores)
    test = scores.where("split = 'test'")
    test_grid = threshold_grid(test, keys)
    at_choice = test_grid.join(
        preferred.select("model_name", "threshold", "selection_rule", "fallback_used"),
        ["model_name", "threshold"],
    ).join(ranking_metrics(test, ["model_name"]), "model_name")
    return {"grid": grid, "preferred": preferred, "test": at_choice, "chosen": chosen,
            "scores": scores, "test_grid": test_grid}


def reweigh_compare(
    split: DataFrame, features: list[str], key: str, group: str = "SEX",
    trainer: Trainer = train_boosted, thresholds: bool = False,
) -> DataFrame:
    """Scores of the test rows with and without reweighing: ``model_name, group, y_*``.

    With ``thresholds`` a third method, ``group_thresholds``: the baseline's decisions, as scores of 0
    and 1, with the equalised odds fitted on the rows it was trained on.
    """
    groups = split.select(key, group)

    def weighted(df: DataFrame, names: list[str]) -> Scored:
        return trainer(reweigh(df, group), names, weight="weight")

    def baseline() -> DataFrame:
        model, predictions, _ = fit_evaluate(split, features, trainer, "baseline", key)
        if not thresholds:
            return predictions
        train = model.predictions(_side(split, "train", "validation"), key, "baseline")
        return union_frames(
            [predictions, group_thresholds(train.join(groups, key), predictions.join(groups, key), group, key)]
        )

    parts = fit_many(
        {
            "baseline": baseline,
            "reweighing": lambda: fit_evaluate(split, features, weighted, "reweighing", key)[1],
        }
    )
    return union_frames(parts).join(groups, key)


def group_thresholds(train: DataFrame, test: DataFrame, group: str, key: str) -> DataFrame:
    """Test predictions as scores of 0 and 1: the randomised decisions that equalise the train rows' error rates.

    Rows without a group are a group of their own; a group without both classes in train is cut at 0.50.
    """
    own = F.coalesce(F.col(group).cast("string"), F.lit("none"))
    plan = equalised_odds(train.withColumn("_group", own), "_group")
    decided = mixed_decision(test.withColumn("_group", own), plan, "_group", key)
    return decided.withColumns(
        {"y_proba": F.col("flagged").cast("double"), "model_name": F.lit("group_thresholds")}
    ).drop(group, "_group", "flag_probability", "flagged")


def tradeoff_table(scored: DataFrame, group: str = "SEX", threshold: float = 0.50) -> DataFrame:
    """One row per method (``model_name``): ``perf_*`` measures and ``fair_*`` gaps."""
    report = classification_report(scored, threshold, ["model_name"]).drop(
        "f2", "approval_support_rate", "predicted_high_risk_rate"
    )
    counts = counts_at_thresholds(scored, [threshold], ["model_name", group])
    gaps = four_gaps(counts, ["model_name"], group)
    perf = [F.col(c).alias(f"perf_{c}") for c in report.columns if c != "model_name"]
    fair = [F.col(c).alias(f"fair_{c}") for c in gaps.columns if c != "model_name"]
    table = report.join(gaps, "model_name").select("model_name", *perf, *fair)
    return table.withColumnRenamed("model_name", "method").withColumns(
        {"skipped": F.lit(False), "reason": F.lit(None).cast("string")}
    )


def numbered(df: DataFrame, key: str, seed: int = 42) -> tuple[DataFrame, int]:
    """Adds ``_at``, consecutive numbers from 0 on in a random (md5) order of the keys; and the number of rows.

    The order's ranges are counted, so a window only ever sees one range.
    """
    rows = reliable_checkpoint(df.withColumn("_order", hash_order(key, seed=seed)))
    ranged = by_hash_prefix(rows, "_order")
    counts = ranged.groupBy("_range").agg(F.count("*").alias("n"))
    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    starts = counts.select("_range", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_order", key)) - 1
    found = ranged.withColumn("_place", place).join(starts, "_range").withColumn("_at", F.col("_start") + F.col("_place"))
    return found.drop("_order", "_range", "_start", "_place"), rows.count()


def permuted_values(rows: DataFrame, n: int, features: list[str], repeats: int, seed: int = 42) -> DataFrame:
    """``_at, _given``: for each numbered row the values it takes, as an array of (feature, repeat, value).

    In every repeat a feature's values go to the rows along a one-to-one map of the random numbers, a factor
    without common divisor with n and a shift of its own; so they are a permutation of themselves.
    """
    rng = random.Random(seed)
    maps = []
    for feature in features:
        for repeat in range(repeats):
            factor = rng.randrange(1, min(max(n, 2), 1 << 20))
            while math.gcd(factor, max(n, 1)) != 1:
                factor = rng.randrange(1, min(max(n, 2), 1 << 20))
            maps.append((feature, repeat, factor, rng.randrange(max(n, 1))))
    cells = ", ".join(
        f"struct('{f}' as feature, {r} as repeat, cast(`{f}` as double) as value, pmod({a}L * _at + {b}L, {max(n, 1)}L) as _to)" for f, r, a, b in maps
    )
    given = rows.select(F.expr(f"inline(array({cells}))"))
    return given.groupBy(F.col("_to").alias("_at")).agg(F.collect_list(F.struct("feature", "repeat", "value")).alias("_given"))


def permutation_importance(
    split: DataFrame, model: Scored | Boosted, key: str, target: str = TARGET, repeats: int = 3, seed: int = 42
) -> DataFrame:
    """Loss of average precision on all test rows when one feature is permuted: mean and spread over repeats.

    Rows get random numbers once; each feature's values travel to the rows they go to, and a row is scored
    once for every feature and repeat. Nothing is sampled, and no window sees a feature.
    """
    features = model.features
    rows, n = numbered(_side(split, "test").select(key, target, *features), key, seed)
    rows = reliable_checkpoint(rows)
    swaps = rows.join(permuted_values(rows, n, features, repeats, seed), "_at").select(key, target, *features, F.explode("_given").alias("_swap"))
    types = dict(split.dtypes)
    swapped = {f: F.when(F.col("_swap.feature") == f, F.col("_swap.value").cast(types[f])).otherwise(F.col(f)) for f in features}
    scored = model(swaps.select(key, target, F.col("_swap.feature").alias("feature"), F.col("_swap.repeat").alias("repeat"), *[c.alias(f) for f, c in swapped.items()]))
    scored = scored.select("feature", "repeat", F.col(target).alias("y_true"), F.col("probability").alias("y_proba"))
    area = ranking_metrics(scored, ["feature", "repeat"])
    plain = model(rows.select(key, target, *features)).select(F.col(target).alias("y_true"), F.col("probability").alias("y_proba"))
    base = ranking_metrics(plain).select("pr_auc").scalar()
    drops = area.withColumn("_drop", base - F.col("pr_auc"))
    return drops.groupBy("feature").agg(
        F.avg("_drop").alias("permutation_pr_auc_drop"), F.coalesce(F.stddev_pop("_drop"), F.lit(0.0)).alias("drop_spread")
    ).orderBy(F.desc("permutation_pr_auc_drop"))


def at_half(scored: DataFrame) -> DataFrame:
    """Measures at 0.50 and ranking measures of every model, recomputed from its predictions."""
    cut = confusion(scored, 0.50, ["model_name"])
    return cut.join(ranking_metrics(scored, ["model_name"]), "model_name")

