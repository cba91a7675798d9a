"""Fold-wise training with out-of-fold predictions: boosting, perceptrons and neighbours of their own, other learners on MLlib."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import materialise, require_columns, require_numeric
from foldwise.operators.encode_stats import observed_folds
from foldwise.operators.fold_relation import check_relation
from foldwise.operators.metrics import LOWER_IS_BETTER, REGRESSION, calculate_metric, regression_metric
from foldwise.operators.target import TargetTransform
from foldwise.plans.boosting import (
    BINARY_LOSS, CLASSES_LOSS, OBJECTIVES, TRAIN, VALID, WITHOUT_EFFECT, BoostedTrees, best_round, fit_boosting, settings_of,
)
from foldwise.plans.knn import knn_predict
from foldwise.plans.perceptron import LOSSES, MSE, Perceptron, fit_perceptrons, net_settings

VECTOR, LABEL, ROLES = "__vector", "__label", "__roles"

# fixed values: accepted parameter names of forests and their MLlib counterparts
TREE_PARAMS = {
    "n_estimators": "numTrees", "max_depth": "maxDepth", "subsample": "subsamplingRate", "min_samples_leaf": "minInstancesPerNode",
    "min_child_samples": "minInstancesPerNode", "max_bin": "maxBins", "random_state": "seed", "seed": "seed",
}
CLASS_LOSSES = tuple(name for name, loss in LOSSES.items() if loss != MSE)
CLASS_OBJECTIVES = (*OBJECTIVES[BINARY_LOSS], *OBJECTIVES[CLASSES_LOSS])


@dataclass(frozen=True)
class Learner:
    kind: str  # regression or classification
    build: Callable | None
    trees: bool = False
    family: str | None = None  # trained for all folds at once: 'nn', or of boosting whose defaults hold


def _known(estimator, params: Mapping) -> dict:
    """The parameters that the learner has; one without a counterpart is an error."""
    unknown = sorted(k for k in params if not estimator.hasParam(k) and k not in WITHOUT_EFFECT)
    if unknown:
        raise ValueError(f"parameters without a counterpart in {type(estimator).__name__}: {unknown}")
    return {k: v for k, v in params.items() if estimator.hasParam(k)}


def _only(params: Mapping, *names: str) -> Mapping:
    unknown = sorted(set(params) - set(names) - set(WITHOUT_EFFECT) - {"random_state"})
    if unknown:
        raise ValueError(f"unknown learner parameters: {unknown}")
    return params


def _translate(params: Mapping, table: Mapping) -> dict:
    return {table.get(k, k): v for k, v in params.items()}


def _forest(cls):
    def build(params: Mapping, facts: Mapping):
        params = _translate(params, TREE_PARAMS)
        estimator = cls()
        return estimator.setParams(featuresCol=VECTOR, labelCol=LABEL, **_known(estimator, params))
    return build


def _ridge(params: Mapping, facts: Mapping):
    _only(params, "alpha", "fit_intercept")
    # the solver divides the penalty by the spread of the label; undo that to get |y - Xw|^2 + alpha |w|^2
    penalty = float(params.get("alpha", 1.0)) / facts["rows"] * (facts["label_std"] or 1.0)
    return LinearRegression(featuresCol=VECTOR, labelCol=LABEL, regParam=penalty, elasticNetParam=0.0,
                            standardization=False, solver="normal", fitIntercept=params.get("fit_intercept", True))


def _lasso(params: Mapping, facts: Mapping):
    _only(params, "alpha", "max_iter")
    return LinearRegression(featuresCol=VECTOR, labelCol=LABEL, regParam=float(params.get("alpha", 1.0)),
                            elasticNetParam=1.0, standardization=False, maxIter=int(params.get("max_iter", 200)))


def _logreg(params: Mapping, facts: Mapping):
    _only(params, "C", "max_iter")
    return LogisticRegression(featuresCol=VECTOR, labelCol=LABEL, standardization=False,
                              regParam=1.0 / (float(params.get("C", 1.0)) * facts["rows"]),
                              maxIter=int(params.get("max_iter", 100)))


def _perceptron(params: Mapping, facts: Mapping):
    _only(params, "hidden_sizes", "hidden_layers", "epochs", "max_iter")
    hidden = list(params.get("hidden_sizes", params.get("hidden_layers", [32])))
    return MultilayerPerceptronClassifier(
        featuresCol=VECTOR, labelCol=LABEL, layers=[facts["width"], *hidden, facts["classes"]],
        maxIter=int(params.get("epochs", params.get("max_iter", 50))), seed=int(params.get("random_state", 0)))


_CLASS, _REG = "classification", "regression"
MODELS: dict[str, Learner] = {
    **{n: Learner("objective", None, True, family) for n, family in (
        ("lgbm", "lgbm"), ("lightgbm", "lgbm"), ("catboost", "catboost"), ("xgb", "xgb"), ("xgboost", "xgb"))},
    **{n: Learner(_CLASS, _forest(RandomForestClassifier), True) for n in ("rf", "randomforest")},
    "rf_reg": Learner(_REG, _forest(RandomForestRegressor), True),
    **{n: Learner(_CLASS, _logreg) for n in ("logreg", "logisticregression")},
    "ridge": Learner(_REG, _ridge),
    "lasso": Learner(_REG, _lasso),
    "mlp": Learner(_CLASS, _perceptron),
    "nn": Learner("objective", None, family="nn"),
    **{n: Learner(_CLASS, None) for n in ("knn", "kneighbors")},
    "knn_reg": Learner(_REG, None),
}


def learner_of(model_type: str) -> Learner:
    learner = MODELS.get(model_type.lower())
    if learner is None:
        raise ValueError(f"unknown model_type '{model_type}', expected one of {sorted(MODELS)}")
    return learner


def is_classifier(model_type: str, params: Mapping) -> bool:
    learner = learner_of(model_type)
    if learner.kind == "objective":
        given = params.get("objective", params.get("loss_function", params.get("loss_fn")))
        return given in (CLASS_OBJECTIVES if learner.family != "nn" else CLASS_LOSSES)
    return learner.kind == _CLASS


def assemble(
    df: DataFrame, features: Sequence[str], keep: Sequence[str], trees: bool = False,
    indexers: Sequence = (),
) -> DataFrame:
    """Feature vector plus the kept columns. Trees accept missing values, other learners do not."""
    inputs = list(features)
    for indexer in indexers:
        df = indexer.transform(df)
        inputs[inputs.index(indexer.getInputCol())] = indexer.getOutputCol()
    single = len(inputs) == 1 and isinstance(df.schema[inputs[0]].dataType, T.ArrayType)
    if single:
        from pyspark.ml.functions import array_to_vector

        return df.select(*keep, array_to_vector(F.col(inputs[0]).cast("array<double>")).alias(VECTOR))
    vectors = VectorAssembler(inputCols=inputs, outputCol=VECTOR, handleInvalid="keep" if trees else "error")
    return vectors.transform(df).select(*keep, VECTOR)


def _index_categories(df: DataFrame, cat_features: Sequence[str]) -> list:
    return [StringIndexer(inputCol=c, outputCol=f"__cat_{c}", handleInvalid="keep").fit(df) for c in cat_features]


def _prediction(model, scored: DataFrame, classifier: bool, classes: int) -> Column:
    if not classifier:
        return F.col("prediction")
    chances = vector_to_array("probability")
    return chances[1] if classes == 2 else chances


@dataclass(frozen=True)
class FittedFold:
    """A fitted model and how to turn its output into predictions."""

    model: object
    features: list[str]
    trees: bool
    indexers: tuple
    classifier: bool
    classes: int
    points: DataFrame | None = None   # training rows, for nearest neighbours
    k: int = 5

    def slot_importances(self) -> list[tuple[str, float]]:
        if isinstance(self.model, BoostedTrees):
            return self.model.importances()
        values = self.model.featureImportances.toArray()
        if len(values) == len(self.features):
            return list(zip(self.features, values))
        if len(self.features) > 1:
            raise ValueError("importances of several vector features cannot be told apart")
        return [(f"{self.features[0]}[{i}]", v) for i, v in enumerate(values)]

    def predict(self, df: DataFrame, row_id: str, keep: Sequence[str] = (), out: str = "prediction") -> DataFrame:
        require_columns(df, [row_id, *self.features])
        kept = list(dict.fromkeys([row_id, *keep]))
        if self.points is not None:
            found = knn_predict(self.points, df, row_id, self.features, LABEL, self.k,
                                self.classes if self.classifier else None)
            return df.select(*kept).join(found.withColumnRenamed("prediction", out), row_id, "left")
        if isinstance(self.model, (BoostedTrees, Perceptron)):
            return df.select(*kept, self.model.prediction(df).alias(out))
        vectors = assemble(df, self.features, kept, self.trees, self.indexers)
        scored = self.model.transform(vectors)
        return scored.select(*kept, _prediction(self.model, scored, self.classifier, self.classes).alias(out))


def _boosted(
    df: DataFrame, target: str, features: Sequence[str], model_type: str, row_id: str, roles: Column, models: int,
    params: Mapping, fit_params: Mapping, cat_features: Sequence[str] | None,
) -> list[FittedFold]:
    """Boosted models or networks of all folds; ``roles`` tells what a row is to each of them."""
    patience = int(fit_params.get("early_stopping_rounds") or 0)
    if learner_of(model_type).family == "nn":
        nets = fit_perceptrons(df, row_id, target, features, roles, models, net_settings(params, fit_params), patience)
        return [FittedFold(m, list(features), False, (), m.classification, m.classes) for m in nets]
    rate = fit_params.get("learning_rates")
    if rate is not None and not callable(rate):
        given = list(rate)
        rate = lambda i: given[min(i, len(given) - 1)]
    settings = settings_of(learner_of(model_type).family, params, fit_params.get("num_boost_round"))
    fitted = fit_boosting(
        df, row_id, target, features, roles, models, settings, patience,
        [f for f in cat_features or () if f in features], rate)
    return [FittedFold(m, list(features), True, (), settings.classification, m.classes) for m in fitted]


def fit_model(
    train: DataFrame, target: str, features: Sequence[str], model_type: str, row_id: str,
    model_params: Mapping | None = None, valid: DataFrame | None = None,
    cat_features: Sequence[str] | None = None, fit_params: Mapping | None = None,
) -> FittedFold:
    """Fit one learner.

    For boosting, ``fit_params`` may hold ``num_boost_round`` (it wins over a
    number among the parameters), ``learning_rates`` (a list or a function of the round) and
    ``early_stopping_rounds``: training ends when the loss of ``valid`` has not fallen for
    that many rounds, and the rounds up to the best one are kept.
    """
    params, learner, fit_params = dict(model_params or {}), learner_of(model_type), dict(fit_params or {})
    require_columns(train, [target, *features], "train")
    require_numeric(train, [target])
    features = list(features)
    if learner.family:
        columns = list(dict.fromkeys([row_id, target, *features]))
        rows = train.select(*columns, F.array(F.lit(TRAIN)).alias("__role"))
        if valid is not None and fit_params.get("early_stopping_rounds"):
            rows = rows.unionByName(valid.select(*columns, F.array(F.lit(VALID)).alias("__role")))
        return _boosted(rows, target, features, model_type, row_id, F.col("__role"), 1, params, fit_params, cat_features)[0]
    classifier = is_classifier(model_type, params)
    facts = train.agg(F.count(F.lit(1)).alias("rows"), F.stddev_pop(F.col(target).cast("double")).alias("label_std"),
                      F.max(target).alias("top")).first().asDict()
    if not facts["rows"]:
        raise ValueError("no training rows")
    classes = int(facts["top"]) + 1 if classifier else 0
    facts.update(classes=max(classes, 2) if classifier else 0, width=len(features))
    if learner.build is None:
        k = int(params.get("n_neighbors", params.get("k", 5)))
        points = train.withColumn(LABEL, F.col(target).cast("double"))
        return FittedFold(None, features, False, (), classifier, facts["classes"], points, k)
    indexers = tuple(_index_categories(train, cat_features)) if learner.trees and cat_features else ()
    if indexers:
        widest = max(len(i.labels) for i in indexers) + 1
        params["maxBins"] = max(int(params.get("maxBins", 32)), widest)
    label = F.col(target).cast("double").alias(LABEL)
    vectors = assemble(train.select("*", label), features, [LABEL], learner.trees, indexers)
    if facts["width"] == 1 and isinstance(train.schema[features[0]].dataType, T.ArrayType):
        facts["width"] = len(vectors.select(VECTOR).first()[0])
    return FittedFold(learner.build(params, facts).fit(vectors), features, learner.trees, indexers, classifier, facts["classes"])


@dataclass(frozen=True)
class FoldResult:
    model: FittedFold
    valid: DataFrame
    test: DataFrame | None


def train_single_fold(
    train: DataFrame, valid: DataFrame, test: DataFrame | None, target: str, features: Sequence[str],
    model_type: str, row_id: str, model_params: Mapping | None = None, fit_params: Mapping | None = None,
    cat_features: Sequence[str] | None = None,
) -> FoldResult:
    """Fit on ``train``; predictions of ``valid`` and ``test`` keep their row ids."""
    require_columns(train, [target, *features], "train")
    require_columns(valid, [target, *features], "valid")
    if test is not None:
        require_columns(test, features, "test")
    model = fit_model(train, target, features, model_type, row_id, model_params, valid, cat_features, fit_params)
    return FoldResult(model, model.predict(valid, row_id), None if test is None else model.predict(test, row_id))


@dataclass(frozen=True)
class CvResult:
    """Out-of-fold rows (id, fold, target, prediction), averaged test rows and the models.

    ``pairs`` has a row for each fold that a row measures; ``oof`` one per row, of the last such fold.
    """

    oof: DataFrame
    test: DataFrame | None
    models: list[FittedFold]
    row_id: str
    target: str
    pairs: DataFrame | None = None

    def pooled_score(self, metric: str, **options) -> float:
        return calculate_metric(self.oof, self.target, "prediction", metric, skip_missing=True, **options)

    def fold_scores(self, metric: str, **options) -> DataFrame:
        """(fold, score) rows."""
        rows = (self.oof if self.pairs is None else self.pairs).filter(F.col("fold").isNotNull())
        if metric.lower() in REGRESSION:
            score = regression_metric(metric.lower(), F.col(self.target).cast("double"), F.col("prediction"))
            return rows.groupBy("fold").agg(score.alias("score"))
        scores = [(k, calculate_metric(rows.filter(F.col("fold") == k), self.target, "prediction", metric, **options))
                  for k in observed_folds(rows, "fold")]
        return rows.sparkSession.createDataFrame(scores, "fold int, score double")

    def importances(self) -> DataFrame:
        """(fold, feature, importance) rows of tree models; a vector feature has a row per slot, ``name[i]``."""
        rows = [(i, name, float(v)) for i, m in enumerate(self.models) for name, v in m.slot_importances()]
        return self.oof.sparkSession.createDataFrame(rows, "fold int, feature string, importance double")


def _mean_over_folds(columns: list[Column], array: bool) -> Column:
    if not array:
        return reduce(lambda a, b: a + b, columns) / F.lit(float(len(columns)))
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), columns)
    return F.transform(total, lambda x: x / F.lit(float(len(columns))))


def _with_roles(df: DataFrame, row_id: str, fold: str, relation: DataFrame | None) -> tuple[DataFrame, list[int]]:
    """The rows with their role in each fold, and the folds."""
    if relation is None:
        folds = observed_folds(df, fold)
        place = F.col(fold)
        roles = F.transform(F.lit([int(k) for k in folds]).cast("array<int>"), lambda k: F.when(place == k, VALID).when(
            place.isNotNull(), TRAIN).otherwise(0))
        out = df.withColumn(ROLES, roles)
    else:
        folds = check_relation(relation, row_id)
        own = relation.distinct().groupBy(F.col(row_id).alias("__id")).agg(F.map_from_entries(F.collect_list(F.struct(
            "fold", F.when(F.col("role") == "valid", VALID).otherwise(TRAIN)))).alias("__own"))
        roles = F.transform(F.lit(folds).cast("array<int>"), lambda k: F.coalesce(F.element_at("__own", k), F.lit(0)))
        out = df.join(own, F.col(row_id) == F.col("__id"), "left").withColumn(ROLES, F.coalesce(roles, F.lit([]).cast("array<int>"))).drop(
            "__id", "__own")
    if not folds:
        raise ValueError(f"column '{fold}' assigns no folds" if relation is None else "the relation holds no folds")
    return out, folds


def train_and_cv(
    df: DataFrame, target: str, features: Sequence[str], model_type: str, row_id: str, fold: str = "fold",
    test: DataFrame | None = None, model_params: Mapping | None = None, fit_params: Mapping | None = None,
    cat_features: Sequence[str] | None = None, target_transform: TargetTransform | None = None,
    normalize_by: str | None = None, average_on: str = "original", parallelism: int = 2, relation: DataFrame | None = None,
) -> CvResult:
    """Train one model per fold and predict each row with the model that did not see it.

    Folds are the column ``fold`` or, for any pairs of training and validation rows, a ``relation`` of
    rows (row_id, fold, role) as ``operators.fold_relation`` makes them; of several predictions of a row
    that of the last fold counts.

    ``normalize_by`` divides the target by a column and ``target_transform`` is
    applied after that; predictions are returned on the original scale.
    ``average_on`` says on which scale the test predictions of the folds are
    averaged. Rows without a fold are predicted as NaN. Predictions are written
    once, so scoring, blending and saving them does not run the models again.
    """
    if average_on not in ("original", "transformed"):
        raise ValueError("average_on must be 'original' or 'transformed'")
    require_columns(df, [row_id, target, *features, *([fold] if relation is None else [])])
    label, extra = "__y", [normalize_by] if normalize_by else []
    require_columns(df, extra)
    y = F.col(target).cast("double")
    if normalize_by:
        y = F.try_divide(y, F.nullif(F.col(normalize_by).cast("double"), F.lit(0.0)))
    if target_transform is not None:
        y = target_transform.forward(y)
    changed = bool(normalize_by or target_transform is not None)
    kept = list(dict.fromkeys([row_id, target, *features, *extra]))
    rows, folds = _with_roles(df, row_id, fold, relation)
    rows = rows.select(*kept, (y if changed else F.col(target)).alias(label), ROLES)
    # every fold reads these rows several times
    rows = materialise(rows)

    def restore(p: Column) -> Column:
        if target_transform is not None:
            p = target_transform.inverse(p)
        return p * F.col(normalize_by).cast("double") if normalize_by else p

    def part_of(i: int, role: int) -> DataFrame:
        return rows.filter(F.get(ROLES, F.lit(i)) == role)

    def run(i: int) -> FittedFold:
        return fit_model(part_of(i, TRAIN), label, features, model_type, row_id, model_params, part_of(i, VALID), cat_features, fit_params)

    if learner_of(model_type).family:
        # the trees of all folds grow in the same passes
        models = _boosted(rows, label, features, model_type, row_id, F.col(ROLES), len(folds), dict(model_params or {}),
                          dict(fit_params or {}), cat_features)
    else:
        with ThreadPool(max(1, min(parallelism, len(folds)))) as pool:
            models = pool.map(inheritable_thread_target(df.sparkSession)(run), range(len(folds)))
    pairs = None
    for i, (k, model) in enumerate(zip(folds, models)):
        part = model.predict(part_of(i, VALID), row_id, [target, *extra])
        part = part.select(row_id, F.lit(k).cast("int").alias("fold"), target, restore(F.col("prediction")).alias("prediction"))
        pairs = part if pairs is None else pairs.unionByName(part)
    array = isinstance(pairs.schema["prediction"].dataType, T.ArrayType)
    unseen = F.lit(None).cast("array<double>") if array else F.lit(float("nan"))
    unseen = rows.filter(~F.exists(ROLES, lambda r: r == VALID)).select(
        row_id, F.lit(None).cast("int").alias("fold"), target, unseen.alias("prediction"))
    if relation is None:
        oof, pairs = materialise(pairs.unionByName(unseen)), None
    else:
        pairs = materialise(pairs)
        last = pairs.groupBy(row_id).agg(F.max_by(F.struct("fold", target, "prediction"), "fold").alias("last")).select(row_id, "last.*")
        oof = materialise(last.unionByName(unseen))

    averaged = None
    if test is not None:
        require_columns(test, [row_id, *features, *extra], "test")
        scored, columns = test, []
        carried = list(dict.fromkeys([row_id, *features, *extra]))
        for i, model in enumerate(models):
            # one projection per model over the same test rows
            scored = model.predict(scored, row_id, [*carried, *columns], f"__p{i}")
            columns.append(f"__p{i}")
        values = [F.col(c) for c in columns]
        if average_on == "original":
            value = _mean_over_folds([restore(c) for c in values], array)
        else:
            value = restore(_mean_over_folds(values, array))
        averaged = materialise(scored.select(row_id, value.alias("prediction")))
    return CvResult(oof, averaged, models, row_id, target, pairs)


def compare_models(
    df: DataFrame, target: str, features: Sequence[str], models: Mapping[str, tuple[str, Mapping]], row_id: str,
    metric: str = "rmse", **options,
) -> tuple[dict[str, CvResult], DataFrame, str]:
    """Train every model over the same folds; the best has the best mean fold score.

    ``models`` maps a name to (model_type, parameters). Returns the results,
    the (model, fold, score) table and the best name.
    """
    if not models:
        raise ValueError("no models given")
    results, scores = {}, None
    for name, (model_type, params) in models.items():
        results[name] = train_and_cv(df, target, features, model_type, row_id, model_params=params, **options)
        part = results[name].fold_scores(metric).select(F.lit(name).alias("model"), "fold", "score")
        scores = part if scores is None else scores.unionByName(part)
    # one row per model and fold
    spark = df.sparkSession
    scores = spark.createDataFrame(scores.collect(), "model string, fold int, score double")
    means = {r["model"]: r["m"] for r in scores.groupBy("model").agg(F.avg("score").alias("m")).collect()}
    choose = min if metric.lower() in LOWER_IS_BETTER else max
    return results, scores, choose(means, key=means.get)
