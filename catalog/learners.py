"""Cross-validated training, neighbours, selection, stacking and the whole workflow."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import query, rnd, rounded, table
from foldwise import operators as op
from foldwise import plans
from foldwise.frame import materialise, work_folder
from foldwise.sources import load_model, save_model

BASKET = """
select l_orderkey as row_id, cast(l_orderkey % 3 as integer) as fold, count(*)::double as lines, sum(l_quantity) as quantity,
       max(l_discount) as discount, round(sum(l_extendedprice), 2) as price,
       (max(l_returnflag) = 'R')::int as returned, cast(max(l_linenumber) % 3 as integer) as kind,
       (count(*) >= 4)::int as many, (sum(l_quantity) >= 100)::int as bulk, least(floor(sum(l_quantity) / 80), 2)::int as load
from lineitem group by l_orderkey"""
FEATURES = ["lines", "quantity", "discount"]


def basket(spark, folder):
    """One row per order with a price, two kinds of classes and a fold."""
    return table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("row_id")).agg(
        F.count(F.lit(1)).cast("double").alias("lines"), F.sum("l_quantity").alias("quantity"),
        F.max("l_discount").alias("discount"), F.round(F.sum("l_extendedprice"), 2).alias("price"),
        (F.max("l_returnflag") == "R").cast("int").alias("returned"),
        (F.max("l_linenumber") % 3).cast("int").alias("kind"),
        (F.count(F.lit(1)) >= 4).cast("int").alias("many"),
        (F.sum("l_quantity") >= 100).cast("int").alias("bulk"),
        F.least(F.floor(F.sum("l_quantity") / 80), F.lit(2)).cast("int").alias("load"),
    ).withColumn("fold", (F.col("row_id") % 3).cast("int"))


def _oof(result, digits=3):
    return result.oof.select("row_id", "fold", rnd("prediction", digits).alias("prediction"))


FIT = """fit as (select f.fold, regr_slope({y}, quantity) as s, regr_intercept({y}, quantity) as i
from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold)"""


@query("cv_linear", f"""
with t as ({BASKET}), {FIT.format(y='price')}
select row_id, t.fold, round(i + s * quantity, 3) + 0.0 as prediction from t join fit on fit.fold = t.fold""")
def cv_linear(spark, folder):
    return _oof(plans.train_and_cv(basket(spark, folder), "price", ["quantity"], "ridge", "row_id",
                                   model_params={"alpha": 0.0}))


@query("cv_linear_test", f"""
with a as ({BASKET}), t as (select * from a where row_id % 6 <> 5), {FIT.format(y='price')}
select row_id, round(avg(i + s * quantity), 3) + 0.0 as prediction from a, fit where row_id % 6 = 5 group by row_id""")
def cv_linear_test(spark, folder):
    rows = basket(spark, folder)
    train, test = rows.filter("row_id % 6 <> 5"), rows.filter("row_id % 6 = 5").drop("fold", "price")
    result = plans.train_and_cv(train, "price", ["quantity"], "ridge", "row_id", test=test, model_params={"alpha": 0.0})
    return rounded(result.test, {"prediction": 3})


@query("cv_linear_log", f"""
with t as ({BASKET}), {FIT.format(y='ln(1 + price / lines)')}
select row_id, t.fold, round((exp(i + s * quantity) - 1) * lines, 3) + 0.0 as prediction from t join fit on fit.fold = t.fold""")
def cv_linear_log(spark, folder):
    rows = basket(spark, folder)
    log = op.fit_target_transform(rows, "price", "log1p")
    return _oof(plans.train_and_cv(rows, "price", ["quantity"], "ridge", "row_id", model_params={"alpha": 0.0},
                                   target_transform=log, normalize_by="lines"))


@query("cv_log_average", f"""
with a as ({BASKET}), t as (select * from a where row_id % 6 <> 5), {FIT.format(y='ln(1 + price)')}
select row_id, round(exp(avg(i + s * quantity)) - 1, 3) + 0.0 as prediction from a, fit where row_id % 6 = 5 group by row_id""")
def cv_log_average(spark, folder):
    rows = basket(spark, folder)
    train, test = rows.filter("row_id % 6 <> 5"), rows.filter("row_id % 6 = 5").drop("fold", "price")
    log = op.fit_target_transform(train, "price", "log1p")
    result = plans.train_and_cv(train, "price", ["quantity"], "ridge", "row_id", test=test, target_transform=log,
                                model_params={"alpha": 0.0}, average_on="transformed")
    return rounded(result.test, {"prediction": 3})


def _relation_fit(relation):
    return f"""t as ({BASKET}), r as ({relation}),
fit as (select r.fold, regr_slope(price, quantity) as s, regr_intercept(price, quantity) as i
from r join t using (row_id) where r.role = 'train' group by r.fold),
v as (select row_id, max(fold) as fold from r where role = 'valid' group by row_id)
select t.row_id, v.fold, case when v.fold is null then 'nan'::double else round(fit.i + fit.s * quantity, 3) + 0.0 end as prediction
from t left join v using (row_id) left join fit on fit.fold = v.fold"""


@query("cv_saved", f"""
with a as ({BASKET}), t as (select * from a where row_id % 6 <> 5), {FIT.format(y='price')}
select row_id, t.fold, round(i + s * quantity, 3) + 0.0 as prediction from a t join fit on fit.fold = (t.row_id % 3)""")
def cv_saved(spark, folder):
    """Models of a cross-validation, written and read again, predict rows that they did not see in training."""
    rows, path = basket(spark, folder), f"{work_folder(spark)}/model-{uuid.uuid4().hex}"
    result = plans.train_and_cv(rows.filter("row_id % 6 <> 5"), "price", ["quantity"], "ridge", "row_id", model_params={"alpha": 0.0})
    save_model(result, path, spark)
    models = load_model(spark, path).models
    out = None
    for k, model in enumerate(models):
        part = model.predict(rows.filter(F.col("fold") == k), "row_id", ["fold"])
        out = part if out is None else out.unionByName(part)
    return rounded(out.select("row_id", "fold", "prediction"), {"prediction": 3})


@query("cv_relation_overlap", f"""with {_relation_fit("select row_id, f.fold, case when row_id % 5 in (f.fold, f.fold + 1) then 'valid' else 'train' end as role "
    "from t, (select unnest([0, 1, 2])::int as fold) f")}""")
def cv_relation_overlap(spark, folder):
    """Overlapping folds; the last one that measures a row predicts it."""
    rows = basket(spark, folder).drop("fold")
    place = F.col("row_id") % 5
    relation = op.folds_of_conditions(rows, "row_id", [(F.lit(True), place.isin(i, i + 1)) for i in range(3)])
    return _oof(plans.train_and_cv(rows, "price", ["quantity"], "ridge", "row_id", model_params={"alpha": 0.0}, relation=relation))


@query("cv_relation_expanding", f"""with {_relation_fit("select row_id, f.fold, case when block = f.fold + 1 then 'valid' else 'train' end as role "
    "from (select row_id, ntile(5) over (order by row_id) - 1 as block from t), (select unnest([0, 1, 2, 3])::int as fold) f where block <= f.fold + 1")}""")
def cv_relation_expanding(spark, folder):
    rows = basket(spark, folder).drop("fold")
    relation = op.expanding_folds(rows, "row_id", 4)
    return _oof(plans.train_and_cv(rows, "price", ["quantity"], "ridge", "row_id", model_params={"alpha": 0.0}, relation=relation))


def _three(alpha):
    """Ridge coefficients of three columns by determinants, from centred sums per fold."""
    rows = [[f"(xx + {alpha})", "xz", "xd"], ["xz", f"(zz + {alpha})", "zd"], ["xd", "zd", f"(dd + {alpha})"]]
    right = ["xy", "zy", "dy"]

    def det(m):
        return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
                f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")

    swapped = [[[right[i] if j == k else rows[i][j] for j in range(3)] for i in range(3)] for k in range(3)]
    return [f"{det(m)} / {det(rows)}" for m in swapped]


W1, W2, W3 = _three(5.0)


@query("cv_ridge", f"""
with t as ({BASKET}),
c as (select f.fold, avg(price) as my, avg(quantity) as mx, avg(lines) as mz, avg(discount) as md,
             var_pop(quantity) * count(*) as xx, var_pop(lines) * count(*) as zz, var_pop(discount) * count(*) as dd,
             covar_pop(quantity, lines) * count(*) as xz, covar_pop(quantity, discount) * count(*) as xd,
             covar_pop(lines, discount) * count(*) as zd, covar_pop(price, quantity) * count(*) as xy,
             covar_pop(price, lines) * count(*) as zy, covar_pop(price, discount) * count(*) as dy
      from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold),
w as (select fold, my, mx, mz, md, {W1} as w1, {W2} as w2, {W3} as w3 from c)
select row_id, t.fold, round(my + w1 * (quantity - mx) + w2 * (lines - mz) + w3 * (discount - md), 3) + 0.0 as prediction
from t join w on w.fold = t.fold""")
def cv_ridge(spark, folder):
    return _oof(plans.train_and_cv(basket(spark, folder), "price", ["quantity", "lines", "discount"], "ridge", "row_id",
                                   model_params={"alpha": 5.0}))


@query("cv_lasso", f"""
with t as ({BASKET}),
c as (select f.fold, avg(price) as my, avg(quantity) as mx, covar_pop(price, quantity) as xy, var_pop(quantity) as xx
      from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold)
select row_id, t.fold, round(my + greatest(xy - 20000, 0) / xx * (quantity - mx), 1) + 0.0 as prediction from t join c on c.fold = t.fold""")
def cv_lasso(spark, folder):
    return _oof(plans.train_and_cv(basket(spark, folder), "price", ["quantity"], "lasso", "row_id",
                                   model_params={"alpha": 20000.0}), 1)


SHARES = """s as (select f.fold, many, avg({y}) as p from (select distinct fold from t) f join t on t.fold <> f.fold
group by f.fold, many)"""


@query("cv_gbt", f"""
with t as ({BASKET}), {SHARES.format(y='price')}
select row_id, t.fold, round(p, 3) + 0.0 as prediction from t join s on s.fold = t.fold and s.many = t.many""")
def cv_gbt(spark, folder):
    """One round of depth one on a column of two values: the mean of the other folds' rows with the same value."""
    return _oof(plans.train_and_cv(basket(spark, folder), "price", ["many"], "lgbm", "row_id",
                                   model_params={"n_estimators": 9, "max_depth": 1, "learning_rate": 1.0, "random_state": 1},
                                   fit_params={"num_boost_round": 1}))


@query("single_fold", f"""
with t as ({BASKET}), s as (select many, avg(price) as p from t where fold <> 0 group by many)
select row_id, round(p, 3) + 0.0 as prediction from t join s using (many) where fold = 0""")
def single_fold(spark, folder):
    """Boosting with patience on a column that one round exhausts keeps the predictions of one round."""
    rows = basket(spark, folder)
    result = plans.train_single_fold(
        rows.filter("fold <> 0"), rows.filter("fold = 0"), None, "price", ["many"], "xgb", "row_id",
        {"max_depth": 1, "learning_rate": 1.0, "reg_lambda": 0.0, "random_state": 1}, {"num_boost_round": 4, "early_stopping_rounds": 2})
    return rounded(result.valid, {"prediction": 3})


@query("boost_penalised", f"""
with t as ({BASKET}),
b as (select f.fold, avg(price) as base from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold),
leaf as (
  select b.fold, many, bulk, any_value(base) as base, sum(base - price) as g, count(*) as n
  from b join t on t.fold <> b.fold group by b.fold, many, bulk)
select row_id, t.fold, round(base - 0.5 * sign(g) * greatest(abs(g) - 5000, 0) / (n + 20), 3) + 0.0 as prediction
from t join leaf on leaf.fold = t.fold and leaf.many = t.many and leaf.bulk = t.bulk""")
def boost_penalised(spark, folder):
    """One tree over two columns of two values: its leaves are their four combinations, with both penalties."""
    return _oof(plans.train_and_cv(basket(spark, folder), "price", ["many", "bulk"], "xgb", "row_id", model_params={
        "objective": "reg:squarederror", "tree_method": "hist", "max_depth": 2, "learning_rate": 0.5, "reg_alpha": 5000, "reg_lambda": 20,
        "min_child_weight": 1, "n_estimators": 1}))


@query("boost_classes", """
with t as (
  select l_orderkey * 10 + l_linenumber as row_id, cast(l_orderkey % 3 as integer) as fold, (l_linestatus = 'O')::int as open,
         case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as flag from lineitem),
b as (select f.fold, c.flag, avg((t.flag = c.flag)::int) as p from (select distinct fold from t) f join t on t.fold <> f.fold,
      (select unnest([0, 1, 2]) as flag) c group by f.fold, c.flag),
leaf as (
  select b.fold, b.flag, open, any_value(p) as p, sum(p - (t.flag = b.flag)::int) as g, sum(greatest(2 * p * (1 - p), 1e-16)) as h
  from b join t on t.fold <> b.fold group by b.fold, b.flag, open),
s as (select *, ln(p) - 0.3 * g / (h + 1) as score from leaf),
e as (select fold, open, flag, exp(score) / sum(exp(score)) over (partition by fold, open) as chance from s),
w as (select fold, open, max(case when flag = 0 then chance end) as p0, max(case when flag = 1 then chance end) as p1,
             max(case when flag = 2 then chance end) as p2 from e group by fold, open)
select row_id, t.fold, round(p0, 6) as p0, round(p1, 6) as p1, round(p2, 6) as p2 from t join w on w.fold = t.fold and w.open = t.open""")
def boost_classes(spark, folder):
    """One round for three classes from one histogram pass, on a column of two values."""
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), (F.col("l_orderkey") % 3).cast("int").alias("fold"),
        (F.col("l_linestatus") == "O").cast("int").alias("open"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("flag"))
    result = plans.train_and_cv(lines, "flag", ["open"], "xgb", "row_id", model_params={
        "objective": "multi:softprob", "num_class": 3, "max_depth": 1, "learning_rate": 0.3, "reg_lambda": 1, "min_child_weight": 0, "n_estimators": 1})
    return result.oof.select("row_id", "fold", *[rnd(F.col("prediction")[i]).alias(f"p{i}") for i in range(3)])


@query("boost_flagship", f"""
with t as ({BASKET})
select fold, count(*) as n, true as every_row_scored, true as beats_the_mean, true as stopped_by_patience from t group by fold""")
def boost_flagship(spark, folder):
    """The settings of a long run: penalties, drawn rows and columns, a falling rate, rounds until patience ends."""
    rows = basket(spark, folder)
    result = plans.train_and_cv(rows, "price", FEATURES, "xgb", "row_id", model_params={
        "objective": "reg:squarederror", "eval_metric": "rmse", "seed": 42, "max_depth": 19, "min_child_weight": 20, "reg_alpha": 5, "reg_lambda": 1,
        "subsample": 0.85, "colsample_bytree": 0.67, "colsample_bynode": 0.67, "tree_method": "hist"},
        fit_params={"num_boost_round": 1_000_000, "early_stopping_rounds": 30, "learning_rates": lambda i: 0.05 if i < 115 else 0.01})
    stops = {k: m.model.rounds_trained == m.model.best_round + 30 for k, m in enumerate(result.models)}
    scored = result.oof.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.every(F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("every_row_scored"),
        (F.avg((F.col("price") - F.col("prediction")) ** 2) < F.var_pop("price")).alias("beats_the_mean"))
    stopped = F.create_map(*[x for k, v in stops.items() for x in (F.lit(k), F.lit(v))])
    return scored.withColumn("stopped_by_patience", stopped[F.col("fold")])


FOREST = {"n_estimators": 1, "max_depth": 1, "bootstrap": False, "random_state": 1}


@query("cv_rf", f"""
with t as ({BASKET}), {SHARES.format(y='bulk')}
select row_id, t.fold, round(p, 6) + 0.0 as prediction from t join s on s.fold = t.fold and s.many = t.many""")
def cv_rf(spark, folder):
    return _oof(plans.train_and_cv(basket(spark, folder), "bulk", ["many"], "rf", "row_id", model_params=FOREST), 6)


@query("cv_rf_classes", f"""
with t as ({BASKET}),
s as (select f.fold, many, avg((load = 0)::int) as p0, avg((load = 1)::int) as p1, avg((load = 2)::int) as p2
      from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold, many)
select row_id, t.fold, round(p0, 6) + 0.0 as p0, round(p1, 6) + 0.0 as p1, round(p2, 6) + 0.0 as p2
from t join s on s.fold = t.fold and s.many = t.many""")
def cv_rf_classes(spark, folder):
    result = plans.train_and_cv(basket(spark, folder), "load", ["many"], "rf", "row_id", model_params=FOREST)
    return result.oof.select("row_id", "fold", *[rnd(F.col("prediction")[i], 6).alias(f"p{i}") for i in range(3)])


@query("cv_logreg", f"""
with t as ({BASKET}), {SHARES.format(y='returned')}
select row_id, t.fold, round(p, 2) + 0.0 as prediction from t join s on s.fold = t.fold and s.many = t.many""")
def cv_logreg(spark, folder):
    """With one column of two values and hardly a penalty the probabilities are the shares of the class."""
    return _oof(plans.train_and_cv(basket(spark, folder), "returned", ["many"], "logreg", "row_id",
                                   model_params={"C": 1e9, "max_iter": 200}), 2)


@query("cv_mlp", """
with t as (select vec_id, (vec_id % 3)::int as fold, label from embeddings),
c as (select f.fold, max(label) + 1 as classes from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold)
select vec_id, t.fold, cast(classes as integer) as classes, 1.0::double as total, true as in_range from t join c on c.fold = t.fold""")
def cv_mlp(spark, folder):
    vectors = table(spark, folder, "embeddings").withColumn("fold", (F.col("vec_id") % 3).cast("int"))
    result = plans.train_and_cv(vectors, "label", ["embedding"], "mlp", "vec_id",
                                model_params={"hidden_sizes": [8], "epochs": 20, "random_state": 1})
    total = F.aggregate("prediction", F.lit(0.0), lambda s, p: s + p)
    return result.oof.select("vec_id", "fold", F.size("prediction").alias("classes"), rnd(total).alias("total"),
                             F.forall("prediction", lambda p: (p >= 0) & (p <= 1)).alias("in_range"))


@query("cv_knn", """
with t as (select vec_id, (vec_id % 3)::int as fold, embedding::double[] as v, label from embeddings),
d as (select q.vec_id, q.fold, p.label, row_number() over (partition by q.vec_id order by list_distance(q.v, p.v), p.vec_id) as r
      from t q join t p on p.fold <> q.fold)
select vec_id, fold, round(avg(label), 6) as prediction from d where r <= 5 group by vec_id, fold""")
def cv_knn(spark, folder):
    vectors = table(spark, folder, "embeddings").withColumn("fold", (F.col("vec_id") % 3).cast("int"))
    result = plans.train_and_cv(vectors, "label", ["embedding"], "knn_reg", "vec_id", model_params={"n_neighbors": 5})
    return result.oof.select("vec_id", "fold", rnd("prediction").alias("prediction"))


@query("knn", """
with t as (select vec_id, embedding::double[] as v from embeddings),
d as (select q.vec_id as query_id, p.vec_id as point_id, list_distance(q.v, p.v) as distance from t q join t p on p.vec_id <> q.vec_id)
select query_id, cast(row_number() over (partition by query_id order by distance, point_id) as integer) as rank, point_id,
       round(distance, 6) as distance from d qualify rank <= 3""")
def knn(spark, folder):
    vectors = table(spark, folder, "embeddings")
    found = plans.nearest_neighbours(vectors, vectors, "vec_id", ["embedding"], 3, exclude_self=True)
    return rounded(found.select("query_id", "rank", "point_id", "distance"), {"distance": 6})


@query("fold_score_table", f"""
with t as ({BASKET}), {FIT.format(y='price')}
select t.fold, round(sqrt(avg(power(price - (i + s * quantity), 2))), 3) as score from t join fit on fit.fold = t.fold group by t.fold""")
def fold_score_table(spark, folder):
    result = plans.train_and_cv(basket(spark, folder), "price", ["quantity"], "ridge", "row_id", model_params={"alpha": 0.0})
    return rounded(result.fold_scores("rmse"), {"score": 3})


@query("compare_models", f"""
with t as ({BASKET}),
c as (select f.fold, avg(price) as my, avg(quantity) as mx, covar_pop(price, quantity) * count(*) as xy, var_pop(quantity) * count(*) as xx
      from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold),
s as (select a.model, t.fold, sqrt(avg(power(price - my - xy / (xx + a.alpha) * (quantity - mx), 2))) as score
      from t join c on c.fold = t.fold, (values ('plain', 0.0), ('mild', 100.0), ('strong', 1e7)) a(model, alpha) group by all),
m as (select model, avg(score) as mean, stddev_pop(score) as std from s group by model)
select model, round(mean, 3) as mean, round(std, 3) as std, mean = (select min(mean) from m) as is_best,
       (select arg_min(model, mean) from m) as chosen from m""")
def compare_models(spark, folder):
    models = {"plain": ("ridge", {"alpha": 0.0}), "mild": ("ridge", {"alpha": 100.0}), "strong": ("ridge", {"alpha": 1e7})}
    _, scores, chosen = plans.compare_models(basket(spark, folder), "price", ["quantity"], models, "row_id")
    return rounded(plans.fold_score_summary(scores), {"mean": 3, "std": 3}).withColumn("chosen", F.lit(chosen))


@query("cv_nn", f"""
with t as ({BASKET}) select fold, count(*) as n, true as every_row_scored, true as better_than_at_first, true as beats_the_mean from t group by fold""")
def cv_nn(spark, folder):
    """A network for a price: the loss of the best epoch against that of the first one and of the mean."""
    result = plans.train_and_cv(basket(spark, folder), "price", FEATURES, "nn", "row_id", model_params={"hidden_sizes": [16, 8], "dropout_rate": 0.1},
                                fit_params={"epochs": 6, "batch_size": 64, "lr": 0.01, "early_stopping_rounds": 3})
    better = F.create_map(*[x for k, m in enumerate(result.models) for x in (F.lit(k), F.lit(min(m.model.curve) < m.model.curve[0]))])
    scored = result.oof.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.every(F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("every_row_scored"),
        (F.avg((F.col("price") - F.col("prediction")) ** 2) < F.var_pop("price")).alias("beats_the_mean"))
    return scored.withColumn("better_than_at_first", better[F.col("fold")])


@query("importance_summary", f"""
with t as (select *, row_id % 2 as noise from ({BASKET})), f as (select distinct fold from t),
g as (
  select f.fold, 'many' as feature, covar_pop(price, many) * covar_pop(price, many) / var_pop(many) as gain from f join t on t.fold <> f.fold group by f.fold
  union all select f.fold, 'noise', covar_pop(price, noise) * covar_pop(price, noise) / var_pop(noise) from f join t on t.fold <> f.fold group by f.fold),
i as (select fold, feature, (gain = max(gain) over (partition by fold))::int::double as importance from g)
select feature, round(avg(importance), 6) as mean, round(stddev_pop(importance), 6) as std from i group by feature""")
def importance_summary(spark, folder):
    """A tree of one split puts all its importance on the column that explains more of the price."""
    rows = basket(spark, folder).withColumn("noise", (F.col("row_id") % 2).cast("int"))
    result = plans.train_and_cv(rows, "price", ["many", "noise"], "rf_reg", "row_id", model_params=FOREST)
    return rounded(plans.importance_summary(result.importances()), {"mean": 6, "std": 6})


def _judged(result, target, classes):
    """Per fold: rows, whether each has a prediction, and whether the predictions beat the shares of the classes."""
    p, y = F.col("prediction"), F.col(target).cast("int")
    chance = F.when(y == 1, p).otherwise(1 - p) if classes == 2 else F.element_at(p, y + 1)
    scored = result.oof.withColumn("loss", -F.ln(F.greatest(F.least(chance, F.lit(1 - 1e-15)), F.lit(1e-15))))
    shares = scored.groupBy("fold", target).agg(F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss")).withColumn(
        "whole", F.sum("n").over(Window.partitionBy("fold")))  # a row per fold and class
    return shares.groupBy("fold").agg(
        F.sum("n").alias("n"), F.every(F.col("loss").isNotNull()).alias("every_row_scored"),
        (F.sum("loss") < F.sum(-F.col("n") * F.ln(F.col("n") / F.col("whole")))).alias("beats_the_shares"))


JUDGED = f"""with t as ({BASKET}) select fold, count(*) as n, true as every_row_scored, true as beats_the_shares from t group by fold"""


@query("cv_rf_rich", JUDGED)
def cv_rf_rich(spark, folder):
    result = plans.train_and_cv(basket(spark, folder), "load", FEATURES, "rf", "row_id", model_params={
        "n_estimators": 10, "max_depth": 5, "min_samples_leaf": 5, "subsample": 0.8, "random_state": 7})
    return _judged(result, "load", 3)


@query("cv_logreg_rich", JUDGED)
def cv_logreg_rich(spark, folder):
    result = plans.train_and_cv(basket(spark, folder), "load", ["lines", "discount"], "logreg", "row_id", model_params={"C": 0.5, "max_iter": 50})
    return _judged(result, "load", 3)


@query("cv_mlp_loss", JUDGED)
def cv_mlp_loss(spark, folder):
    """The loss of each fold against that of constant shares."""
    rows = basket(spark, folder).withColumn("quantity", F.col("quantity") / 100)
    result = plans.train_and_cv(rows, "bulk", ["lines", "quantity"], "mlp", "row_id", model_params={"hidden_sizes": [6], "epochs": 60, "random_state": 3})
    return _judged(result, "bulk", 2)


@query("stack_ridge", f"""
with t as ({BASKET}), a as (select * from t where row_id % 6 <> 5),
c as (select f.fold, avg(price) as my, avg(quantity) as mx, avg(lines) as mz,
             covar_pop(price, quantity) * count(*) / (var_pop(quantity) * count(*) + 1) as sx,
             covar_pop(price, lines) * count(*) / (var_pop(lines) * count(*) + 1) as sz
      from (select distinct fold from a) f join a on a.fold <> f.fold group by f.fold),
o as (select price as y, my + sx * (quantity - mx) as q, my + sz * (lines - mz) as l from a join c on c.fold = a.fold),
h as (select row_id, avg(my + sx * (quantity - mx)) as q, avg(my + sz * (lines - mz)) as l from t, c where row_id % 6 = 5 group by row_id),
n as (select avg(y) as my, avg(q) as mq, avg(l) as ml, var_pop(q) * count(*) + 1 as qq, var_pop(l) * count(*) + 1 as ll,
             covar_pop(q, l) * count(*) as ql, covar_pop(y, q) * count(*) as qy, covar_pop(y, l) * count(*) as ly from o)
select row_id, round(my + (qy * ll - ly * ql) / (qq * ll - ql * ql) * (q - mq) + (ly * qq - qy * ql) / (qq * ll - ql * ql) * (l - ml), 2)
       + 0.0 as prediction from h, n""")
def stack_ridge(spark, folder):
    # read by every training and prediction below
    rows = materialise(basket(spark, folder))
    train, test = rows.filter("row_id % 6 <> 5"), rows.filter("row_id % 6 = 5").drop("fold", "price")
    oof, held = {}, {}
    for name in ("quantity", "lines"):
        result = plans.train_and_cv(train, "price", [name], "ridge", "row_id", test=test, model_params={"alpha": 1.0})
        oof[name], held[name] = result.oof, result.test
    wide = [plans.widen_predictions(op.stack_predictions(f, "row_id", "prediction"), "row_id", list(f)) for f in (oof, held)]
    predictions, _ = plans.train_stacking_meta_model(wide[0], train, wide[1], "row_id", "price")
    return rounded(predictions, {"prediction": 2})


# Least squares on one and on two columns per fold, from covariances.
SCORES = f"""
t as ({BASKET}),
c as (select f.fold, avg(price) as my, avg(quantity) as mx, avg(lines) as mz, var_pop(quantity) as xx, var_pop(lines) as zz,
             covar_pop(quantity, lines) as xz, covar_pop(price, quantity) as xy, covar_pop(price, lines) as zy
      from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold),
r as (select sqrt(avg(power(price - my - xy / xx * (quantity - mx), 2))) as quantity_only,
             sqrt(avg(power(price - my - zy / zz * (lines - mz), 2))) as lines_only,
             sqrt(avg(power(price - my - (xy * zz - zy * xz) / (xx * zz - xz * xz) * (quantity - mx)
                                      - (zy * xx - xy * xz) / (xx * zz - xz * xz) * (lines - mz), 2))) as together
      from t join c on c.fold = t.fold)"""


def _named(rows, values, schema):
    """Driver results of a selection as a table."""
    return rows.sparkSession.createDataFrame(values, schema)


@query("loo_importance", f"""
with {SCORES} select 'lines' as feature, round(quantity_only - together, 4) + 0.0 as importance from r
union all select 'quantity', round(lines_only - together, 4) + 0.0 from r""")
def loo_importance(spark, folder):
    rows = basket(spark, folder)
    found = plans.calculate_loo_feature_importance(
        rows, "price", ["lines", "quantity"], "ridge", "row_id", "rmse", model_params={"alpha": 0.0})
    return rounded(_named(rows, list(found.items()), "feature string, importance double"), {"importance": 4})


@query("select_forward", f"""
with {SCORES}, b as (select least(quantity_only, lines_only) as one, together, quantity_only, lines_only from r)
select 0 as place, case when quantity_only < lines_only then 'quantity' else 'lines' end as feature from b
union all select 1, case when quantity_only < lines_only then 'lines' else 'quantity' end from b where one - together > 0.00001""")
def select_forward(spark, folder):
    rows = basket(spark, folder)
    found = plans.select_features_forward(
        rows, "price", ["lines", "quantity"], "ridge", "row_id", "rmse", model_params={"alpha": 0.0})
    return _named(rows, list(enumerate(found)), "place int, feature string")


def _exact(spark, folder):
    """A target that two of three columns give exactly."""
    return basket(spark, folder).select(
        "row_id", "fold", "lines", "quantity", "discount", (F.col("lines") * 2 + F.col("quantity")).alias("y"))


@query("select_forward_exact", "select 'lines' as feature union all select 'quantity'")
def select_forward_exact(spark, folder):
    found = plans.select_features_forward(
        _exact(spark, folder), "y", ["lines", "quantity", "discount"], "ridge", "row_id", "rmse", model_params={"alpha": 0.0})
    return _named(table(spark, folder, "region"), [(f,) for f in found], "feature string")


@query("select_backward_exact", "select 'lines' as feature union all select 'quantity'")
def select_backward_exact(spark, folder):
    found = plans.select_features_backward(
        _exact(spark, folder), "y", ["lines", "quantity", "discount"], "ridge", "row_id", "mse", min_features=2,
        model_params={"alpha": 0.0})
    return _named(table(spark, folder, "region"), [(f,) for f in found], "feature string")


@query("loo_importance_exact", f"""
with t as (select *, lines * 2 + quantity as y from ({BASKET})),
c as (select f.fold, avg(y) as my, avg(quantity) as mx, avg(lines) as mz, covar_pop(y, quantity) / var_pop(quantity) as sx,
             covar_pop(y, lines) / var_pop(lines) as sz from (select distinct fold from t) f join t on t.fold <> f.fold group by f.fold),
r as (select sqrt(avg(power(y - my - sx * (quantity - mx), 2))) as without_lines,
             sqrt(avg(power(y - my - sz * (lines - mz), 2))) as without_quantity from t join c on c.fold = t.fold)
select 'lines' as feature, round(without_lines, 5) + 0.0 as importance from r
union all select 'quantity', round(without_quantity, 5) + 0.0 from r""")
def loo_importance_exact(spark, folder):
    rows = _exact(spark, folder)
    found = plans.calculate_loo_feature_importance(
        rows, "y", ["lines", "quantity"], "ridge", "row_id", "rmse", model_params={"alpha": 0.0})
    return rounded(_named(rows, list(found.items()), "feature string, importance double"), {"importance": 5})


@query("evaluate_features", f"""
with t as ({BASKET}), {SHARES.format(y='price')}
select round(sqrt(avg(power(price - p, 2))), 2) as score from t join s on s.fold = t.fold and s.many = t.many""")
def evaluate_features(spark, folder):
    """The way through the learner: one tree on one column."""
    rows = basket(spark, folder)
    score = plans.evaluate_features_cv(rows, "price", ["many"], "rf_reg", "row_id", "rmse", model_params=FOREST)
    return rounded(_named(rows, [(score,)], "score double"), {"score": 2})


@query("select_backward", f"""
with {SCORES} select 0 as place, case when quantity_only < lines_only then 'quantity' else 'lines' end as feature from r""")
def select_backward(spark, folder):
    rows = basket(spark, folder)
    found = plans.select_features_backward(
        rows, "price", ["lines", "quantity"], "ridge", "row_id", "rmse", model_params={"alpha": 0.0})
    return _named(rows, list(enumerate(found)), "place int, feature string")


# --- the whole workflow ---------------------------------------------------

FLOW = """
raw as (select o_orderkey, cast(o_orderkey % 4 as integer) as fold, o_orderkey % 5 = 0 as is_test, c_mktsegment as segment, o_orderstatus as status,
        least(greatest(nullif(c_acctbal, 0), 500.0), 8000.0) as balance, cast(replace(c_name, 'Customer#', '') as integer) as customer, o_totalprice as price
        from orders join customer on o_custkey = c_custkey),
flow as (select *, cast(case status when 'F' then 1 when 'O' then 2 end as tinyint) as code,
        dense_rank() over (order by segment) as seg from raw),
wide as (select *, avg(balance) over (partition by seg) as seg_mean,
        dense_rank() over (order by seg || '_' || coalesce(code::varchar, 'null_str')) as label from flow),
tr as (select * from wide where not is_test),
p as (select f.fold, avg(price) as m from (select distinct fold from tr) f join tr on tr.fold <> f.fold group by f.fold),
e as (select f.fold, label, avg(price) as s, count(*) as n from (select distinct fold from tr) f join tr on tr.fold <> f.fold group by f.fold, label),
g as (select avg(price) as m from tr), h as (select label, avg(price) as s, count(*) as n from tr group by label)"""


def _flow(spark, folder):
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", (F.col("o_orderkey") % 4).cast("int").alias("fold"), F.col("c_mktsegment").alias("segment"),
        F.col("o_orderstatus").alias("status"), F.nullif("c_acctbal", F.lit(0.0)).alias("balance"),
        F.col("c_name").alias("customer"), F.col("o_totalprice").alias("price"))
    plan = plans.FeaturePlan(
        row_id="o_orderkey", target="price", numeric=["balance"], categorical=["segment", "status"],
        bounds={"balance": (500, 8000)}, maps={"status": {"F": 1, "O": 2}}, prefixes={"customer": "Customer#"},
        ordinal=["segment"], powers=["balance"],
        groups=[{"groupby_cols": ["segment"], "agg_col": "balance", "agg_func": "mean", "new_col_name": "segment_balance"}],
        nway_features=["segment", "status"], nway_orders=[2])
    train, test = rows.filter("o_orderkey % 5 <> 0"), rows.filter("o_orderkey % 5 = 0").drop("price", "fold")
    train, test, _ = plans.build_features(train, test, plan, "fold")
    label = "segment_status_inter2_label"
    columns = ["o_orderkey", F.col("segment").cast("int").alias("segment"), F.col("customer").cast("int").alias("customer"),
               rnd("balance_sqrt", 3).alias("balance_sqrt"), rnd("segment_balance", 2).alias("segment_balance"),
               F.col(label).cast("int").alias("label"), rnd(f"{label}_te", 3).alias("label_te")]
    return train.select(*columns), test.select(*columns)


OUT = """select {t}.o_orderkey, cast({t}.seg as integer) as segment, {t}.customer,
round(cast(cast(sqrt({t}.balance) as float) as double), 3) as balance_sqrt,
round(cast(cast({t}.seg_mean as float) as double), 2) as segment_balance, cast({t}.label as integer) as label"""


@query("feature_flow_train", f"""
with {FLOW} {OUT.format(t='tr')}, round(coalesce((e.n * e.s + 10 * p.m) / (e.n + 10), p.m), 3) as label_te
from tr join p on p.fold = tr.fold left join e on e.fold = tr.fold and e.label = tr.label""")
def feature_flow_train(spark, folder):
    return _flow(spark, folder)[0]


@query("feature_flow_test", f"""
with {FLOW} {OUT.format(t='w')}, round(coalesce((h.n * h.s + 10 * g.m) / (h.n + 10), g.m), 3) as label_te
from (select * from wide where is_test) w cross join g left join h on h.label = w.label""")
def feature_flow_test(spark, folder):
    return _flow(spark, folder)[1]
