"""Model queries on the customer panel.

Fitted models have no SQL form, but what surrounds them has: which rows are scored, by which fold,
how many are positive, how figures and bands follow from each other. The settings are the defaults.
"""

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.learning.boosting import (
    BinPlan, BoostSettings, fit_trees, histogram, plan_bins)
from tidemark.learning.features import FeatureSpec
from tidemark.learning.importance import permutation_importance, permuted_rows
from tidemark.learning.models import baseline_pipeline, fit_balanced, tree_pipeline, with_score
from tidemark.learning.training import (
    TrainSettings, feature_schema, fold_metrics, out_of_fold_scores, prepare, score_batch, train)
from tidemark.learning.splits import with_balanced_weight
from tidemark.operators.evaluation import evaluate, score_counts
from tidemark.plans.model import score_and_save
from tidemark.queries.registry import (
    SQL_CUSTOMER_PANEL, SQL_PANEL, customer_panel, orders_t, query, table)
from tidemark.session import fresh_path, settle
from tidemark.sources.artifacts import (
    artifacts_exist, load_latest, require_same_version, save_artifacts)

SPEC = FeatureSpec(
    entity="o_custkey", period="t", target="churned_next",
    numeric=("periods_so_far", "gap_since_previous", "is_first_period", "c_acctbal", "n_orders",
             "log_spent"),
    categorical=("c_mktsegment", "n_name", "r_name"), logs={"log_spent": "spent"},
    barred=("t", "next_t"))
SETTINGS = TrainSettings()


def modelling_table(spark, sf):
    """The panel with what each customer ordered in the period."""
    spent = (orders_t(spark, sf).groupBy("o_custkey", "t")
             .agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spent")))
    return settle(customer_panel(spark, sf).join(spent, ["o_custkey", "t"]), "modelling")


def _frames(spark, sf):
    return prepare(modelling_table(spark, sf), SPEC, SETTINGS)


def _trees(frames, kind="boosted"):
    return tree_pipeline(frames.numeric, frames.categories, SPEC.target, kind, SETTINGS.trees,
                         SETTINGS.depth)


SQL_LABELLED = SQL_PANEL + """,
labelled as (
  select o_custkey, t, churned_next as y,
    cast('0x' || substr(md5('42|' || cast(o_custkey as varchar)), 1, 8) as bigint)
      < cast(floor(0.2 * 4294967296) as bigint) as held_out
  from panel where churned_next is not null)"""


def _sql_checked(rows):
    """What SQL knows of an evaluation: the rows, how many are positive, and that the rest holds."""
    return f"""with {SQL_LABELLED}
select cast(count(*) as bigint) as n, cast(sum(y) as bigint) as positives,
  round(avg(y), 9) as prevalence, true as adds_up, true as within_bounds, true as f1_follows
from {rows}"""


SQL_HOLDOUT = _sql_checked("labelled where held_out")


def _checked(metrics):
    """The counts, and the identities between the figures of an evaluation."""
    rates = [F.coalesce(F.col(c), F.lit(0.0)).between(0, 1)
             for c in ("precision", "recall", "f1", "roc_auc", "pr_auc")]
    within = rates[0]
    for rate in rates[1:]:
        within = within & rate
    f1 = F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return metrics.select(
        "n", (F.col("tp") + F.col("fn")).alias("positives"),
        F.round("prevalence", 9).alias("prevalence"),
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp") == F.col("n")).alias("adds_up"),
        within.alias("within_bounds"), (F.abs(F.col("f1") - f1) < 1e-9).alias("f1_follows"))


def _holdout_metrics(frames, pipeline):
    scored = with_score(fit_balanced(pipeline, frames.train, SPEC.target), frames.test)
    return evaluate(score_counts(scored, "score", SPEC.target), 0.5)


@query("boosted_holdout", SQL_HOLDOUT)
def boosted_holdout(spark, sf):
    frames = _frames(spark, sf)
    return _checked(_holdout_metrics(frames, _trees(frames)))


@query("baseline_holdout", SQL_HOLDOUT)
def baseline_holdout(spark, sf):
    frames = _frames(spark, sf)
    weight = float(frames.train.count())
    return _checked(_holdout_metrics(frames, baseline_pipeline(
        frames.numeric, frames.categories, SPEC.target, weight)))


@query("challenger_holdout", SQL_HOLDOUT)
def challenger_holdout(spark, sf):
    frames = _frames(spark, sf)
    return _checked(_holdout_metrics(frames, _trees(frames, "forest")))


@query("temporal_holdout", _sql_checked("labelled where t = (select max(t) from labelled)"))
def temporal_holdout(spark, sf):
    """Train before the last labelled period, test on it."""
    frames = _frames(spark, sf)
    last = frames.labelled.agg(F.max("t")).scalar()
    early = settle(frames.labelled.filter(F.col("t") < last), "early")
    late = frames.labelled.filter(F.col("t") == last)
    scored = with_score(fit_balanced(_trees(frames), early, SPEC.target), late)
    return _checked(evaluate(score_counts(scored, "score", SPEC.target), 0.5))


#: Numbers with and without gaps, and a category of which one value is not in the list.
NATIVE_PLAN = BinPlan(
    {"gap_since_previous": [1.5, 2.5], "periods_so_far": [1.0, 2.0, 3.0, 5.0, 7.0],
     "balance_band": [0.0, 20.0, 40.0, 60.0]},
    {"c_mktsegment": ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]})
FIRST_TREE = BoostSettings(trees=1, depth=1)
SQL_ROOT_SUMS = SQL_CUSTOMER_PANEL + """,
labelled as (select *, churned_next - avg(churned_next) over () as residual,
    avg(churned_next) over () * (1 - avg(churned_next) over ()) as hessian
  from cpanel where churned_next is not null),
binned as (
  select 0 as feature, case when gap_since_previous is null then -1
    else cast(gap_since_previous > 1.5 as integer) + cast(gap_since_previous > 2.5 as integer) end
    as bin, residual, hessian from labelled
  union all select 1, len(list_filter([1, 2, 3, 5, 7], lambda c: c < periods_so_far)),
    residual, hessian from labelled
  union all select 2, len(list_filter([0, 20, 40, 60], lambda c: c < balance_band)),
    residual, hessian from labelled
  union all select 3, coalesce(list_position(
    ['AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment), 0) - 1,
    residual, hessian from labelled),
sums as (
  select feature, cast(bin as integer) as bin, -sum(residual) as g, sum(hessian) as h,
    count(*) as n
  from binned group by 1, 2)"""


def _native_rows(spark, sf):
    return customer_panel(spark, sf).filter("churned_next is not null")


@query("native_root_sums", f"""with {SQL_ROOT_SUMS}
select feature, bin, round(g, 6) + 0.0 as g, round(h, 6) as h, n from sums""")
def native_root_sums(spark, sf):
    """Gradients, Hessians and rows per feature and bin, as the first tree sees them."""
    rows = settle(_native_rows(spark, sf).select("churned_next", NATIVE_PLAN.bins().alias("_bins")))
    share = rows.agg(F.avg("churned_next")).scalar()
    sums = histogram(rows.withColumns({"_g": share - F.col("churned_next"),
                                       "_h": share * (1 - share)}), F.lit(1))
    return sums.select("feature", "bin", (F.round("g", 6) + 0.0).alias("g"),
                       F.round("h", 6).alias("h"), "n")


@query("native_first_split", f"""with {SQL_ROOT_SUMS},
running as (
  select *, sum(g) over w as gl, sum(h) over w as hl, row_number() over w as place
  from (select *, case when feature = 3 then g / (h + 10) else bin end as key
        from sums where bin >= 0)
  window w as (partition by feature order by key, bin)),
totals as (
  select feature, sum(g) as gt, sum(h) as ht,
    coalesce(sum(g) filter (bin = -1), 0) as gm, coalesce(sum(h) filter (bin = -1), 0) as hm
  from sums group by feature),
sides as (
  select r.feature, r.bin, r.place, s.missing_left, gt, ht,
    gl + case when s.missing_left then gm else 0 end as lg,
    hl + case when s.missing_left then hm else 0 end as lh
  from running r join totals t on r.feature = t.feature,
    (values (false), (true)) s(missing_left)),
gains as (
  select *, round((lg * lg / (lh + 1) + (gt - lg) * (gt - lg) / (ht - lh + 1)
    - gt * gt / (ht + 1)) / 2, 9) as gain
  from sides where lh >= 1 and ht - lh >= 1)
select feature, bin as cut, missing_left, round(gain, 6) as gain,
  round(-lg / (lh + 1) * 0.1, 9) as left_value,
  round(-(gt - lg) / (ht - lh + 1) * 0.1, 9) as right_value
from gains where gain > 0 order by gain desc, feature, place, missing_left limit 1""")
def native_first_split(spark, sf):
    """Split, side of the missing rows and leaf values of a fitted first tree."""
    model = fit_trees(_native_rows(spark, sf), "churned_next", NATIVE_PLAN, FIRST_TREE)
    return model.table(spark).select(
        "feature", "cut", "missing_left", F.round("gain", 6).alias("gain"),
        F.round("left_value", 9).alias("left_value"),
        F.round("right_value", 9).alias("right_value"))


@query("native_holdout", SQL_HOLDOUT)
def native_holdout(spark, sf):
    """Trees with native missing values and categories on the holdout."""
    frames = _frames(spark, sf)
    train = with_balanced_weight(frames.train, SPEC.target)
    plan = plan_bins(train, frames.numeric, frames.categories)
    model = fit_trees(train, SPEC.target, plan, BoostSettings(trees=6, depth=3), "weight")
    return _checked(evaluate(score_counts(
        model.with_score(frames.test), "score", SPEC.target), 0.5))


_REPEATS = 3


@query("permuted_features", f"""
select cast(r as integer) as repeat, count(*) as n, count(*) as donors,
  cast(0 as bigint) as own, cast(sum(cast(round(c_acctbal * 100) as bigint)) as bigint) as cents
from customer, range(1, {_REPEATS + 1}) t(r) group by r""")
def permuted_features(spark, sf):
    """Over the whole table every row lends its features once per repeat and keeps none."""
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_custkey").alias("donor"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"))
    out = permuted_rows(rows, ["c_custkey"], ["donor", "cents"], _REPEATS, SETTINGS.seed)
    return out.groupBy(F.col("_repeat").alias("repeat")).agg(
        F.count("*").alias("n"), F.count_distinct("_perm.donor").alias("donors"),
        F.count_if(F.col("_perm.donor") == F.col("c_custkey")).alias("own"),
        F.sum("_perm.cents").alias("cents"))


_NO_FEATURE = "constant"


@query("permutation_importance", "select * from (values " + ", ".join(
    f"('{f}', true)" for f in (*SPEC.numeric, *SPEC.categorical, _NO_FEATURE))
    + ") as v(feature, sound)")
def importance(spark, sf):
    """A feature that the model does not see loses exactly nothing; the others a finite amount."""
    frames = _frames(spark, sf)
    model = fit_balanced(_trees(frames), frames.train, SPEC.target)
    rows = frames.test.withColumn(_NO_FEATURE, F.lit(1))
    found = permutation_importance(
        model, rows, ["o_custkey", "t"], [*frames.numeric, *frames.categories, _NO_FEATURE],
        SPEC.target, SETTINGS.repeats)
    lost, spread = F.col("importance_mean"), F.col("importance_std")
    return found.select("feature", F.when(
        F.col("feature") == _NO_FEATURE, (lost == 0) & (spread == 0)).otherwise(
        lost.between(-1, 1) & (spread >= 0)).alias("sound"))


def _band_by_rule(score, limit):
    """The published rule: high from the threshold on, medium from its half on, else low."""
    return (F.when(score < limit / 2, "bajo").when(score < limit, "medio").otherwise("alto"))


@query("train_and_score", f"""with {SQL_PANEL}
select cast(o_custkey as varchar) as id, t, 'run-1' as model_version, true as valid_score,
  true as band_follows from panel""")
def train_and_score(spark, sf):
    """The whole protocol, then scores of every period."""
    rows = modelling_table(spark, sf)
    model, metrics, schema = train(rows, SPEC, "run-1", SETTINGS)
    scores = score_batch(rows, model, metrics, schema, "run-2", ["t"])
    return scores.select(
        "id", "t", "model_version", F.col("score_riesgo").between(0, 1).alias("valid_score"),
        (F.col("banda_riesgo") == _band_by_rule(F.col("score_riesgo"), F.col("threshold")))
        .alias("band_follows"))


SQL_TRAIN_FOLDS = SQL_PANEL + """,
lab as (
  select o_custkey, t, churned_next as y from panel where churned_next is not null
    and cast('0x' || substr(md5('42|' || cast(o_custkey as varchar)), 1, 8) as bigint)
        >= cast(floor(0.2 * 4294967296) as bigint)),
strata as (
  select o_custkey, max(y) as stratum,
    cast('0x' || substr(md5('42|' || cast(o_custkey as varchar)), 1, 13) as bigint) as h
  from lab group by o_custkey),
folds as (
  select o_custkey, cast((row_number() over (partition by stratum
    order by h, cast(o_custkey as varchar)) - 1) % 5 as integer) as fold from strata)"""


@query("oof_fold_metrics", f"""with {SQL_TRAIN_FOLDS}
select fold, count(*) as n_val, round(avg(y), 9) as prevalence_val, true as within_bounds
from lab join folds using (o_custkey) group by fold""")
def oof_fold_metrics(spark, sf):
    found = fold_metrics(out_of_fold_scores(_frames(spark, sf), SPEC, SETTINGS), SPEC.target)
    return found.select("fold", "n_val", F.round("prevalence_val", 9).alias("prevalence_val"),
                        (F.col("f1_default").between(0, 1)
                         & F.coalesce(F.col("pr_auc"), F.lit(0.0)).between(0, 1))
                        .alias("within_bounds"))


@query("oof_coverage", f"""with {SQL_TRAIN_FOLDS}
select fold, count(*) as n_val, round(avg(y), 9) as prevalence_val, true as valid
from lab join folds using (o_custkey) group by fold""")
def oof_coverage(spark, sf):
    """Every training row has one out-of-fold score, from the model of its own fold."""
    oof = out_of_fold_scores(_frames(spark, sf), SPEC, SETTINGS)
    return oof.groupBy("fold").agg(
        F.count("score").alias("n_val"), F.round(F.avg(SPEC.target), 9).alias("prevalence_val"),
        F.bool_and(F.col("score").between(0, 1)).alias("valid"))


@query("batch_scores", f"""with {SQL_PANEL}
select cast(o_custkey as varchar) as id, t, 'run-1' as model_version, 0.5::double as threshold,
  true as valid_score, true as band_follows from panel""")
def batch_scores(spark, sf):
    """Every period of every entity is scored once, the censored one included."""
    rows = modelling_table(spark, sf)
    frames = prepare(rows, SPEC, SETTINGS)
    model = fit_balanced(_trees(frames), frames.train, SPEC.target)
    schema = feature_schema(SPEC, frames.categories, "run-1", spark.version)
    scores = score_batch(rows, model, {"threshold": {"threshold": 0.5}}, schema, "run-2", ["t"])
    return scores.select(
        "id", "t", "model_version", "threshold",
        F.col("score_riesgo").between(0, 1).alias("valid_score"),
        (F.col("banda_riesgo") == _band_by_rule(F.col("score_riesgo"), F.lit(0.5)))
        .alias("band_follows"))


@query("artifact_roundtrip", f"""with {SQL_PANEL}
select t, count(*) as n, count(distinct o_custkey) as customers, true as same_scores,
  'run-a' as model_version from panel group by t""")
def artifact_roundtrip(spark, sf):
    """A model saved and loaded gives the scores of the one in memory, with its frozen encoding."""
    rows = modelling_table(spark, sf)
    frames = prepare(rows, SPEC, SETTINGS)
    model = fit_balanced(baseline_pipeline(frames.numeric, frames.categories, SPEC.target,
                                           float(frames.train.count())), frames.train, SPEC.target)
    schema = feature_schema(SPEC, frames.categories, "run-a", spark.version)
    metrics = {"threshold": {"threshold": 0.5}}
    root = fresh_path(spark, "models")
    save_artifacts(spark, root, "run-a", model, metrics, schema)
    own = score_batch(rows, model, metrics, schema, "r", ["t"]).select(
        "id", "t", F.col("score_riesgo").alias("own"))
    loaded = score_batch(rows, *load_latest(spark, root), "r", ["t"])
    return loaded.join(own, ["id", "t"]).groupBy("t").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("customers"),
        F.bool_and(F.col("score_riesgo") == F.col("own")).alias("same_scores"),
        F.max("model_version").alias("model_version"))


@query("no_model_no_scores", f"""with {SQL_PANEL}
select t, count(*) as n, false as scored from panel group by t""")
def no_model_no_scores(spark, sf):
    """Scoring before the first training writes nothing."""
    rows, root = modelling_table(spark, sf), fresh_path(spark, "untrained")
    rows.write.parquet(f"{root}/table")
    made = score_and_save(spark, f"{root}/table", f"{root}/models", f"{root}/scores", "r")
    scored = made is not None or artifacts_exist(spark, f"{root}/scores")
    return spark.read.parquet(f"{root}/table").groupBy("t").agg(
        F.count("*").alias("n"), F.lit(scored).alias("scored"))


def _refusal(check):
    try:
        check()
    except (ValueError, RuntimeError) as error:
        return str(error).split(":")[0]
    return "accepted"


@query("feature_contract", f"""with {SQL_PANEL}
select refusal, n from (select count(*) as n from panel), (values ('accepted'),
  ('columns missing from the modelling table'), ('columns barred as leakage among the features'),
  ('model was trained with Spark 0.0, this is ' || '4'))
  as v(refusal)""")
def feature_contract(spark, sf):
    """The contract accepts the table; it refuses a lacking column, a leak and another version."""
    rows = modelling_table(spark, sf)
    leaking = replace(SPEC, numeric=(*SPEC.numeric, "next_t"))
    found = [_refusal(lambda: SPEC.check(rows.columns)),
             _refusal(lambda: SPEC.check(rows.drop("n_orders").columns)),
             _refusal(lambda: leaking.check(rows.columns)),
             _refusal(lambda: require_same_version("0.0", "4"))]
    return rows.agg(F.count("*").alias("n")).select(
        F.explode(F.array(*map(F.lit, found))).alias("refusal"), "n")
