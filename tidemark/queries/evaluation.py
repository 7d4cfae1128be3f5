"""Model evaluation queries on a formula score, so that SQL can check every figure."""

from pyspark.sql import functions as F

from tidemark.learning.features import FeatureSpec, apply_categories, build_features
from tidemark.learning.features import freeze_categories
from tidemark.learning.splits import (
    class_weights, exact_holdout, group_folds, in_holdout, with_balanced_weight)
from tidemark.learning.training import fold_metrics
from tidemark.operators.evaluation import (
    cv_summary, evaluate, goal_met, group_error_rates, pr_curve, pr_points, score_counts,
    tune_threshold)
from tidemark.queries.registry import SQL_PANEL, orders_panel, query, table
from tidemark.session import settle

# Labelled panel rows with a score that leans on the history, 0.000-0.999.
SQL_SCORED = SQL_PANEL + """,
lab as (
  select o_custkey, t, churned_next as y,
    ((o_custkey * 131 + t * 17) % 700 + churned_next * 300 - is_first_period * 0)
      / 1000.0::double as score
  from panel where churned_next is not null)"""


def labelled_scores(spark, sf):
    raw = ((F.col("o_custkey") * 131 + F.col("t") * 17) % 700 + F.col("churned_next") * 300)
    return (orders_panel(spark, sf).filter(F.col("churned_next").isNotNull())
            .select("o_custkey", "t", F.col("churned_next").alias("y"),
                    (raw / F.lit(1000.0)).alias("score")))


SQL_POINTS = SQL_SCORED + """,
by_score as (select score, sum(y) as p, count(*) as n from lab group by score),
points as (
  select score, cast(p as bigint) as p, n,
    cast(sum(p) over (order by score desc) as bigint) as tp,
    cast(sum(n) over (order by score desc) as bigint) as selected,
    cast((select sum(p) from by_score) as bigint) as pos,
    cast((select sum(n) from by_score) as bigint) as total from by_score),
pr as (select *, tp / selected as precision, tp / pos as recall from points),
cand as (select * from pr where tp < pos or p > 0)"""


def _counts(spark, sf):
    return score_counts(labelled_scores(spark, sf), "score", "y")


@query("pr_points", f"""with {SQL_POINTS}
select score, p, n, tp, selected, round(precision, 12) as precision, round(recall, 12) as recall
from pr""")
def pr_points_query(spark, sf):
    out = pr_points(_counts(spark, sf))
    return out.select("score", "p", "n", "tp", "selected",
                      F.round("precision", 12).alias("precision"),
                      F.round("recall", 12).alias("recall"))


@query("pr_curve", f"""with {SQL_POINTS},
placed as (
  select row_number() over (order by score) - 1 as position, precision, recall from cand
  union all select (select count(*) from cand), 1.0, 0.0)
select position, round(precision, 12) as precision, round(recall, 12) as recall from placed
where position % greatest(1, ((select count(*) from cand) + 1) // 200) = 0""")
def pr_curve_query(spark, sf):
    out = pr_curve(_counts(spark, sf))
    return out.select("position", F.round("precision", 12).alias("precision"),
                      F.round("recall", 12).alias("recall"))


def _sql_threshold(p: float) -> str:
    return f"""with {SQL_POINTS},
safe as (select score, precision, recall, 'max recall s.t. precision>={p}' as criterion
  from cand where precision >= {p} order by recall desc, score limit 1),
best as (select score, precision, recall,
  'max F1 (NINGUN threshold alcanzo precision>={p} en OOF)' as criterion
  from cand order by 2 * precision * recall / greatest(precision + recall, 1e-9) desc, score
  limit 1)
select score as threshold, round(precision, 12) as oof_precision,
  round(recall, 12) as oof_recall, criterion
from (select * from safe union all select * from best where not exists (select 1 from safe))"""


def _threshold(spark, sf, p):
    out = tune_threshold(_counts(spark, sf), p)
    return out.withColumns({c: F.round(c, 12) for c in ("oof_precision", "oof_recall")})


@query("threshold", _sql_threshold(0.8))
def threshold(spark, sf):
    return _threshold(spark, sf, 0.8)


@query("threshold_fallback", _sql_threshold(1.5))
def threshold_fallback(spark, sf):
    """No score reaches this precision, so the best F1 decides."""
    return _threshold(spark, sf, 1.5)


SQL_EVAL = """
evald as (
  select sum(p) filter (where score >= 0.55) as tp, sum(n - p) filter (where score >= 0.55) as fp,
    sum(p) filter (where score < 0.55) as fn, sum(n - p) filter (where score < 0.55) as tn,
    sum(precision * p) / max(pos) as pr_auc,
    sum((n - p) * (tp - p / 2.0::double)) / (max(pos) * (max(total) - max(pos))) as roc_auc
  from pr),
measured as (
  select round(tp / (tp + fp), 9) as precision, round(tp / (tp + fn), 9) as recall,
    round(2.0 * tp / (2.0 * tp + fp + fn), 9) as f1, round(roc_auc, 9) as roc_auc,
    round(pr_auc, 9) as pr_auc, cast(tn as bigint) as tn, cast(fp as bigint) as fp,
    cast(fn as bigint) as fn, cast(tp as bigint) as tp, cast(tn + fp + fn + tp as bigint) as n,
    round((tp + fn) / (tp + fp + fn + tn), 9) as prevalence from evald)"""
ROUNDED = ("precision", "recall", "f1", "roc_auc", "pr_auc", "prevalence")


def _evaluated(spark, sf):
    out = evaluate(_counts(spark, sf), 0.55)
    return out.withColumns({c: F.round(c, 9) for c in ROUNDED})


@query("eval_metrics", f"with {SQL_POINTS}, {SQL_EVAL} select * from measured")
def eval_metrics(spark, sf):
    return _evaluated(spark, sf)


@query("goal_check", f"""with {SQL_POINTS}, {SQL_EVAL}
select f1, precision, f1 >= 0.8 and precision >= 0.8 as goal_met from measured""")
def goal_check(spark, sf):
    return goal_met(_evaluated(spark, sf)).select("f1", "precision", "goal_met")


SQL_FOLDS = """
strata as (
  select o_custkey, max(y) as stratum,
    cast('0x' || substr(md5('42|' || cast(o_custkey as varchar)), 1, 13) as bigint) as h
  from lab group by o_custkey),
folds as (
  select o_custkey, cast((row_number() over (partition by stratum
    order by h, cast(o_custkey as varchar)) - 1) % 5 as integer) as fold from strata)"""


@query("group_folds", f"with {SQL_SCORED}, {SQL_FOLDS} select o_custkey, fold from folds")
def group_folds_query(spark, sf):
    return group_folds(labelled_scores(spark, sf), "o_custkey", "y")


SQL_FOLD_METRICS = """
fs as (select fold, score, sum(y) as p, count(*) as n from lab join folds using (o_custkey)
       group by fold, score),
fp as (select *, sum(p) over (partition by fold order by score desc) as tp,
         sum(n) over (partition by fold order by score desc) as sel from fs),
fm as (
  select fold, cast(sum(n) as bigint) as n_val, sum(p) / sum(n) as prevalence_val,
    2.0 * sum(p) filter (where score >= 0.5)
      / (sum(p) + sum(n) filter (where score >= 0.5)) as f1_default,
    sum(tp / sel * p) / sum(p) as pr_auc
  from fp group by fold)"""


def _fold_metrics(spark, sf):
    rows = settle(labelled_scores(spark, sf), "scored")
    return fold_metrics(rows.join(group_folds(rows, "o_custkey", "y"), "o_custkey"), "y")


@query("fold_metrics", f"""with {SQL_SCORED}, {SQL_FOLDS}, {SQL_FOLD_METRICS}
select fold, n_val, round(prevalence_val, 9) as prevalence_val,
  round(f1_default, 9) as f1_default, round(pr_auc, 9) as pr_auc from fm""")
def fold_metrics_query(spark, sf):
    out = _fold_metrics(spark, sf)
    return out.withColumns({c: F.round(c, 9) for c in ("prevalence_val", "f1_default", "pr_auc")})


@query("cv_summary", f"""with {SQL_SCORED}, {SQL_FOLDS}, {SQL_FOLD_METRICS}
select count(*) as k, round(avg(f1_default), 9) as f1_mean_default,
  round(stddev_pop(f1_default), 9) as f1_std_default, round(avg(pr_auc), 9) as pr_auc_mean,
  round(stddev_pop(pr_auc), 9) as pr_auc_std from fm""")
def cv_summary_query(spark, sf):
    out = cv_summary(_fold_metrics(spark, sf))
    return out.withColumns({c: F.round(c, 9) for c in out.columns if c != "k"})


@query("group_holdout", f"""with {SQL_SCORED}
select o_custkey, t, cast('0x' || substr(md5('42|' || cast(o_custkey as varchar)), 1, 8)
  as bigint) < cast(floor(0.2 * 4294967296) as bigint) as in_holdout from lab""")
def group_holdout(spark, sf):
    return labelled_scores(spark, sf).select("o_custkey", "t",
                                             in_holdout(F.col("o_custkey")).alias("in_holdout"))


@query("exact_holdout", f"""with {SQL_SCORED},
ids as (select o_custkey, row_number() over (order by
    cast('0x' || substr(md5('42|' || cast(o_custkey as varchar)), 1, 13) as bigint)) as k,
    count(*) over () as n from (select distinct o_custkey from lab))
select o_custkey, t, k <= ceil(0.2 * n) as in_holdout from lab join ids using (o_custkey)""")
def exact_holdout_query(spark, sf):
    rows = settle(labelled_scores(spark, sf).select("o_custkey", "t"), "scored")
    return exact_holdout(rows, "o_custkey")


@query("class_weights", """
with c as (select toxic, count(*) as n from labels group by toxic)
select toxic, n, round((select sum(n) from c) / ((select count(*) from c) * n), 9) as weight
from c""")
def class_weights_query(spark, sf):
    out = class_weights(table(spark, sf, "labels"), "toxic")
    return out.withColumn("weight", F.round("weight", 9))


@query("row_weights", """
with s as (select count(*) as n, sum(quality) as pos from labels)
select doc_id, round(n / (2.0 * case when quality = 1 then pos else n - pos end), 9) as weight
from labels, s""")
def row_weights(spark, sf):
    rows = with_balanced_weight(table(spark, sf, "labels"), "quality")
    return rows.select("doc_id", F.round("weight", 9).alias("weight"))


@query("fairness_report", f"""with {SQL_SCORED},
seg as (
  select y, cast(score >= 0.55 as integer) as yhat, c_mktsegment, nullif(c_nationkey % 6, 5)
    as block from lab join customer on c_custkey = o_custkey),
long as (
  select y, yhat, 'c_mktsegment' as dimension, c_mktsegment as category from seg
  union all select y, yhat, 'block', cast(block as varchar) from seg where block is not null)
select dimension, category, count(*) as n, round(avg(y), 3) as prevalence,
  round(coalesce(sum(y * yhat) / nullif(sum(y), 0), 0), 3) as recall,
  round(coalesce(sum(y * yhat) / nullif(sum(yhat), 0), 0), 3) as precision
from long group by 1, 2 having count(*) >= 100""")
def fairness_report(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment",
        F.nullif(F.col("c_nationkey") % 6, F.lit(5)).alias("block"))
    rows = labelled_scores(spark, sf).join(customer, "o_custkey").withColumn(
        "yhat", (F.col("score") >= 0.55).cast("int"))
    return group_error_rates(rows, ["c_mktsegment", "block"], "y", "yhat")


SQL_FEATURES = """
feat as (
  select o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as double) as urgency,
    round(ln(1 + try_cast(cast(o_totalprice as varchar) as double)), 9) as log_price,
    upper(trim(coalesce(nullif(o_orderstatus, 'P'), 'DESCONOCIDO'))) as status,
    upper(trim(o_orderpriority)) as priority from orders)"""

FEATURE_SPEC = FeatureSpec("o_custkey", "o_orderkey", "o_totalprice",
                           ("urgency", "log_price"), ("status", "priority"),
                           {"log_price": "price_text"})


def _features(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.substring("o_orderpriority", 1, 1).alias("urgency"),
        F.col("o_totalprice").cast("string").alias("price_text"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("priority"))
    FEATURE_SPEC.check(raw.columns)
    return build_features(raw, FEATURE_SPEC)


@query("feature_frame", f"""with {SQL_FEATURES}
select o_orderkey, urgency, log_price, status, priority from feat""")
def feature_frame(spark, sf):
    return _features(spark, sf).select("o_orderkey", "urgency",
                                       F.round("log_price", 9).alias("log_price"), "status",
                                       "priority")


@query("frozen_categories", f"""with {SQL_FEATURES},
kept as (select priority from feat group by priority order by count(*) desc, priority limit 3)
select o_orderkey, status, case when priority in (select priority from kept) then priority
  else 'OTRO' end as priority from feat""")
def frozen_categories(spark, sf):
    rows = _features(spark, sf).select("o_orderkey", "status", "priority")
    kept = freeze_categories(rows, FeatureSpec("", "", "", (), ("priority",)), 3)
    return apply_categories(rows, kept)
