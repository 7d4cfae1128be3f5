import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.learning.features import FeatureSpec, apply_categories, build_features
from tidemark.learning.features import freeze_categories
from tidemark.learning import importance
from tidemark.learning.importance import permuted_rows
from tidemark.learning.models import fit_balanced, tree_pipeline, with_score
from tidemark.learning.splits import exact_holdout, group_folds, in_holdout
from tidemark.learning.training import TrainSettings, prepare
from tidemark.plans.fixed import CHURN_SPEC
from tidemark.plans.model import score_and_save, train_and_save
from tidemark.session import settle
from tidemark.sources import load_latest


def test_contract_names_missing_columns_and_leaks():
    with pytest.raises(ValueError, match="missing"):
        CHURN_SPEC.check(["id"])
    leaking = FeatureSpec("id", "t", "y", ("next_t",), (), barred=("next_t",))
    with pytest.raises(ValueError, match="leakage"):
        leaking.check(["id", "t", "y", "next_t"])
    assert not set(CHURN_SPEC.barred) & set(CHURN_SPEC.features)


def test_features_and_categories(spark):
    spec = FeatureSpec("id", "t", "y", ("age", "log_n"), ("sex",), {"log_n": "n"})
    df = spark.createDataFrame([(1, "20", "0", " f "), (2, "x", None, None), (3, "9", "1", "M")],
                               "id int, age string, n string, sex string")
    got = build_features(df, spec).select("id", "age", F.round("log_n", 6), "sex")
    assert rows(got, "id") == [(1, 20.0, 0.0, "F"), (2, None, None, "DESCONOCIDO"),
                               (3, 9.0, 0.693147, "M")]
    frozen = freeze_categories(build_features(df, spec).filter("id < 3"), spec, 1)
    assert frozen == {"sex": ["DESCONOCIDO", "OTRO"]}
    mapped = apply_categories(build_features(df, spec), frozen).select("id", "sex")
    assert rows(mapped, "id") == [(1, "OTRO"), (2, "DESCONOCIDO"), (3, "OTRO")]


def test_splits_never_part_an_entity(spark):
    df = spark.range(3000).select((F.col("id") % 500).alias("id"), F.col("id").alias("k"),
                                  (F.col("id") % 3 == 0).cast("int").alias("y"))
    flagged = df.withColumn("h", in_holdout(F.col("id")))
    assert flagged.groupBy("id").agg(F.countDistinct("h").alias("n")).filter("n > 1").count() == 0
    exact = exact_holdout(df, "id").filter("in_holdout").select("id").distinct().count()
    assert exact == 100
    folds = group_folds(df, "id", "y")
    assert folds.count() == 500
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2


@pytest.mark.parametrize("n", [400, 3, 2])
def test_permuted_features_are_a_permutation(spark, n):
    df = spark.range(n).select("id", (F.col("id") * 10).alias("a"), F.col("id").alias("b"))
    out = permuted_rows(df, ["id"], ["a", "b"], 2, 1).select("id", "_repeat", "_perm.*").cache()
    assert out.count() == 2 * n and out.filter(F.col("a") != F.col("b") * 10).count() == 0
    for r in (1, 2):
        picked = out.filter(F.col("_repeat") == r)
        assert picked.select("b").distinct().count() == n
        assert picked.filter(F.col("b") == F.col("id")).count() == 0
    if n > 2:  # two repeats are two different permutations
        assert out.groupBy("id").agg(F.count_distinct("b").alias("d")).filter("d < 2").count() == 0


def test_donors_do_not_pass_through_the_driver(spark):
    """Rows of arrays look small to Catalyst; at 1 GB their broadcast ended the driver."""
    df = spark.range(50).select("id", F.array(F.col("id")).alias("a"))
    plan = permuted_rows(df, ["id"], ["a"], 2, 1)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_place" in plan and "HashJoin [_place" not in plan


def test_one_row_keeps_its_features_and_none_gives_none(spark):
    df = spark.range(1).withColumn("a", F.lit(5))
    assert [r["_perm"]["a"] for r in permuted_rows(df, ["id"], ["a"], 2, 1).collect()] == [5, 5]
    assert permuted_rows(df.limit(0), ["id"], ["a"], 2, 1).collect() == []


@pytest.fixture(scope="module")
def modelling(spark, tmp_path_factory):
    """A small modelling table where missed semesters and age drive the target."""
    path = str(tmp_path_factory.mktemp("gold") / "fact")
    n = F.col("id")
    base = spark.range(900).select(
        (n % 300).cast("string").alias("id"), (F.floor(n / 300) + 1).cast("int")
        .alias("semestre_orden"), n.alias("k"))
    noise = F.pmod(F.xxhash64("k"), F.lit(100))
    age = (F.pmod(F.xxhash64("id"), F.lit(40)) + 18)
    y = F.when(F.col("semestre_orden") == 3, None).when(
        (age > 38) & (noise < 85), 1).otherwise((noise < 10).cast("int"))
    text = {c: F.concat(F.lit(f"{c} "), (F.col("k") % m).cast("string")) for c, m in (
        ("sexo", 2), ("zona_de_residencia", 2), ("escuela", 3), ("programa", 7), ("zona", 4),
        ("centro", 5), ("departamento_residencia", 6), ("cohorte_tipo", 3))}
    df = base.select(
        "*", F.lit(2024).alias("anio"), F.lit("2024-1").alias("semestre_academico"),
        age.cast("string").alias("edad"), (F.col("k") % 6).cast("string").alias("estrato_social"),
        F.lit(1).alias("n_periodos_en_semestre"),
        F.col("semestre_orden").alias("semestres_cursados_acum"),
        F.when(F.col("semestre_orden") > 1, 1).alias("gap_desde_semestre_anterior"),
        (F.col("semestre_orden") == 1).cast("int").alias("es_primer_semestre"),
        *[F.lit(None).cast("double").alias(c) for c in (
            "tasa_informalidad_mpio", "tasa_hacinamiento_mpio")],
        (noise / 100).alias("promedio_ipm_mpio"), F.lit(10).alias("poblacion_sisben_mpio"),
        F.lit(5).alias("total_accesos_res"), F.lit(2).alias("nivel_conectividad"),
        y.alias("desertion_t1"), *[c.alias(k) for k, c in text.items()]).drop("k")
    df.write.partitionBy("anio").parquet(path)
    return path


def test_train_save_load_score(spark, modelling, tmp_path):
    root, out = str(tmp_path / "m"), str(tmp_path / "scores")
    assert score_and_save(spark, modelling, root, out, "r0") is None
    metrics = train_and_save(spark, spark.read.parquet(modelling), root, "r1",
                             settings=TrainSettings(trees=5, depth=3, folds=3, repeats=1,
                                                    min_precision=0.6))
    assert metrics["test"]["pr_auc"] > metrics["test"]["prevalence"] + 0.1
    lost = {r["feature"]: r["importance_mean"] for r in metrics["permutation_importance"]}
    assert metrics["permutation_importance"][0]["feature"] == "edad"
    assert lost["edad"] > 0.1 and lost["edad"] > 3 * abs(lost["programa"])
    assert metrics["temporal"]["test_semestre"] == 2
    assert metrics["validation"]["kfold"]["k"] == 3 and metrics["pr_curve_test"]
    assert metrics["dataset"]["rows_labeled"] == 600
    _, stored, schema = load_latest(spark, root)
    assert stored["test"] == metrics["test"] and schema["run_id"] == "r1"
    scores = score_and_save(spark, modelling, root, out, "r2")
    assert scores.count() == 900  # every semester, also the censored one
    assert set(scores.columns) == {
        "id", "anio", "semestre_academico", "semestre_orden", "score_riesgo", "banda_riesgo",
        "threshold", "model_version", "_predict_run_id", "_predicted_at"}
    limit = metrics["threshold"]["threshold"]
    assert scores.filter((F.col("banda_riesgo") == "alto")
                         != (F.col("score_riesgo") >= limit)).count() == 0


def test_permuted_rows_score_as_the_model_scores_them(spark, modelling, monkeypatch):
    """Shared leaf masks give the model's own scores, and the pairs are dealt by their number."""
    spec, settings = CHURN_SPEC, TrainSettings(trees=5, depth=4)
    frames = prepare(spark.read.parquet(modelling), spec, settings)
    model = fit_balanced(tree_pipeline(frames.numeric, frames.categories, spec.target, "boosted",
                                       5, 4), frames.train, spec.target)
    key, features = [spec.entity, spec.period], [*frames.numeric, *frames.categories, "unseen"]
    test = settle(frames.test.withColumn("unseen", F.lit(1)), "test")
    monkeypatch.setattr(importance, "PAIRS_PER_TASK", 50)
    scored = importance.variant_scores(model, test, key, features, spec.target, 2, 7)
    assert scored.rdd.getNumPartitions() == -(-test.count() * 2 // 50) > 1
    got = rows(scored.select("target", "feature", "repeat", F.round("score", 12)))

    pairs = permuted_rows(test, key, features, 2, 7)
    want = [(*r, len(features), 0) for r in with_score(model, test).select(
        spec.target, F.round("score", 12)).collect()]
    for i, name in enumerate(features):
        lent = pairs.withColumn(name, F.col("_perm")[name]).select(*test.columns, "_repeat")
        want += [(r[0], r[2], i, r[1]) for r in with_score(model, lent).select(
            spec.target, "_repeat", F.round("score", 12)).collect()]
    assert got == sorted(((y, i, r, p) for y, p, i, r in want), key=repr)
