"""The whole flow on a small lake, with training; then publication without a model."""

import json
import random
import shutil
import uuid

import pytest

from tests.conftest import rows
from tidemark.learning.training import TrainSettings
from tidemark.plans.fixed import SEMESTER_COLUMNS
from tidemark.plans.medallion import run_flow
from tidemark.plans.publish import publish_dashboard
from tidemark.sources import read_published

PERIODS = {"1701": 1, "1702": 1, "1704": 2, "2031": 3, "2032": 3, "2034": 4}
SCHEMAS = {
    "gobierno_sisben_iv": "cod_mpio string, h_5 string, i8 string, i15 string, zona string",
    "gobierno_internet_fijo": "municipio string, departamento string, cod_municipio string, "
                              "segmento string, anno string, trimestre string, "
                              "no_de_accesos string",
    "gobierno_cobertura_educativa": "x string",
}
HEADER = ("periodo;Id;Edad;Sexo;Estrato Social;Zona de Residencia;Escuela;Programa;Zona;Centro;"
          "Departamento Residencia;Municipio Residencia")


def person(i, period, age=25, place="Cali", region="Valle del Cauca"):
    return (f"x {period};{i};{age};{'FM'[i % 2]};{i % 5};urbana;E{i % 3};P{i % 4};Z1;C{i % 2};"
            f"{region};{place}")


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = root / "raw"
    for d in ("estudiantes", "gobierno", "spadies", "snies"):
        (raw / d).mkdir(parents=True)
    rnd = random.Random(8)
    lines = {p: [] for p in PERIODS}
    (raw / "exports").mkdir()
    (raw / "exports" / "estudiantes_periodo_2035.csv").write_bytes(
        ("Informe de matrícula " + "." * 250 + "\nEstudiantes del periodo 2025 (x)\n\n"
         + HEADER.removeprefix("periodo;") + "\n"
         + person(900006, "").removeprefix("x ;") + "\n").encode("cp1252"))
    # 900001 in every semester, twice in the first; 900002 skips one; 900003 leaves; 900004 last
    for p in PERIODS:
        lines[p].append(person(900001, p))
    lines["1701"] += [person(900001, "1701"), person(900002, "1701", place="Palmira (Valle)"),
                      person(900003, "1701", place="Unica", region="Otra cosa")]
    lines["1702"] += [person(900004, "1702", age="x", place="Nowhere")]
    lines["2031"] += [person(900002, "2031")]
    lines["2034"] += [person(900005, "2034")]
    for i in range(400):
        stays = 0.9 if i % 5 < 2 else 0.5
        for p in ("1701", "1704", "2031", "2034"):
            lines[p].append(person(i, p, age=20 + i % 30,
                                   place=rnd.choice(["CALI", "Bogotá, D.C.", "Palmira"]),
                                   region=rnd.choice(["Valle del Cauca", "Bogota"])))
            if rnd.random() > stays:
                break
    for p, body in lines.items():
        (raw / "estudiantes" / f"estudiantes_periodo_{p}.csv").write_text(
            "\n".join([HEADER, *body]) + "\n")
    (raw / "estudiantes" / "estudiantes_periodo_0001.csv").write_text(
        "\n".join([HEADER, person(7, "0001")]) + "\n")

    places = [("Cali", "Valle del Cauca", "76001"), ("Palmira", "Valle del Cauca", "76520"),
              ("Bogotá D.C.", "Bogotá D.C.", "11001"), ("Única", "Antioquia", "5001"),
              ("Palmira", "Nariño", "52520")]
    net = []
    for k, (m, d, c) in enumerate(places):
        base = {"municipio": m, "departamento": d, "cod_municipio": c}
        for year, quarter in (("2022", "4"), ("2023", "1")):
            for j in range(2):
                net.append({**base, "segmento": "RESIDENCIAL - ESTRATO 1", "anno": year,
                            "trimestre": quarter, "no_de_accesos": str(100 * (k + 1) + j)})
        net.append({**base, "segmento": "CORPORATIVO", "anno": "2023", "trimestre": "2",
                    "no_de_accesos": "99999"})
    (raw / "gobierno" / "n48w-gutb.json").write_text(json.dumps(net))
    poor = [{"cod_mpio": "76001", "h_5": v, "i8": "1", "i15": "0", "zona": "1"}
            for v in ("0.2", "0.4", "mal")] + [{"cod_mpio": "5001", "h_5": "1", "i8": "0",
                                                "i15": "1", "zona": "2"}]
    (raw / "gobierno" / "hq2v-5umk.json").write_text(json.dumps(poor))
    (raw / "gobierno" / "ji8i-4anb.json").write_text('[{"x": "1"}]')
    (raw / "gobierno" / "aaaa-bbbb.json").write_text("[{}]")
    (raw / "spadies" / "creditoicetex.csv").write_text("Tipo;2020-1\nNo recibió;4\n")
    (raw / "snies" / "graduados.csv").write_text("a\nb\nc\nd\ne\nNombre;Total\nX;1\n;;\n")
    return root


@pytest.fixture(scope="module")
def first(spark, lake):
    tag = uuid.uuid4().hex
    return run_flow(spark, str(lake), SCHEMAS, f"silver_{tag}", f"gold_{tag}", retrain=True,
                    settings=TrainSettings(trees=3, depth=3, folds=2, repeats=1))


def test_gold(spark, first):
    assert first["mirrored"] == ["dim_gold_snies_graduados", "dim_gold_spadies_creditos",
                                 "dim_gold_gobierno_sisben", "dim_gold_gobierno_internet"]
    fact = spark.read.parquet(first["gold"]["fact_estudiante_periodo"])
    odd = fact.filter("id >= '900000' and length(id) = 6")
    one = rows(odd.filter("id = 900001").select(
        "periodo_codigo", "semestre_orden", "desertion_t1", "semestres_cursados_acum",
        "total_periodos_matriculados", "tasa_permanencia", "codigo_divipola",
        "total_accesos_res", "anio_corte_conectividad", "nivel_conectividad",
        "promedio_ipm_mpio", "poblacion_sisben_mpio"))
    shared = (6, 6 / 9, "76001", 201, 2023, 1, pytest.approx(0.3), 3)
    assert one == [
        ("periodo_1701", 1, 0, 1, *shared), ("periodo_1702", 1, 0, 1, *shared),
        ("periodo_1704", 2, 0, 2, *shared), ("periodo_2031", 3, 0, 3, *shared),
        ("periodo_2032", 3, 0, 3, *shared), ("periodo_2034", 4, None, 4, *shared)]
    two = rows(odd.filter("id = 900002").select("semestre_orden", "desertion_t1",
                                                "gap_desde_semestre_anterior", "codigo_divipola"))
    assert two == [(1, 1, None, "76520"), (3, 1, 2, "76001")]
    exported = odd.filter("id = 900006").first()
    assert (exported["periodo"], exported["semestre_orden"], exported["codigo_divipola"]) == (
        "2025", 4, "76001")
    checks = first["checks"]
    assert checks["rows_of_unknown_periods"] == 1 and 0.5 < checks["coverage"] < 1
    assert checks["prevalence"][4][1] is None and checks["prevalence"][1][0] == 404
    # a wrong region is saved by the unique name; an unknown place stays without
    rest = {r["id"]: (r["codigo_divipola"], r["nivel_conectividad"]) for r in odd.collect()}
    assert rest["900003"] == ("05001", 3) and rest["900004"] == (None, 0)
    assert fact.filter("periodo_codigo = 'periodo_0001'").count() == 0

    semester = spark.read.parquet(first["gold"]["fact_estudiante_semestre"])
    assert set(SEMESTER_COLUMNS) <= set(semester.columns)
    assert semester.select("id", "semestre_orden").distinct().count() == semester.count()
    picked = semester.filter("id = 900001 and semestre_orden = 1").first()
    assert (picked["cohorte_tipo"], picked["n_periodos_en_semestre"]) == ("principal", 2)


def test_published(spark, lake, first):
    manifest, tables, documents = read_published(spark, f"{lake}/web")
    assert manifest["model_version"] == first["run_id"] == manifest["publish_run_id"]
    assert {"riesgo_por_programa.csv", "importancia_variables.csv"} <= set(tables)
    assert "metricas_modelo.json" in documents
    assert not [n for n, df in tables.items() if "id" in df.columns]
    trend = rows(tables["desercion_por_semestre.csv"].select(
        "semestre_academico", "matriculados", "evaluables", "tasa_desercion_pct"))
    assert trend[-1][2:] == (0, None) and trend[0][1] == trend[0][2] == 404
    kpis = {k["id"]: k for k in documents["kpis.json"]}
    assert list(kpis) == ["tasa_desercion", "tasa_retencion", "matricula_ultimo_semestre",
                          "brecha_estrato", "brecha_conectividad", "riesgo_alto", "f1_modelo"]
    assert kpis["tasa_desercion"]["valor"] + kpis["tasa_retencion"]["valor"] == pytest.approx(100)
    assert kpis["matricula_ultimo_semestre"]["definicion"] == "Estudiantes únicos en 2025-2"
    assert kpis["brecha_estrato"]["valor"] < 0
    small = [n for n, df in tables.items()
             if "matriculados" in df.columns and df.filter("matriculados < 10").count()]
    assert small == []
    ranks = rows(tables["importancia_variables.csv"].select("ranking"), "ranking")
    assert ranks == [(i + 1,) for i in range(len(ranks))]


def test_published_without_a_model(spark, first, tmp_path):
    semester = spark.read.parquet(first["gold"]["fact_estudiante_semestre"])
    manifest = publish_dashboard(spark, semester, str(tmp_path), "r")
    assert manifest["files"] == sorted(f"data/{n}" for n in (
        "desercion_por_semestre.csv", "desercion_por_escuela.csv", "desercion_por_programa.csv",
        "desercion_demografia.csv", "mapa_departamento.csv", "kpis.json", "manifest.json"))
    assert manifest["model_version"] is None


def test_a_lake_with_exports_only_ends_after_silver(spark, lake, first, tmp_path):
    shutil.copytree(lake / "raw" / "exports", tmp_path / "raw" / "exports")
    tag = uuid.uuid4().hex
    out = run_flow(spark, str(tmp_path), SCHEMAS, f"silver_{tag}", f"gold_{tag}")
    assert out["missing"] == ["gobierno_sisben_iv", "gobierno_internet_fijo"]
    assert spark.read.parquet(f"{tmp_path}/silver/estudiantes").count() == 1


def test_a_lake_without_reports_runs_through(spark, lake, first, tmp_path):
    for name in ("estudiantes", "gobierno"):
        shutil.copytree(lake / "raw" / name, tmp_path / "raw" / name)
    (tmp_path / "raw" / "exports").mkdir()
    tag = uuid.uuid4().hex
    out = run_flow(spark, str(tmp_path), SCHEMAS, f"silver_{tag}", f"gold_{tag}")
    assert out["mirrored"] == ["dim_gold_gobierno_sisben", "dim_gold_gobierno_internet"]
    assert out["manifest"]["model_version"] is None
    args = (spark, str(tmp_path), SCHEMAS, f"silver_{tag}", f"gold_{tag}")
    assert run_flow(*args, incremental=True)["added"]["files"] == 0
    (tmp_path / "raw" / "estudiantes" / "estudiantes_periodo_2035.csv").write_text(
        "\n".join([HEADER, person(900010, "2035")]) + "\n")
    more = run_flow(*args, incremental=True)
    assert more["added"]["files"] == 1 and more["added"]["batch"] == 1
    assert more["manifest"]["publish_run_id"] == more["run_id"]
    fact = spark.table(f"gold_{tag}.fact_estudiante_periodo")
    assert fact.filter("id = 900010").count() == 1
    assert more["checks"]["rows_of_unknown_periods"] == 1
