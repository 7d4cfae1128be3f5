import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans.silver import credit_table, students_from_exports, students_table
from tidemark.session import scratch, settle, shared_dir
from tidemark.sources import (
    clean_export, export_audit, files_by_stem, page_audit, publish, read_delimited, read_pages,
    read_published, read_report, require_same_version, route_datasets, write_gold, write_silver)
from tidemark.sources.reports import usable_exports

HEAD = "Universidad; informe\nEstudiantes del periodo 2024 Ñ PERIODO 16-01 (pregrado)\n\n"
BODY = '"ID"; "Edad";Sexo;programa\n1;20;F;"Ing; civil"\n\n2;31;M;Física\n'
FILL = "x" * 256 + "\n"


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_clean_export(spark, tmp_path):
    put(tmp_path / "e_1701.csv", FILL + HEAD + BODY)
    put(tmp_path / "e_1702.csv", FILL + HEAD.replace("16-01", "16-02") + BODY.replace("\n", "\r\n"),
        "cp1252")
    put(tmp_path / "e_1703.csv", FILL + "sin etiqueta\n" + BODY + "€;1;M;z\n", "cp1252")
    out = clean_export(spark, str(tmp_path))
    assert out.columns == ["periodo", "ID", "Edad", "Sexo", "programa"]
    label = "2024 Ñ PERIODO 16-0"
    assert rows(out) == sorted(
        [(label + n, "1", "20", "F", "Ing; civil") for n in "12"]
        + [(label + n, "2", "31", "M", "Física") for n in "12"]
        + [("e_1703", "1", "20", "F", "Ing; civil"), ("e_1703", "2", "31", "M", "Física"),
           ("e_1703", "€", "1", "M", "z")], key=repr)


def test_unusable_exports_are_reported_and_stop_the_landing(spark, tmp_path):
    put(tmp_path / "in" / "ok.csv", FILL + HEAD + BODY)
    put(tmp_path / "in" / "short.csv", HEAD + "id;edad;sexo\n")
    put(tmp_path / "in" / "refused.csv", FILL + "No es posible iniciar el sistema\n")
    put(tmp_path / "in" / "headless.csv", FILL + HEAD)
    audit = export_audit(spark, str(tmp_path / "in"))
    got = {r["file"].rsplit("/", 1)[1]: r["status"] for r in audit.collect()}
    assert got == {"ok.csv": "ok", "short.csv": "too_short", "refused.csv": "refused",
                   "headless.csv": "no_header"}
    usable, rejects = usable_exports(spark, str(tmp_path / "in"))
    assert usable.count() == 2 and rejects.count() == 3
    with pytest.raises(ValueError, match="unusable export.*headless.*no_header"):
        clean_export(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError, match="unusable export"):
        students_from_exports(spark, str(tmp_path / "in"))


def test_students_from_exports(spark, tmp_path):
    put(tmp_path / "estudiantes_periodo_1704.csv", FILL + HEAD + BODY)
    got = students_from_exports(spark, str(tmp_path)).select("ID", "periodo", "periodo_codigo")
    assert rows(got) == [(i, "2024 Ñ PERIODO 16-01", "periodo_1704") for i in "12"]


def test_export_layouts_may_differ(spark, tmp_path):
    put(tmp_path / "a.csv", FILL + HEAD + "id;edad;sexo\n1;2;F\n")
    put(tmp_path / "b.csv", FILL + HEAD + "sexo;id;edad;extra\nM;3;4;z\n")
    out = clean_export(spark, str(tmp_path)).select("id", "edad", "sexo", "extra")
    assert rows(out) == [("1", "2", "F", None), ("3", "4", "M", "z")]


def test_rows_longer_than_the_header_stop_the_read(spark, tmp_path):
    put(tmp_path / "e" / "a.csv", FILL + HEAD + "id;edad;sexo\n1;2;F;9\n")
    put(tmp_path / "e" / "b.csv", FILL + HEAD + "id;edad;sexo;extra\n1;2;F;9\n")
    with pytest.raises(Exception, match="more cells than its header in .*a.csv"):
        clean_export(spark, str(tmp_path / "e")).collect()
    put(tmp_path / "d" / "a.csv", "id;edad\n1;2;3\n")
    with pytest.raises(Exception, match="more cells than its header in .*a.csv"):
        read_delimited(spark, str(tmp_path / "d")).collect()


def test_files_of_different_columns_unite_by_name(spark, tmp_path):
    put(tmp_path / "a.csv", "id;edad;sexo\n1;20;F\n")
    put(tmp_path / "b.csv", "id;sexo;edad\n2;M;30\n")
    put(tmp_path / "c.csv", 'sexo;id;"programa"\nF;3;"Ing; civil"\n')
    put(tmp_path / "d.csv", "id\n4\n")
    out = read_delimited(spark, f"{tmp_path}/*.csv")
    assert out.columns == ["id", "sexo", "edad", "programa"]
    assert rows(out) == [("1", "F", "20", None), ("2", "M", "30", None),
                         ("3", "F", None, "Ing; civil"), ("4", None, None, None)]
    put(tmp_path / "e.csv", "id;id\n1;2\n")
    with pytest.raises(ValueError, match="twice in .*e.csv"):
        read_delimited(spark, f"{tmp_path}/*.csv")


def test_a_report_without_its_header_line_is_named(spark, tmp_path):
    put(tmp_path / "a.csv", "1\n2\n3\n4\n5\nCodigo\n7\n")
    put(tmp_path / "b.csv", "1\n2\n")
    with pytest.raises(ValueError, match="no header on line 5 in .*b.csv"):
        read_report(spark, str(tmp_path))


def test_report(spark, tmp_path):
    top = "Informe\n\nGraduados\nCorte 2023\n\n"
    put(tmp_path / "a.csv", top + "Código;Año Grado;Total\n1;2023;\n;;\n2;;9\n")
    put(tmp_path / "b.csv", top + "Código;Año Grado;Total\n3;2020;7\n")
    assert rows(read_report(spark, str(tmp_path))) == [
        ("1", "2023", ""), ("2", "", "9"), ("3", "2020", "7")]
    assert read_report(spark, str(tmp_path)).columns == ["codigo", "ano_grado", "total"]


def test_students_take_the_period_from_the_file_name(spark, tmp_path):
    put(tmp_path / "estudiantes_periodo_1701.csv", "id;edad\n1;20\n")
    put(tmp_path / "estudiantes_periodo_1702.csv", "id;edad\n1;21\n2;x\n")
    got = students_table(spark, f"{tmp_path}/*.csv").select("id", "edad", "periodo_codigo")
    assert rows(got) == [("1", "20", "periodo_1701"), ("1", "21", "periodo_1702"),
                         ("2", "x", "periodo_1702")]


def test_files_by_stem(spark, tmp_path):
    for name in ("b.csv", "a x.csv", "c.txt"):
        put(tmp_path / name, "x\n1\n")
    assert list(files_by_stem(spark, str(tmp_path))) == ["a x", "b"]


def test_wide_credit_report(spark, tmp_path):
    path = tmp_path / "credito.csv"
    path.write_bytes("Tipo Crédito;2020-1;2020-2\nNo recibió;5;\nLargo plazo x;7;8\nMalo ".encode()
                     + b"\xff;1;2\n")
    got = credit_table(spark, str(path))
    assert got.columns == ["tipo_credito", "periodo_academico", "valor_str"]
    assert rows(got) == [
        ("Largo plazo", "2020-1", "7"), ("Largo plazo", "2020-2", "8"),
        ("Malo �", "2020-1", "1"), ("Malo �", "2020-2", "2"),
        ("No recibio credito", "2020-1", "5"), ("No recibio credito", "2020-2", None)]


def test_routing_and_pages(spark, tmp_path):
    put(tmp_path / "hq2v-5umk_part-0000000.json", json.dumps([{"a": "1"}, {"a": "2"}]))
    put(tmp_path / "hq2v-5umk_part-0000001.json", json.dumps([{"a": "3"}], indent=1))
    put(tmp_path / "hq2v-5umk_part-0000002.json", "[]")
    put(tmp_path / "dataset_n48w-gutb.json", json.dumps([{"b": "x"}]))
    put(tmp_path / "zzzz-zzzz.json", "this is not json")
    got = route_datasets(spark, str(tmp_path), {"gobierno_sisben_iv": "a string",
                                                "gobierno_internet_fijo": "b string"})
    assert {k: rows(v) for k, v in got.items()} == {
        "gobierno_sisben_iv": [("1",), ("2",), ("3",)], "gobierno_internet_fijo": [("x",)]}
    pages = read_pages(spark, f"{tmp_path}/hq2v*.json", "a string")
    audit = page_audit(pages).select("dataset", "n_records")
    assert rows(audit) == [("hq2v-5umk", 1), ("hq2v-5umk", 2)]


def test_partitioned_gold_prunes(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4 + 2020).cast("int").alias("anio"))
    write_gold(df, str(tmp_path / "g"), "r", ["anio"])
    back = spark.read.parquet(str(tmp_path / "g")).filter("anio = 2021")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan and back.count() == 25


def test_silver_is_overwritten(spark, tmp_path):
    for n in (5, 3):
        write_silver(spark.range(n).withColumnRenamed("id", "Nº Id"), str(tmp_path / "s"), 2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.columns == ["n_id"] and back.count() == 3


def test_publication_refuses_entities_and_trusts_the_manifest(spark, tmp_path):
    root = str(tmp_path / "web")
    assert read_published(spark, root) is None
    with pytest.raises(ValueError, match="entity columns"):
        publish(spark, root, {"x.csv": spark.range(2)}, {}, {})
    assert read_published(spark, root) is None
    publish(spark, root, {"x.csv": spark.range(2).toDF("n")}, {"k.json": [1, {"á": None}]},
            {"publish_run_id": "r"})
    put(tmp_path / "web" / "data" / "stray.csv", "a\n1\n")
    manifest, tables, documents = read_published(spark, root)
    assert manifest["files"] == ["data/k.json", "data/manifest.json", "data/x.csv"]
    assert list(tables) == ["x.csv"] and documents == {"k.json": [1, {"á": None}]}


def test_version_guard():
    require_same_version("4.1.2", "4.1.2")
    with pytest.raises(RuntimeError, match="train again"):
        require_same_version("4.0.0", "4.1.2")


def test_shared_folder_where_none_is_named():
    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                               sparkContext=SimpleNamespace(master=master, applicationId="app-1"))

    folder = shared_dir(session("local[2]"))
    assert folder == "/tmp/tidemark-shared" == shared_dir(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_scratch_tables_are_deleted(spark):
    with scratch(spark):
        inside = settle(spark.range(3)).inputFiles()[0].removeprefix("file://")
        assert os.path.exists(inside)
    assert not os.path.exists(inside)
    assert settle(spark.range(3)).count() == 3


def test_settled_tables_go_to_the_named_folder(spark):
    df = settle(spark.range(3))
    files = df.inputFiles()
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert all(shared_dir(spark) in f for f in files)
    assert named is None or shared_dir(spark) == named.rstrip("/")


def test_header_cells_are_cut_like_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;"a;b"; "say ""hi""" ;c\n1;2;3;4\n')
    got = read_delimited(spark, str(tmp_path / "*.csv"))
    assert got.columns == ["id", "a;b", 'say "hi"', "c"]
    assert rows(got) == [("1", "2", "3", "4")]


def test_only_the_line_at_the_headers_place_is_dropped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\nid;v\nid;v\n1;2\nid;v\n  \n")
    (tmp_path / "b [x] 1.csv").write_text("v;id\nv;id\n")
    got = read_delimited(spark, str(tmp_path / "*.csv"), file_column="f")
    assert rows(got.select("id", "v")) == [("1", "2"), ("id", "v"), ("id", "v"), ("id", "v")]
    assert rows(got.select("v").distinct()) == [("2",), ("v",)]


def test_one_layout_reads_the_asked_columns_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b;c\n1;2;3\n")
    plan = read_delimited(spark, str(tmp_path / "a.csv")).select("b")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in text and "c0" not in text.split("ReadSchema")[1]


def test_datasets_at_any_depth(spark, tmp_path):
    for place in ("hq2v-5umk.json", "2025-01/dataset_hq2v-5umk_part-0002.json",
                  "2025/02/hq2v-5umk.json/part-0.json", "other.json", "x/n48w-gutb.json"):
        file = tmp_path / "gov" / place
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text('[{"a": "%s"}]' % place)
    for schemas in ({"gobierno_sisben_iv": "a string"}, {}):
        routed = route_datasets(spark, str(tmp_path / "gov"), schemas)
        assert sorted(routed) == ["gobierno_internet_fijo", "gobierno_sisben_iv"]
        assert routed["gobierno_sisben_iv"].count() == 3


def test_period_files_and_exports_with_other_columns_are_united(spark, tmp_path):
    from tidemark.plans.silver import raw_to_silver
    raw = tmp_path / "raw"
    (raw / "estudiantes").mkdir(parents=True)
    (raw / "exports").mkdir()
    (raw / "estudiantes" / "estudiantes_periodo_1701.csv").write_text("Id;Extra\n1;x\n")
    (raw / "exports" / "estudiantes_periodo_1702.csv").write_text(
        "Informe " + "." * 300 + "\nEstudiantes del periodo 2025 (x)\n\nId;Edad;Sexo\n2;30;F\n")
    assert raw_to_silver(spark, str(raw), str(tmp_path / "silver"), "r", {}) == ["estudiantes"]
    got = spark.read.parquet(str(tmp_path / "silver" / "estudiantes"))
    assert rows(got.select("id", "extra", "edad")) == [("1", "x", None), ("2", None, "30")]


def test_audit_reads_the_dataset_id_once_per_file(spark):
    pages = spark.createDataFrame(
        [("/a/2025/dataset_n48w-gutb.json",)] * 3 + [("/a/hq2v-5umk_part-0000001.json",)]
        + [("/a/b/x.json/part-00000-1.txt",)] * 2 + [("/a.json/b/part-0",)], "file_path string")
    audit = page_audit(pages)
    assert rows(audit.select("dataset", "n_records")) == [
        ("", 1), ("hq2v-5umk", 1), ("n48w-gutb", 3), ("x", 2)]
    plan = audit._jdf.queryExecution().optimizedPlan().toString()
    keys = plan[plan.index("Aggregate ["):].split("], [")[0]
    assert "file_path" in keys and "regexp_extract" not in keys
