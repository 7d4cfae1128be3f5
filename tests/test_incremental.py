"""Landings of new period files give the facts of a full run."""

import json
import os
import shutil

import pytest

from tests.conftest import rows
from tests.test_flow import HEADER, SCHEMAS, person
from tidemark.plans import incremental
from tidemark.plans.gold import silver_to_gold
from tidemark.plans.incremental import FACTS, raw_files, refresh, silver_students, start_ledger
from tidemark.plans.silver import raw_to_silver
from tidemark.session import scratch, settle
from tidemark.sources import partitions
from tidemark.sources.partitions import apply_replacement, stage_kept, stage_rows


def put(lake, period, *people, header=HEADER):
    folder = lake / "raw" / "estudiantes"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"estudiantes_periodo_{period}.csv").write_text("\n".join([header, *people]) + "\n")


def full(spark, lake):
    files = settle(raw_files(spark, f"{lake}/raw"))
    raw_to_silver(spark, f"{lake}/raw", f"{lake}/silver", "full", SCHEMAS)
    silver_to_gold(spark, f"{lake}/silver", f"{lake}/gold", "full")
    start_ledger(spark, str(lake), files)


def facts(spark, lake):
    out = []
    for name in FACTS:
        df = spark.read.parquet(f"{lake}/gold/{name}")
        out.append(rows(df.select(*sorted(
            c for c in df.columns if "_run_id" not in c and "_processed_at" not in c
            and c != "source_file"))))
    return out


def files(lake):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(lake / "gold") for f in names if f.startswith("part-")}


def expected(spark, lake, tmp_path, name):
    other = tmp_path / name
    shutil.copytree(lake / "raw", other / "raw")
    full(spark, other)
    return facts(spark, other)


@pytest.fixture
def lake(spark, tmp_path):
    root = tmp_path / "lake"
    (root / "raw" / "gobierno").mkdir(parents=True)
    net = [{"municipio": "Cali", "departamento": "Valle del Cauca", "cod_municipio": "76001",
            "segmento": "RESIDENCIAL - ESTRATO 1", "anno": "2023", "trimestre": "1",
            "no_de_accesos": "100"}]
    (root / "raw" / "gobierno" / "n48w-gutb.json").write_text(json.dumps(net))
    (root / "raw" / "gobierno" / "hq2v-5umk.json").write_text(json.dumps(
        [{"cod_mpio": "76001", "h_5": "0.2", "i8": "1", "i15": "0", "zona": "1"}]))
    for period in ("1701", "1702", "1704", "2031"):
        put(root, period, *[person(i, period) for i in range(20)
                            if i % 4 or period in ("1701", "1702")])
    with scratch(spark):
        full(spark, root)
    return root


def test_landings_equal_a_full_run(spark, lake, tmp_path):
    with scratch(spark):
        before = files(lake)
        assert refresh(spark, str(lake), "r1") == {"files": 0, "batch": 0, "partitions": []}
        assert files(lake) == before

        # an additional file of a known semester: only its year is written
        put(lake, "2032", person(501, "2032"), person(502, "2032"), person(501, "2032"))
        out = refresh(spark, str(lake), "r2")
        assert (out["files"], out["batch"], len(out["partitions"])) == (1, 1, 1)
        now = files(lake)
        kept = {p for p in before if f"/anio={out['partitions'][0]}/" not in p}
        assert any("anio=" in p for p in kept) and all(now.get(p) == before[p] for p in kept)
        assert facts(spark, lake) == expected(spark, lake, tmp_path, "a")

        # a new last semester opens the targets of all who were in the last one
        put(lake, "2034", person(1, "2034"), person(501, "2034"))
        assert refresh(spark, str(lake), "r3")["batch"] == 2
        assert facts(spark, lake) == expected(spark, lake, tmp_path, "b")

        # changed files, from the full run and from a landing, replace their rows
        put(lake, "1702", person(3, "1702", age=40), person(700, "1702"))
        put(lake, "2034", person(2, "2034"))
        out = refresh(spark, str(lake), "r4")
        assert out["files"] == 2
        assert facts(spark, lake) == expected(spark, lake, tmp_path, "c")
        people = silver_students(spark, str(lake))
        assert people.filter("periodo_codigo = 'periodo_2034'").count() == 1
        assert refresh(spark, str(lake), "r5")["files"] == 0


def test_a_batch_that_stopped_is_finished(spark, lake, tmp_path, monkeypatch):
    put(lake, "2034", person(1, "2034"), person(600, "2034"))
    calls = []

    def stop_in_the_middle(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return apply(*args)
    with scratch(spark):
        apply = incremental.apply_replacement
        monkeypatch.setattr(incremental, "apply_replacement", stop_in_the_middle)
        with pytest.raises(RuntimeError, match="lost"):
            refresh(spark, str(lake), "r1")
        monkeypatch.undo()
        # another file has landed in the meantime
        put(lake, "2035", person(601, "2035"))
        assert refresh(spark, str(lake), "r2")["batch"] == 2
        assert facts(spark, lake) == expected(spark, lake, tmp_path, "a")
        assert not os.listdir(lake / "pending")


def test_what_needs_a_full_run(spark, lake):
    with scratch(spark):
        put(lake, "2032", "x 2032;801;20;F;1;new", header="periodo;Id;Edad;Sexo;Estrato Social;Nueva")
        assert refresh(spark, str(lake), "r") is None
        os.remove(lake / "raw" / "estudiantes" / "estudiantes_periodo_2032.csv")
        (lake / "raw" / "gobierno" / "n48w-gutb.json").write_text("[]")
        assert refresh(spark, str(lake), "r") is None
    assert refresh(spark, f"{lake}/nowhere", "r") is None


def test_duplicates_do_not_depend_on_how_a_period_is_cut_into_files(spark, lake):
    folder = lake / "raw" / "estudiantes" / "estudiantes_periodo_2032.csv"
    folder.mkdir()
    for part, age in (("part-0", 30), ("part-1", 20)):
        (folder / part).write_text(f"{HEADER}\n{person(501, '2032', age=age)}\n")
    with scratch(spark):
        assert refresh(spark, str(lake), "r1")["files"] == 2
        fact = spark.read.parquet(f"{lake}/gold/{FACTS[0]}").filter("id = '501'")
        assert [r["edad"] for r in fact.collect()] == ["20"]


def test_staged_partitions_are_moved_and_a_stop_in_between_is_finished(spark, tmp_path, monkeypatch):
    path, staged = str(tmp_path / "table"), str(tmp_path / "staged")
    schema = "id string, x int, anio int"
    spark.createDataFrame([("a", 1, 2023), ("a", 1, 2024), ("b", 1, 2025), ("c", 1, 2026)],
                          schema).write.partitionBy("anio").parquet(path)
    stage_rows(spark.createDataFrame([("a", 2, 2024), ("a", 2, 2025)], schema), "anio", staged)
    values = stage_kept(spark, path, spark.createDataFrame([("a",)], "id string"), "id", "anio",
                        staged)
    assert values == [2023, 2024, 2025]  # had rows, had and has, has
    ready = {f for _, _, names in os.walk(staged) for f in names if f.startswith("part-")}

    def stop_in_the_middle(spark, new, old):
        if "2025" in new:
            raise RuntimeError("lost")
        move(spark, new, old)
    move = partitions.replace_folder
    monkeypatch.setattr(partitions, "replace_folder", stop_in_the_middle)
    with pytest.raises(RuntimeError, match="lost"):
        apply_replacement(spark, path, staged, "anio", values)
    monkeypatch.undo()
    for _ in range(2):
        apply_replacement(spark, path, staged, "anio", values)
        assert rows(spark.read.parquet(path)) == [
            ("a", 2, 2024), ("a", 2, 2025), ("b", 1, 2025), ("c", 1, 2026)]
    now = {f for _, _, names in os.walk(path) for f in names if f.startswith("part-")}
    assert ready < now  # the files themselves, not a second copy of their rows
    assert not os.path.exists(f"{path}/anio=2023")
