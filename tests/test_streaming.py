from tests.conftest import rows
from tidemark.functions import normalize_columns
from tidemark.streaming import pick_up_new_files


def test_only_new_files_are_picked_up(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    args = (spark, source, target, mark, "`Año` string, id string")
    options = {"sep": ";", "header": "true"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Año;id\n2024;1\n2024;2\n")
    first = pick_up_new_files(*args, options=options, transform=normalize_columns)
    assert rows(first.select("ano", "id")) == [("2024", "1"), ("2024", "2")]
    (tmp_path / "in" / "b.csv").write_text("Año;id\n2025;3\n")
    second = pick_up_new_files(*args, options=options, transform=normalize_columns)
    assert rows(second.select("id", "batch")) == [("1", 0), ("2", 0), ("3", 1)]
    third = pick_up_new_files(*args, options=options, transform=normalize_columns)
    assert third.count() == 3


def test_nothing_to_pick_up_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = pick_up_new_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c", "a int")
    assert out.columns == ["a", "batch"] and out.count() == 0
