import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import (
    band_by_cuts, canonical_place, cp1252_text, half_even, homologate, normalize_columns,
    normalize_name, pad_code, rate_pct, rename_map, risk_band, to_double)
from tidemark.plans.fixed import CREDIT_RULES


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, name", [
    ("  Año Académico (1) ", "ano_academico_1"), ("_silver_run_id", "silver_run_id"),
    ("MUNICIPIO", "municipio"), ("Tasa %  año", "tasa_ano"), ("a__b", "a__b"), ("ç", "")])
def test_normalize_name(raw, name):
    assert normalize_name(raw) == name


def test_clashing_names_are_an_error(spark):
    with pytest.raises(ValueError, match="same name"):
        normalize_columns(spark.createDataFrame([(1, 2)], "`Año` int, ano int"))


def test_rename_ignores_absent(spark):
    df = rename_map(spark.createDataFrame([(1,)], "h_5 int"), {"h_5": "ipm", "i1": "x"})
    assert df.columns == ["ipm"]


@pytest.mark.parametrize("raw, place", [
    ("Bogotá, D.C.", "BOGOTA"), ("Güicán", "GUICAN"), ("ÖPERA", "PERA"),
    (" Cali (Valle del Cauca) ", "CALI"), ("Distrito de Santa Marta", "DE SANTA MARTA"),
    ("Peñol-Norte", "PENOL NORTE"), ("", ""), (None, None)])
def test_canonical_place(spark, raw, place):
    assert one(spark, raw, "string", canonical_place) == place


@pytest.mark.parametrize("raw, code", [("5001", "05001"), ("05001", "05001"), (" 7 ", "00007"),
                                       ("123456", "12345"), (None, None)])
def test_pad_code(spark, raw, code):
    assert one(spark, raw, "string", pad_code) == code


@pytest.mark.parametrize("raw, label", [
    ("No recibió", "No recibio credito"), ("Crédito Largo", "Largo plazo"),
    ("Mediano y Largo", "Largo plazo"), ("Mediano", "Mediano plazo"), ("Corto", "Corto")])
def test_homologate_first_rule_wins(spark, raw, label):
    assert one(spark, raw, "string", lambda c: homologate(c, CREDIT_RULES)) == label


def test_cp1252_equals_python(spark):
    data = bytes(range(0x20, 0x100))
    assert one(spark, bytearray(data), "binary", cp1252_text) == data.decode("cp1252", "replace")


def test_bad_numbers_are_null(spark):
    got = [one(spark, x, "string", to_double) for x in ("1.5", "x", "", None, " 7 ")]
    assert got == [1.5, None, None, None, 7.0]


def test_half_even_equals_numpy(spark):
    values = [float(x) for x in np.random.default_rng(3).integers(-10**6, 10**6, 3000) / 1000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(half_even(F.col("v"), 2)).collect()]
    assert got == [float(x) for x in np.round(np.array(values), 2)]


def test_bands(spark):
    cuts = F.array(F.lit(10), F.lit(20))
    assert [one(spark, x, "int", lambda c: band_by_cuts(c, cuts))
            for x in (0, 5, 10, 19, 20, None)] == [0, 1, 2, 2, 3, 3]
    assert [one(spark, x, "double", lambda c: risk_band(c, 0.6))
            for x in (0.6, 0.59, 0.3, 0.29)] == ["alto", "medio", "medio", "bajo"]


def test_rate_of_empty_whole_is_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 3)], "a int, b int")
    assert rows(df.select(rate_pct(F.col("a"), F.col("b")))) == [(33.33,), (None,)]
