"""Golden values of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from inkwell.functions import catalogue, display, flags, identifiers, numbers, text
from inkwell.operators.similarity import partial_ratio, ratio, wratio


def value(spark, f, *args, kind="string"):
    df = spark.createDataFrame([args], ", ".join(f"c{i} {kind}" for i in range(len(args))))
    return df.select(f(*(F.col(c) for c in df.columns))).first()[0]


@pytest.mark.parametrize("raw, want", [("ISSN: 0124-5376", "0124-5376"), ("e-issn 2539200X", "2539-200X"), ("1234567", None), (None, None)])
def test_issn(spark, raw, want):
    assert value(spark, identifiers.issn, raw) == want
    if want:
        assert value(spark, identifiers.issn, want) == want


@pytest.mark.parametrize("raw, want", [("0124-5376", True), ("2539-200X", True), ("0124-5377", False), (None, False), ("abc", False)])
def test_issn_valid(spark, raw, want):
    def digits(s):
        n = s.replace("-", "")
        return sum((10 if c == "X" else int(c)) * (8 - k) for k, c in enumerate(n)) % 11 == 0

    want = digits(raw) if raw and raw != "abc" else False
    assert value(spark, identifiers.issn_valid, raw) == want


@pytest.mark.parametrize("raw, want", [("Revista Colombiana de Biotecnología!", "colombiana biotecnologia"), ("de la", None), (None, None), ("Ærø Straße", "aero strasse")])
def test_title(spark, raw, want):
    assert value(spark, text.normalize_title, raw) == want


@pytest.mark.parametrize("raw, want", [("0,914", 0.914), ("1.500,50", 1500.5), ("1,500.50", 1500.5), ("36,11", 36.11), ("1.500", 1.5), ("x", None), (None, None), (",914", 0.914)])
def test_locale_number(spark, raw, want):
    assert value(spark, numbers.locale_number, raw) == want


@pytest.mark.parametrize("raw, want", [("~USD 3990", 3990.0), ("~USD 2310 | CHF 1800", 2310.0), ("~USD 175-1450", 812.5), ("~USD 990–2000", 1495.0), ("CHF 1800", 2034.0), ("€ 1.500", 1620.0), ("Gratis", 0.0), ("~USD", None)])
def test_cost_text(spark, raw, want):
    assert value(spark, numbers.cost_text, raw) == want


@pytest.mark.parametrize("raw, want", [("3–6 meses", 19.6), ("2-4 semanas", 3.0), ("45 días", 6.4), ("continuo", None), ("12", None)])
def test_weeks(spark, raw, want):
    assert value(spark, numbers.weeks, raw) == want


def test_money(spark):
    df = spark.createDataFrame([(1000.0, "EUR", "CO")], "a double, c string, p string")
    usd, rate = numbers.to_usd(F.col("a"), F.col("c"))
    assert tuple(df.select(usd, rate, numbers.to_ppp(F.col("a"), F.col("p"))).first()) == (1080.0, 1.08, 2631.58)


def test_catalogue_values(spark):
    assert value(spark, catalogue.country_display, "UK / London") == "Reino Unido"
    assert value(spark, catalogue.access_type, "Acceso abierto híbrido") == "Híbrido"
    assert value(spark, catalogue.publisher, "Elsevier (Editorial Manager, APA)") == "Elsevier"
    assert value(spark, flags.quartile_in_text, "Q2/Q1") == "Q1"
    assert value(spark, identifiers.issn_find, "x 1234567x y") == "1234-567X"
    assert value(spark, catalogue.topics, "IEEE Sensors") == ["Redes de Sensores"]
    assert value(spark, catalogue.topics, "Zzz") == ["Ingeniería General"]
    assert value(spark, text.search_key, "  Revista  ÓPTICA ") == "revista optica"
    assert value(spark, catalogue.general, 12.5, kind="double") == "12.5"
    assert value(spark, catalogue.general, 12.0, kind="double") == "12"


def test_scientific_text(spark):
    assert value(spark, text.clean_scientific, r"La \textbf{célula} usa $x^2$ y {datos}--nuevos") == "la celula usa y datos nuevos"
    assert value(spark, text.stem, "studies") == "studi"
    assert value(spark, text.stem, "evaluated") == "evaluat"
    assert value(spark, text.preprocess, None) == ""
    assert value(spark, text.clean_keywords, "redes; datos. Introducción al tema") == "redes; datos"
    assert value(spark, text.repair_extracted, "bio-\n  logía  ﬁn\n\n\n\nx") == "biología fin\n\nx"


def test_similarity():
    assert wratio("a b", "a b") == 100.0
    assert wratio("applied physics", "journal applied physics") > 85
    assert ratio("abc", "") == 0.0 and ratio("", "") == 100.0
    assert partial_ratio("abc", "xxabcxx") == 100.0
    assert wratio("", "x") == 0.0
    # one shared word decides where lengths differ by half and more
    assert wratio("salud", "salud publica mundial") == pytest.approx(90.0)


def test_display(spark):
    df = spark.createDataFrame([(1234567.5, "x", None, 4.0), (None, "x", "~ USD ", 8.7), (None, None, "1 UVT", 26.07), (3.0, "sin_costo", None, None)], "usd double, status string, said string, weeks double")
    c = F.col
    assert [r[0] for r in df.select(display.fee(c("usd"), c("status"), c("said"))).collect()] == ["USD 1.234.568", "N/D", "1 UVT", "Sin costo"]
    assert [r[0] for r in df.select(display.duration(c("weeks"), F.lit(None).cast("string"))).collect()] == ["4 semanas", "~2 meses", "~6 meses", "N/D"]
    assert [r[0] for r in df.select(display.number(c("weeks"))).collect()] == ["4", "8.7", "26.1", "N/D"]
    assert [r[0] for r in df.select(display.percent(c("weeks") / 8)).collect()] == [50.0, 100.0, 100.0, 0.0]
    row = df.limit(1).select(display.score(F.lit(0.5)), display.issn_label(F.lit(None).cast("string"), F.lit("0124-5376")), display.origin(F.lit("etl")), display.origin(F.lit("z"))).first()
    assert list(row) == ["0.500", "ISSN-E 0124-5376 · ISSN-P N/D", "Publindex / ETL", "z"]
