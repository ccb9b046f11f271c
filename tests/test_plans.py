import json

import pytest
from pyspark.sql import functions as F

from inkwell.plans import medallion, recommend
from inkwell.sources import readers, sinks
from inkwell.streaming import catalogue_stream


def write(folder, name, text, mode="w"):
    path = folder / name
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return path.as_uri()


def test_sources(spark, tmp_path):
    path = write(tmp_path, "a.csv", "x;y\n 1 ;NA\n2;b\n")
    assert [tuple(r) for r in readers.read_csv(spark, path).collect()] == [("1", None), ("2", "b")]
    fees = write(tmp_path, "f.csv", "ISSN,Euro,Journal_Full_Title\n0124-5376,\"1,000\",T\n")
    assert readers.read_fees(spark, fees).first()["amount"] == "1,000"
    broken = write(tmp_path, "d.csv", "a,b\r\r\n1,2\r\r\n3,\"x\ny\"\n")
    assert sorted(tuple(r) for r in readers.read_csv_repaired(spark, broken).collect()) == [("1", "2"), ("3", "x\ny")]
    with pytest.raises(ValueError, match="markup"):
        readers.read_csv(spark, write(tmp_path, "h.csv", "<!DOCTYPE html><html></html>"))
    with pytest.raises(ValueError, match="Nombre"):
        readers.read_upload(spark, path)
    report = {r["file"]: r["problem"] for r in readers.validate(spark, tmp_path.as_uri() + "/*.csv").collect()}
    assert report["h.csv"] == "markup" and report["a.csv"] == "short"
    assert readers.read_or_empty(spark, (tmp_path / "none").as_uri(), spark.range(1).schema).count() == 0
    sinks.write_table(spark.range(3), (tmp_path / "t.csv").as_uri())
    assert readers.read_table(spark, (tmp_path / "t.csv").as_uri()).count() == 3
    assert json.loads(sinks.report(spark.range(3).agg(F.count("*").alias("n")))) == {"n": 3}


@pytest.mark.parametrize("scorer", ["wratio", "jaccard"])
def test_medallion(spark, scorer):
    national = spark.createDataFrame(
        [(0, "0124-5376", None, None, "Revista de Biotecnología Aplicada", "2020", "B"), (1, "0124-5376", None, None, "Revista de Biotecnología Aplicada", "2022", "A1"), (2, "2539-200X", None, None, "Salud Pública Andina", "2021", "C"), (3, None, None, None, "Sin número", "2021", "C")],
        "row_idx long, TXT_ISSN_P string, TXT_ISSN_E string, TXT_ISSN_L string, NME_REVISTA_IN string, NRO_ANO string, ID_CLAS_REV string",
    ).withColumns({c: F.lit(v) for c, v in (("PAIS_REV_IN", "Colombia"), ("NME_ESPECIALIDAD", "x"), ("NME_AREA", "y"), ("NME_GRAN_AREA", "z"), ("NME_INST_EDIT_1", "U"), ("ID_REVISTA_P", "1"))})
    silver = medallion.silver_national(national)
    assert sorted(r["anio_clasificacion"] for r in silver.collect()) == [2021, 2022]
    payments = spark.createDataFrame([(0, "01245376", "1.000,00", "EUR", "x", "p", "TRUE"), (1, "99999999", "500", "USD", "Salud Publica Andina", "p", "no")], "row_idx long, issn string, amount string, currency string, title string, publisher string, hybrid string")
    out = medallion.gold(silver, {"openapc": medallion.silver_payments(payments)}, scorer, captured="2026-01-01")
    rows = {r["issn_normalizado"]: r for r in out.catalogue.collect()}
    assert rows["0124-5376"]["apc_monto_usd"] == 1080.0 and rows["0124-5376"]["_fuentes"] == ["openapc", "publindex"]
    assert rows["2539-200X"]["apc_monto_usd"] == 500.0 and len(rows["2539-200X"]["_hash_registro"]) == 16
    assert {r["tipo_cruce"] for r in out.merge_log.collect()} == {"issn", "titulo"}


def test_recommend_save_load(spark, tmp_path):
    journals = spark.createDataFrame([("a", "redes neuronal datos"), ("b", "celula planta suelo"), ("c", "historia arte")], "id string, text string")
    quality = spark.createDataFrame([("a", *[0.5] * 6), ("b", *[0.9] * 6), ("c", *[None] * 6)], "doc_id string, " + ", ".join(f"topsis_{i} double" for i in range(1, 7)))
    recommend.fit(journals, quality).save(str(tmp_path))
    model = recommend.Model.load(spark, str(tmp_path))
    manuscripts = spark.createDataFrame([(1, "Redes neuronales", "datos", None), (2, "qqqq", None, None)], "id long, title string, abstract string, keywords string")
    out = recommend.recommend(model, manuscripts, 3, weight=0.2)
    got = {(r["query_id"], r["rank"]): r["doc_id"] for r in out.collect()}
    assert got[1, 1] == "a" and got[1, 3] == "c" and got[2, 1] == "b"
    assert model.info().first()["journals"] == 3
    assert [r["doc_id"] for r in recommend.compare(model, "a", 2).collect()] == ["b", "c"]
    about = spark.createDataFrame([("a", "Revista A", 1.0), ("a", "Revista A, otra vez", 2.0), (None, "sin", 0.0)], "issn string, title string, score double")
    named = {(r["query_id"], r["doc_id"]): r["title"] for r in recommend.recommend(model, manuscripts, 3, weight=0.2, metadata=about).collect()}
    assert named[1, "a"] == "Revista A" and named[1, "b"] is None and len(named) == 6
    with pytest.raises(ValueError):
        recommend.recommend(model, manuscripts, 0)


def test_streams(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    assert catalogue_stream.sessions(events).agg(F.sum("n")).first()[0] == events.count()
    assert catalogue_stream.windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()
    source = tmp_path / "in"
    rows = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "key string, v int, at int")
    rows.write.parquet(str(source))
    stream = spark.readStream.schema(rows.schema).parquet(str(source))
    for _ in range(2):
        q = catalogue_stream.upsert_stream(stream, str(tmp_path / "out"), ["key"], str(tmp_path / "cp"), "at").trigger(availableNow=True).start()
        q.awaitTermination()
        spark.createDataFrame([("a", 5, 2)], rows.schema).write.mode("append").parquet(str(source))
    assert sorted((r["key"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out/v1")).collect()) == [("a", 5), ("b", 2)]
