"""Scans of the source files: every column a string, markers of missing values null."""

from __future__ import annotations

import csv
import io
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Texts that stand for a missing value in a CSV file.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Names a fee file may give its columns.
FEE_ALIASES = {
    "issn": ("issn", "issn_l", "issn_print", "issn_electronic", "eissn"), "amount": ("euro", "amount", "apc", "cost", "price"), "currency": ("currency", "moneda"),
    "title": ("journal_full_title", "journal", "title", "journal_title"), "publisher": ("publisher", "editorial"), "hybrid": ("is_hybrid", "hybrid"),
}


def head(spark: SparkSession, path: str, size: int = 4096) -> str:
    """The beginning of the first file under path, read through Spark, so any store works."""
    files = spark.read.format("binaryFile").load(path).select("path", F.decode(F.substring("content", 1, size), "UTF-8").alias("head"))
    row = files.orderBy("path").first()
    if row is None:
        raise ValueError(f"nothing to read in {path}")
    return row["head"].lstrip("﻿")


def sniff(text: str, allowed: str = ",;\t|") -> str:
    """The delimiter of a file's beginning; markup and empty files are refused."""
    if not text.strip():
        raise ValueError("the file is empty")
    if re.match(r"\s*<(!doctype|html|\?xml)", text, re.I):
        raise ValueError("the file is markup, not a table")
    line = re.sub('"[^"]*"', "", text.lstrip()).splitlines()[0]  # what is quoted delimits nothing
    return max(allowed, key=lambda c: (line.count(c), -allowed.index(c)))


def nulls(df: DataFrame, trim: bool = True) -> DataFrame:
    """Strings trimmed, and missing ones null."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    value = lambda c: F.trim(F.col(f"`{c}`")) if trim else F.col(f"`{c}`")
    return df.select(*(F.when(~value(c).isin(*MISSING), value(c)).alias(c) if c in text else F.col(f"`{c}`") for c in df.columns))


def read_csv(spark: SparkSession, path: str, sep: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A CSV file with header. Without sep it is sniffed. columns: those wanted; missing ones are null, of repeated names the first counts."""
    sep = sep or sniff(head(spark, path))
    df = spark.read.csv(path, header=True, sep=sep, multiLine=True, quote='"', escape='"', mode="PERMISSIVE", encoding="UTF-8")
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    out = nulls(df)
    return out if columns is None else out.select(*(F.col(f"`{c}`") if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns))


def read_csv_repaired(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV file whose line ends are mixed: each file is read whole, repaired and parsed by rows."""
    whole = spark.read.format("binaryFile").load(path).select(F.decode("content", "UTF-8").alias("t"))
    fixed = whole.select(F.regexp_replace("t", "\r+\n", "\n").alias("t"))
    names = next(csv.reader(io.StringIO(re.sub("\r+\n", "\n", head(spark, path, 1 << 16))), delimiter=sep))

    def rows(batches):
        import pandas as pd

        for b in batches:
            found = [r for t in b["t"] for r in list(csv.reader(io.StringIO(t.lstrip("﻿")), delimiter=sep))[1:] if r]
            yield pd.DataFrame([(r + [None] * len(names))[: len(names)] for r in found], columns=names)

    return nulls(fixed.mapInPandas(rows, StructType([StructField(n, StringType()) for n in names])))


def find_column(columns: list[str], aliases: tuple[str, ...]) -> str | None:
    """The column that the first matching alias names, case aside."""
    by_name = {c.strip().lower(): c for c in reversed(columns)}
    return next((by_name[a] for a in aliases if a in by_name), None)


def read_fees(spark: SparkSession, path: str) -> DataFrame:
    """A fee file under the names of FEE_ALIASES; a column that it hasn't is null, one without numbers or amounts is refused."""
    df = read_csv(spark, path)
    found = {name: find_column(df.columns, aliases) for name, aliases in FEE_ALIASES.items()}
    if not found["issn"] or not found["amount"]:
        raise ValueError(f"{path} lacks an ISSN or an amount")
    return df.select(*((F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(n) for n, c in found.items()))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, CSV or JSON by the suffix."""
    if path.endswith(".csv"):
        return read_csv(spark, path)
    if path.endswith(".json"):
        return spark.read.json(path, multiLine=True)
    return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, or an empty one of that schema if there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.parquet(path) if there else spark.createDataFrame([], schema)


def read_upload(spark: SparkSession, path: str, required: str = "Nombre", most: int = 5000) -> DataFrame:
    """A user's CSV file of at most 5000 rows with a required column."""
    df = read_csv(spark, path, sniff(head(spark, path), ",;\t"))
    if required not in df.columns:
        raise ValueError(f"the file needs a column {required}")
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows")
    return df


def validate(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256, lines, header, problem) of every file under path; problem is null if there is none."""
    files = spark.read.format("binaryFile").load(path)
    text = F.decode("content", "UTF-8")
    start = F.lower(F.substring(text, 1, 500))
    problem = F.when(start.rlike(r"^\s*<(!doctype|html|\?xml)"), "markup").when(F.col("length") < 100, "short")
    header = F.get(F.split(text, "\r?\n"), F.lit(0))
    lines = F.greatest(F.regexp_count(text, F.lit("\n")) - 1, F.lit(0))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), lines.alias("lines"), header.alias("header"), problem.alias("problem"))
