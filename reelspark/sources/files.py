"""CSV datasets and whole-text documents."""

from __future__ import annotations

import csv
import io
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.contracts import EXPECTED_TYPES, ORDINAL, raw_schema
from reelspark.operators.spread import few_join, stored
from reelspark.sources import csv_records

_BEYOND, _LONGER = "beyond", "_longer"

# Texts that stand for a missing value in a CSV file.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


@dataclass(frozen=True)
class Landed:
    """A CSV dataset, parsed once and stored.

    ``rows`` has the contract columns by name, null where the file lacks one;
    ``arrived`` has the columns of the file's header, for the drift check, a repeated
    name with the number of its repetition; ``rejected`` has the text of records that
    are longer than the header and of lines whose quotes are not closed. Shorter
    records stay, with nulls at their end.
    """

    rows: DataFrame
    arrived: DataFrame
    rejected: DataFrame


def header_names(record: str) -> list[str]:
    """The column names of a header record, told apart without regard to case."""
    found, seen = next(csv.reader(io.StringIO(record)), []), set()
    names = []
    for place, name in enumerate(found):
        name = own = name.strip() or f"Unnamed: {place}"
        again = 0
        while own.lower() in seen:
            again += 1
            own = f"{name}.{again}"
        seen.add(own.lower())
        names.append(own)
    return names


def _parsed(spark: SparkSession, path: str, multi_line: bool) -> tuple[DataFrame | None, DataFrame]:
    """The records that fit the header, under its names and with their place (None
    without a header), and the rejected ones."""
    lines = csv_records.read_lines(spark, path)
    if multi_line:
        records, faults = csv_records.cut(lines)
    else:
        odd = F.regexp_count("value", F.lit('"')) % 2 == 1
        records, faults = lines.where(~odd), lines.where(odd)
    records = records.where(F.length("value") > 0)
    first = records.groupBy("_file").agg(F.min_by("value", ORDINAL).alias("value"), F.min(ORDINAL).alias("at"))
    headers = [r[0] for r in first.select("value").distinct().limit(2).collect()]
    faults = faults.select(ORDINAL, F.col("value").alias("record"))
    if not headers:
        return None, faults
    if len(headers) > 1:
        raise ValueError(f"files of {path} differ in their header: {headers}")
    header = header_names(headers[0])
    places = [f"c{i}" for i in range(len(header))]
    fields = ", ".join(f"{c} string" for c in [*places, _BEYOND])
    body = few_join(records, stored(first.select(F.col("at").alias(ORDINAL))), [ORDINAL], "left_anti")
    parsed = stored(body.select(ORDINAL, "value", F.from_csv("value", F.lit(fields), {"escape": '"'}).alias("_r")).select(
        ORDINAL, F.when(F.col(f"_r.{_BEYOND}").isNotNull(), F.col("value")).alias(_LONGER), *(F.col(f"_r.{c}") for c in places)
    ))
    named = (F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)).alias(h) for h, c in zip(header, places))
    longer = parsed.where(F.col(_LONGER).isNotNull()).select(ORDINAL, F.col(_LONGER).alias("record"))
    return parsed.where(F.col(_LONGER).isNull()).select(*named, ORDINAL), longer.union(faults)


def land_csv(spark: SparkSession, path: str, dataset: str, multi_line: bool = True) -> Landed:
    """Parse the files of a dataset by their header and store them with their order.

    All files of a path need the same header; another one raises. Large files are read
    by many tasks. With ``multi_line`` a quoted field may hold line breaks; without it
    every line with an odd number of quotes is rejected.
    """
    fit, rejected = _parsed(spark, path, multi_line)
    if fit is None:
        nothing = _with_no_rows(spark, dataset)
        return Landed(nothing, nothing.select(ORDINAL), rejected)
    wanted = [F.col(c) if c in fit.columns else F.lit(None).cast("string").alias(c) for c in EXPECTED_TYPES[dataset]]
    return Landed(fit.select(*wanted, ORDINAL), fit, rejected)


def _with_no_rows(spark: SparkSession, dataset: str) -> DataFrame:
    return spark.createDataFrame([], raw_schema(dataset).add(ORDINAL, T.LongType()))


#: Types that a column of text is tried for, narrowest first.
INFERRED = ("int", "bigint", "double", "boolean", "date", "timestamp_ntz")


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files, quoted and with missing values as ``land_csv`` reads
    them, each column with the narrowest type that all its values have. Dates are
    ``yyyy-MM-dd`` and nothing else, as a cast would also take a year alone."""
    fit, _ = _parsed(spark, path, True)
    if fit is None:
        raise ValueError(f"{path} has no header")
    fit = fit.drop(ORDINAL)
    names = [f"`{c.replace('`', '``')}`" for c in fit.columns]
    shape = {"date": r"^\d{4}-\d\d-\d\d$", "timestamp_ntz": r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d"}

    def holds(name: str, kind: str):
        good = F.col(name).try_cast(kind).isNotNull()
        return good & F.col(name).rlike(shape[kind]) if kind in shape else good

    tests = [F.count_if(F.col(n).isNotNull() & ~holds(n, k)) for n in names for k in INFERRED]
    faults = list(fit.agg(*(t.alias(f"t{i}") for i, t in enumerate(tests)), *(F.count(n) for n in names)).first())
    out = []
    for i, (name, title) in enumerate(zip(names, fit.columns)):
        own = faults[i * len(INFERRED) : (i + 1) * len(INFERRED)]
        kinds = [k for k, n in zip(INFERRED, own) if n == 0] if faults[len(tests) + i] else []
        out.append(F.col(name).cast(kinds[0] if kinds else "string").alias(title))
    return fit.select(*out)


def land_datasets(spark: SparkSession, folder: str, multi_line: bool = True) -> dict[str, Landed]:
    """The four standard datasets by name, from ``<folder>/<name>.csv``."""
    root = folder.rstrip("/")
    return {name: land_csv(spark, f"{root}/{name}.csv", name, multi_line) for name in EXPECTED_TYPES}


def load_datasets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The contract columns of the four standard datasets."""
    return {name: landed.rows for name, landed in land_datasets(spark, folder).items()}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files as documents named by their path below the folder that is read."""
    plain = re.split(r"[*?\[{]", re.sub(r"^\w+:/*", "/", path))[0]
    root = plain if plain == path.rstrip("/") else plain.rpartition("/")[0]
    file = F.col("_metadata.file_path")
    below = F.regexp_replace(F.substring_index(file, f"{root.rstrip('/')}/", -1), "^/", "")
    return (
        spark.read.text(path, wholetext=True)
        .select(below.alias("doc_id"), F.col("value").alias("text"))
        .withColumn("source", F.col("doc_id"))
    )
