"""Reading and writing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Texts that stand for a missing value in a CSV file.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
]
#: types that inference tries, narrowest first; what fits none is a string
KINDS = ("bigint", "double", "boolean")


def missing_as_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column, so that it counts as missing everywhere."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})


def read_csv(spark: SparkSession, path: str, schema: StructType | str, encoding: str = "ISO-8859-1") -> DataFrame:
    """CSV with a header, known types and a given encoding: one pass, no inference.

    NaN and, in columns that are not text, all marks of missing values are NULL.
    """
    return missing_as_null(spark.read.option("header", True).option("encoding", encoding).schema(schema).csv(path))


def read_csv_inferred(spark: SparkSession, path: str, overrides: dict[str, str] | None = None) -> DataFrame:
    """CSV with inferred types; a nameless leading column becomes ``index``.

    One pass over all rows finds the narrowest type that every value fits; marks of missing values are
    NULL and fit every type, and a column of nothing else is double.  ``overrides`` fixes the type of columns.
    """
    text = spark.read.option("header", True).csv(path)
    if text.columns[0] in ("_c0", "Unnamed: 0"):
        text = text.withColumnRenamed(text.columns[0], "index")
    col = lambda c: F.col(f"`{c}`")
    text = text.withColumns({c: F.when(~F.trim(col(c)).isin(MISSING), col(c)) for c in text.columns})
    asked = [c for c in text.columns if c not in (overrides or {})]
    kinds = dict(overrides or {})
    if asked:
        misfits = [F.count_if(col(c).isNotNull() & F.trim(col(c)).try_cast(k).isNull()).alias(f"{i}_{k}")
                   for i, c in enumerate(asked) for k in KINDS]
        held = [F.count(col(c)).alias(f"{i}_n") for i, c in enumerate(asked)]
        found = text.agg(*misfits, *held).first()
        for i, c in enumerate(asked):
            fits = [k for k in KINDS if found[f"{i}_{k}"] == 0]
            kinds[c] = (fits[0] if found[f"{i}_n"] else "double") if fits else "string"
    return missing_as_null(text.withColumns({c: F.trim(col(c)).cast(k) if k != "string" else col(c) for c, k in kinds.items()}))


def run_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run SQL text over named tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def largest_files(spark: SparkSession, directory: str, n: int = 10) -> DataFrame:
    """The n largest files below a directory; file contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory).select("path", "length")
    return files.orderBy(F.desc("length"), "path").limit(n)


def save_accepted(pairs: DataFrame, path: str) -> None:
    """JSON lines of accepted pairs, scores rounded to three places."""
    pairs.select(
        "id", "question", "sql", "tier", F.col("tables_used").alias("tables"), F.col("execution_rows").alias("exec_rows"),
        F.round("consistency_score", 3).alias("consistency"), F.round("quality_score", 3).alias("quality"),
    ).write.mode("overwrite").json(path)


def save_rejected(pairs: DataFrame, path: str) -> None:
    """JSON lines of rejected pairs with their reason, one folder per stage."""
    pairs.select("stage", "id", "question", "sql", "rejection_reason").write.mode("overwrite").partitionBy("stage").json(path)


def capped(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The first rows in key order: 1,000 for a result, 20 for a preview."""
    return df.orderBy(*keys).limit(rows)
