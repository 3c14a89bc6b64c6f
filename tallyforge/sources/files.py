"""Headered CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes inside a field are doubled and blanks kept. An empty field is NULL: that is how feeds are delivered.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# In exact files NULL is this mark, so that an empty field is empty text; text that starts with a backslash gets another.
NULL_MARK = "\\N"


def _text_columns(schema: T.StructType, change) -> list[Column]:
    columns = [F.col("`" + f.name.replace("`", "``") + "`") for f in schema.fields]
    return [
        change(c).alias(f.name) if isinstance(f.dataType, T.StringType) else c
        for c, f in zip(columns, schema.fields, strict=True)
    ]


def _marked(text: Column) -> Column:
    return F.when(text.startswith("\\"), F.concat(F.lit("\\"), text)).otherwise(text)


def _unmarked(text: Column) -> Column:
    return F.when(text.startswith("\\\\"), text.substr(F.lit(2), F.length(text))).otherwise(text)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", exact: bool = False) -> None:
    """Full table as headered CSV, one file per task.

    With ``exact``, ``read_csv(exact=True)`` gives back every text as it was: NULL, empty text, blanks, quotes,
    backslashes and line breaks.
    """
    options = CSV_OPTIONS
    if exact:
        df = df.select(*_text_columns(df.schema, _marked))
        options = CSV_OPTIONS | {"nullValue": NULL_MARK, "emptyValue": '""'}
    df.write.mode(mode).options(**options).csv(path)


def deliver_csv(df: DataFrame, folder: str, name: str) -> None:
    """Write ``df`` as CSV files ``name_0.csv``, ``name_1.csv`` ... of ``folder``, one for each task; old ones go."""
    spark = df.sparkSession
    made = f"{folder.rstrip('/')}/_made_{name}"
    write_csv(df, made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    for number, part in enumerate(sorted(str(p.getPath()) for p in files.globStatus(path(f"{made}/part-*")))):
        target = path(f"{folder.rstrip('/')}/{name}_{number}.csv")
        files.delete(target, False)
        files.rename(path(part), target)
    files.delete(path(made), True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, exact: bool = False) -> DataFrame:
    """Declared columns; a header that differs from them is an error.

    Line breaks within quotes are read, so a file is not split; ``write_csv`` makes one for each task.
    """
    options = CSV_OPTIONS | {"multiLine": "true", "enforceSchema": "false"}
    if not exact:
        return spark.read.schema(schema).options(**options).csv(path)
    rows = spark.read.schema(schema).options(**options, nullValue=NULL_MARK, emptyValue="").csv(path)
    return rows.select(*_text_columns(schema, _unmarked))
