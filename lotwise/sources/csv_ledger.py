"""CSV import of the five ledger tables: declared types, and a quarantine for what does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.schemas import TABLES

# Fixed value: timestamp text in the files, read as UTC.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _typed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))
    return text.try_cast(field.dataType)


# A line of whole values: without quotes, or quoted from end to end, with quotes inside doubled.
_WHOLE_VALUE = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
_WHOLE_LINE = f"(?s)^{_WHOLE_VALUE}(?:,{_WHOLE_VALUE})*+$"


def files_with_open_quotes(spark: SparkSession, path: str) -> list[str]:
    """The files in which some line has a quote that does not close there, so that a value may hold a line break.

    One scan of the lines, split like any text; only names of files reach the driver, which lists them to read them anyway.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    odd = lines.where(F.col("value").contains('"') & ~F.col("value").rlike(_WHOLE_LINE))
    return [r.file for r in odd.select("file").distinct().collect()]


def load_ledger_csv(spark: SparkSession, path: str, table: str, multi_line: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV file or folder with a header.

    Rejects keep the text as read, with a reason: a value that is not of its column's type (a day 00, say), an empty
    one where the table needs a value, or a line whose fields are not as many as the columns, which is kept whole in
    ``line``. Quoted values may hold line breaks: files in which a line leaves a quote open are found first and read by
    one task each, all others are split. With ``multi_line`` true every file is read by one task and nothing is looked
    up; with false all are split, and no value may hold a line break.
    """
    fields = TABLES[table].fields
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields] + [T.StructField("line", T.StringType())])

    def parsed(whole_files: bool) -> DataFrame:
        return (
            spark.read.schema(as_text).option("header", True).option("enforceSchema", False).option("multiLine", whole_files)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "line").option("escape", '"').csv(path)
        )

    unclosed = files_with_open_quotes(spark, path) if multi_line is None else []
    raw = parsed(bool(multi_line))
    if unclosed:
        # Filters on the file's name choose the files before any is opened.
        among = F.col("_metadata.file_path").isin(unclosed)
        raw = raw.where(~among).unionByName(parsed(True).where(among))
    broken = F.when(F.col("line").isNotNull(), F.lit("number of fields"))
    problems = [
        F.when(
            _typed(f).isNull() & (F.col(f.name).isNotNull() | F.lit(not f.nullable)),
            F.concat(F.lit(f"{f.name}: "), F.coalesce(F.col(f.name), F.lit("empty"))),
        )
        for f in fields
    ]
    checked = raw.withColumn("reason", F.coalesce(broken, F.concat_ws("; ", *problems)))
    good = checked.filter(F.col("reason") == "").select(*[_typed(f).alias(f.name) for f in fields])
    return good, checked.filter(F.col("reason") != "")
