"""CSV files with a header row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from silvermill.sources.csv_records import csv_records


def _faithful(reader_or_writer, sep: str):
    """Values keep their blanks and quotes."""
    return (
        reader_or_writer.option("header", True).option("sep", sep).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    schema: StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read, and keep only `columns` if given.

    Without a schema the types are inferred, which reads the data once more.
    Values with line breaks need `multi_line`, which reads each file in one
    task, or `read_quoted_csv`, which reads a file in many.
    """
    reader = _faithful(spark.read, sep).option("multiLine", multi_line)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    frame = reader.csv(path)
    return frame.select(*columns) if columns else frame


def read_quoted_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    schema: StructType | str | None = None,
    infer: bool = True,
) -> DataFrame:
    """As `read_csv` with `multi_line`, but large files are read by many tasks.

    The first record of each file is its header; the first file's names the
    columns. Without a schema the types are inferred, or all text if `infer` is off.
    See `csv_records` for what a file may hold.
    """
    records = csv_records(spark, path).where(~F.col("first")).select("record")
    if schema is None:
        schema = _faithful(spark.read, sep).option("multiLine", True).csv(path).schema
        if infer:
            lines = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
            reader = _faithful(spark.read, sep).option("header", False).option("inferSchema", True)
            kinds = [field.dataType for field in DataFrame(reader._jreader.csv(lines), spark).schema]
            kinds += [StringType()] * len(schema)
            schema = StructType([StructField(f.name, kind) for f, kind in zip(schema, kinds)])
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    quoted = ", ".join("`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() for f in schema)
    options = {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    values = records.select(F.from_csv("record", quoted, options).alias("value"))
    frame = values.select(*[F.col("value").getField(f.name).alias(f.name) for f in schema])
    return frame.select(*columns) if columns else frame


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    _faithful(df.write.mode(mode), sep).csv(path)


def ingest_csv(
    spark: SparkSession, source: str, target: str, sep: str = ",", multi_line: bool = False
) -> None:
    """Copy a CSV into the object store. Every value stays the text it was.

    A file is read by many tasks, also if its values hold line breaks; with
    `multi_line` by one, which also reads files that break RFC 4180's rules on quotes.
    """
    if multi_line:
        frame = _faithful(spark.read, sep).option("multiLine", True).csv(source)
    else:
        frame = read_quoted_csv(spark, source, sep=sep, infer=False)
    write_csv(frame, target, sep)


def push_then_pull(
    spark: SparkSession, source: str, target: str, columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Ingest a CSV, then read it back from where it landed."""
    ingest_csv(spark, source, target, multi_line=multi_line)
    if multi_line:
        return read_csv(spark, target, columns, multi_line=True)
    return read_quoted_csv(spark, target, columns)
