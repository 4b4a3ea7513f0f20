"""CSV scan: encoding and line layout per file, missing tokens, types from values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.config import FALSE_TOKENS, MISSING_TOKENS, TRUE_TOKENS
from assayer.functions.columns import ref
from assayer.session import pinned
from assayer.sources.quoted_csv import quoted_records

# Fixed patterns of what counts as a number in text.
INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"

# What a text can be read as, one bit each.
WHOLE, LONG_WHOLE, NUMBER, TOKEN, OTHER = 1, 2, 4, 8, 16

# How one record is parsed; line ends inside its quotes stay as they are.
_RECORD_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def file_layouts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, encoding, multi_line, header), one row per file.

    A file that is not valid UTF-8 is Latin-1 as a whole. If every line holds
    an even number of quotes, no value spans lines, and Spark may split the
    file over tasks. The header is the first line as it stands.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
        "value",
    )
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.groupBy("file").agg(
        F.when(F.bool_and(F.is_valid_utf8("value")), "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
        (~F.bool_and(quotes % 2 == 0)).alias("multi_line"),
        F.min_by(F.rtrim("value", F.lit("\r")), "place").alias("header"),
    )


def _fields(record: Column) -> Column:
    """How many fields a record has: commas outside quotes, and one."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_csv_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text. Files of one layout and header are read together, and their columns meet by name.

    Where all files share both, as those of one writer do, they are read by their common path and none is listed here.

    A shorter record ends in missing values. A record with more fields than
    the header has no place for them: the table fails when it is read.
    Headers that name different columns are an error that shows both.
    """
    shape = ["encoding", "multi_line", "header"]
    found = pinned(file_layouts(spark, path))
    examples = found.groupBy(shape).agg(F.min("file").alias("first")).collect()
    layouts = {tuple(r[c] for c in shape): (r["first"], path) for r in examples}
    if len(layouts) > 1:  # only then the files have to be told apart
        for r in found.groupBy(shape).agg(F.sort_array(F.collect_list("file")).alias("files")).collect():
            layouts[tuple(r[c] for c in shape)] = (r["files"][0], r["files"])
    if not layouts:
        return spark.read.option("header", True).csv(path)
    parts = []
    for encoding, multi_line, header in sorted(layouts, key=str):
        first, files = layouts[encoding, multi_line, header]
        reader = (
            spark.read.option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("encoding", encoding)
            .option("multiLine", multi_line)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
        names = reader.csv(first).columns
        record = "record"
        while record in names:
            record += "_"
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, record]])
        reader = reader.option("columnNameOfCorruptRecord", record)
        records = quoted_records(spark, files, encoding) if multi_line else None
        if records is None:
            rows = reader.schema(schema).csv(files)
        else:
            fields = ", ".join("`" + c.replace("`", "``") + "` string" for c in schema.names)
            kept = {**_RECORD_OPTIONS, "columnNameOfCorruptRecord": record}
            rows = records.select(F.from_csv("record", fields, kept).alias("r")).select("r.*")
        shown = F.concat(F.lit("a record has more fields than the header: "), F.left(ref(record), F.lit(80)))
        fits = F.when(_fields(ref(record)) > len(names), F.raise_error(shown).cast("boolean")).otherwise(F.lit(True))
        parts.append(rows.where(fits).select([ref(c) for c in names]))
    for part in parts[1:]:
        if sorted(part.columns) != sorted(parts[0].columns):
            raise ValueError(f"files with different columns: {parts[0].columns} and {part.columns}")
    return reduce(lambda a, b: a.unionByName(b), parts)


def blank_missing(df: DataFrame) -> DataFrame:
    """Missing tokens become null in every column."""
    return df.select(
        [F.when(~ref(c).isin(list(MISSING_TOKENS)), ref(c)).alias(c) for c in df.columns]
    )


def _plain(value: Column) -> Column:
    return F.btrim(value, F.lit(" \t\n\r\f\v"))


def _shape(value: Column) -> Column:
    """The bit of a text; null for none. What one pattern has told is not looked at again."""
    whole = F.when(_plain(value).try_cast("bigint").isNotNull(), WHOLE).otherwise(LONG_WHOLE)
    return (
        F.when(value.isNull(), F.lit(None).cast("int"))
        .when(value.rlike(INTEGER_PATTERN), whole)
        .when(value.rlike(NUMBER_PATTERN), NUMBER)
        .when(value.isin(list(TRUE_TOKENS + FALSE_TOKENS)), TOKEN)
        .otherwise(OTHER)
    )


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns to the narrowest of bigint, double, boolean that fits every value.

    Dates stay text; a column without any value is double. One aggregate
    decides for all columns; the driver sees a few flags per column.
    """
    flags = [f for i, c in enumerate(df.columns) for f in (F.count(ref(c)).alias(f"n{i}"), F.bit_or(_shape(ref(c))).alias(f"k{i}"))]
    if not flags:
        return df
    seen = df.agg(*flags).first()
    typed = []
    for i, c in enumerate(df.columns):
        v = ref(c)
        if seen[f"n{i}"] == 0:
            typed.append(F.lit(None).cast("double").alias(c))
        elif not seen[f"k{i}"] & ~(WHOLE | LONG_WHOLE):
            # whole numbers beyond 64 bits keep every digit as text
            typed.append((v if seen[f"k{i}"] & LONG_WHOLE else _plain(v).try_cast("bigint")).alias(c))
        elif not seen[f"k{i}"] & ~(WHOLE | LONG_WHOLE | NUMBER):
            typed.append(_plain(v).try_cast("double").alias(c))
        elif not seen[f"k{i}"] & ~TOKEN:
            typed.append(F.when(v.isNotNull(), v.isin(list(TRUE_TOKENS))).alias(c))
        else:
            typed.append(v.alias(c))
    return df.select(typed)


def read_csv(spark: SparkSession, path: str | list[str], staged: bool = True) -> DataFrame:
    """A typed table from CSV files with a header row.

    Staged, the text is parsed once into the shared folder, types are found
    there, and the typed table is written: a file with quoted newlines is
    read by a single task, and no later scan casts text again.
    """
    text = blank_missing(read_csv_text(spark, path))
    return pinned(infer_types(pinned(text))) if staged else infer_types(text)
