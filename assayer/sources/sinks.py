"""Write tables and findings."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.columns import ref

# Formats of stages and reports. A stage is Parquet unless a person reads it.
FORMATS = ("parquet", "csv", "json", "text")


def _parts(path: str) -> tuple[str, list[str]]:
    scheme, _, rest = path.rpartition(":")
    scheme = "" if scheme == "file" else scheme
    return scheme, posixpath.normpath("/" + rest.lstrip("/")).split("/")


def refuse_overlap(source: str, target: str) -> None:
    """An error if writing to ``target`` would replace ``source``, a folder that holds it, or a part of it."""
    (one, a), (two, b) = _parts(source), _parts(target)
    shorter = min(len(a), len(b))
    if one == two and a[:shorter] == b[:shorter]:
        raise ValueError(f"{target} would overwrite the source {source}")


def write_csv(df: DataFrame, path: str) -> None:
    """Header, doubled quotes, folders created, an older result replaced."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def save_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "csv":
        write_csv(df, path)
    elif fmt in ("parquet", "json"):
        df.write.mode("overwrite").format(fmt).save(path)
    elif fmt == "text":
        as_text(df).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")


def as_text(findings: DataFrame) -> DataFrame:
    """(line): one readable line per finding, null and empty fields left out."""
    fields = [
        F.when(
            ref(f.name).isNotNull(),
            F.concat(
                F.lit(f"{f.name}="),
                F.array_join(ref(f.name), ", ") if f.dataType.typeName() == "array" else ref(f.name).cast("string"),
            ),
        )
        for f in findings.schema.fields
    ]
    return findings.select(F.concat_ws(" | ", *fields).alias("line"))


def save_report(sections: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """Each findings table below ``path`` under its own name; returns what was written."""
    written = []
    for name, findings in sections.items():
        target = f"{path.rstrip('/')}/{name}"
        save_table(findings, target, fmt)
        written.append(target)
    return written
