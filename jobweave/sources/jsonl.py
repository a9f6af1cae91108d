"""Strict JSON Lines: every non-blank line is one JSON object, errors name file and physical line.

Large files are read in splits; a line's number comes from its place in its split plus the lines of the
splits before, so no task reads a whole file.
"""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class JsonlParseError(ValueError):
    """A line that is no JSON object; says where."""


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) with lines counted from 1 in each file, blank ones included."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    blocks = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = blocks.select("file", "block", "first", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("before"))
    return raw.join(before, ["file", "block"]).select("file", (F.col("at") - F.col("first") + F.col("before") + 1).alias("line_no"), "line")


def bad_lines(lines: DataFrame) -> DataFrame:
    parsed = F.try_parse_json("line")
    kind = F.schema_of_variant(parsed)
    return lines.where(F.trim("line") != "").where(parsed.isNull() | ~kind.startswith("OBJECT")).select("file", "line_no", "line")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """(file, line_no, record): records of ``schema``; strict raises at the first line that is no object."""
    lines = numbered_lines(spark, path).where(F.trim("line") != "")
    if strict and (first := bad_lines(lines).orderBy("file", "line_no").limit(1).collect()):
        raise JsonlParseError(f"{first[0].file}:{first[0].line_no}: not a JSON object")
    return lines.select("file", "line_no", F.from_json("line", schema).alias("record"))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line, keys sorted, nulls kept."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def atomic_write_text(path: str, text: str) -> None:
    """A small text, written beside its place and moved there; nothing is left behind on failure."""
    folder = os.path.dirname(os.path.abspath(path))
    fd, temp = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(fd, "w", encoding="utf-8", newline="\n") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, path)
    except BaseException:
        if os.path.exists(temp):
            os.unlink(temp)
        raise


def write_report(path: str, report: dict) -> None:
    atomic_write_text(path, json.dumps(report, sort_keys=True, indent=2, ensure_ascii=False) + "\n")
