"""Writers: whole tables through Spark's committers, small receipts from the driver."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), replace: bool = False) -> None:
    """Compressed Parquet. An existing table stays as it is unless ``replace``."""
    writer = df.write.mode("overwrite" if replace else "errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object a line, keys in the order of their names; readers see a finished folder or none."""
    df.select(*sorted(df.columns)).write.mode("errorifexists").json(path)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_receipt(path: str, payload: dict) -> None:
    """A JSON object with sorted keys on the driver's disk, swapped in at once."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, aside = tempfile.mkstemp(dir=folder)
    with os.fdopen(handle, "w", encoding="utf-8") as file:
        json.dump(payload, file, sort_keys=True, indent=2, ensure_ascii=False)
        file.flush()
        os.fsync(file.fileno())
    os.replace(aside, path)


def digest(payload: dict) -> str:
    """SHA-256 of an object in canonical form."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def file_digests(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """SHA-256 of each input of a receipt: receipts name a few files."""
    rows = spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256")).collect()
    return {r.path: r.sha256 for r in rows}


def write_receipt_of(spark: SparkSession, path: str, payload: dict, inputs: list[str]) -> None:
    """A receipt with the digests of its inputs, and its own."""
    body = {**payload, "inputs": file_digests(spark, inputs)}
    write_receipt(path, {**body, "sha256": digest(body)})


def with_metadata(df: DataFrame, column: str, values: dict) -> DataFrame:
    """df with key and value metadata at a column; Parquet files keep it and readers give it back."""
    return df.withMetadata(column, {**df.schema[column].metadata, **values})


def rewrite_column(spark: SparkSession, source: str, path: str, column: str, value: Column) -> None:
    """The table at source, written to path with one column made anew; all others, and the order of columns, stay."""
    table = spark.read.parquet(source)
    if column not in table.columns:
        raise ValueError(f"no such column: {column}")
    write_table(table.withColumn(column, value), path)


def overlay(df: DataFrame, base: str, path: str, keys: list[str]) -> None:
    """The rows of base with those of df in the place of rows of equal keys, as a new table; base stays as it is."""
    old = df.sparkSession.read.parquet(base)
    write_table(old.join(df.select(*keys).distinct(), keys, "left_anti").unionByName(df), path)


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A report table of a small result, sorted as it comes; ``most`` rows are shown and the rest counted."""
    rows = df.limit(most + 1).collect()
    cell = lambda x: "" if x is None else f"{x:.6g}" if isinstance(x, float) else str(x).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join(cell(x) for x in r) + " |" for r in rows[:most]]
    return "\n".join([*lines, *(["", f"More than {most} rows."] if len(rows) > most else [])]) + "\n"
