"""Layer tables, previews and report queries kept as SQL files."""

from __future__ import annotations

import re
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def is_folder(target: str) -> bool:
    """A layer is named by a folder path (with a slash) or by a catalog table name."""
    return "/" in target


def read_table(spark: SparkSession, target: str, schema: StructType | None = None) -> DataFrame:
    """A stored layer. An absent one raises an error that names it. A known ``schema`` of a folder
    saves the job that looks it up."""
    if not is_folder(target):
        return spark.table(target)
    return (spark.read.schema(schema) if schema else spark.read).parquet(target)


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.limit(n)


def run_sql_file(
    spark: SparkSession,
    path: str | Path,
    views: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run the one statement of a SQL file.

    ``views`` binds table names of the text, qualified ones included, to DataFrames; ``args`` binds
    named parameters. With neither, names resolve in the session catalog.
    """
    text = Path(path).read_text(encoding="utf-8")
    for name, rows in (views or {}).items():
        view = re.sub(r"\W", "_", name)
        rows.createOrReplaceTempView(view)
        text = re.sub(rf"(?<![\w.]){re.escape(name)}(?![\w.])", view, text)
    return spark.sql(text, args=dict(args or {}))
