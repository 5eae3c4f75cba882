"""Reply lines with their place, so that the last of several replies can win."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ship
from tidemark.sources import files


def reply_lines(spark: SparkSession, where: str | Sequence[str], lines_per_batch: int = 20_000) -> DataFrame:
    """(file, line_no, line) of a file, or of the part-*.jsonl files of a folder without error markers; blank lines are skipped.

    One task reads one file, which keeps its line numbers; files are bounded by the lines per request part.
    """
    ship(spark)
    if isinstance(where, str):
        where = [p for p in files.matching(spark, f"{where}/part-*.jsonl") if not p.endswith(".errors.jsonl")] if files.is_folder(spark, where) else files.matching(spark, where)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with io.TextIOWrapper(files.opened(path), encoding="utf-8", errors="replace", newline="\n") as f:
                    rows = []
                    for n, line in enumerate(f):
                        if line.strip():
                            rows.append((path, n, line.rstrip("\n")))
                        if len(rows) == lines_per_batch:
                            yield pd.DataFrame(rows, columns=["file", "line_no", "line"])
                            rows = []
                    yield pd.DataFrame(rows, columns=["file", "line_no", "line"])

    each = spark.createDataFrame([(p,) for p in where], "path string").repartition(max(1, len(where)))
    return each.mapInPandas(read, "file string, line_no bigint, line string")
