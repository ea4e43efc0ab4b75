"""Plain files: JSON lines and CSV extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, in as many files as the data has partitions."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_extract(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, white space kept and quotes doubled, as the extract reader expects."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
