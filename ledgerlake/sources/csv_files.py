"""CSV extracts with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.casting import cast_as
from ..specs import EntitySpec


def read_extract(
    spark: SparkSession,
    spec: EntitySpec,
    path: str | list[str],
    *,
    typed: bool = False,
    blank_as_text: bool = False,
    recursive: bool = False,
    name_filter: str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Read one entity's extract files.

    The schema is declared, so there is no inference pass over the files, and a file whose header
    differs from it fails instead of shifting columns.  ``typed`` applies the entity's types
    (unparseable fields become NULL).  Blank fields are NULL, or ``""`` with ``blank_as_text``.
    Values may hold line ends, so a file is one task: big extracts come as many files.  Without
    ``multiline`` files are split; a value that goes over a line end then fails the read.
    """
    reader = (
        spark.read.schema(spec.raw_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", recursive)
    )
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    df = reader.csv(path)
    if typed:
        df = df.select(*[
            cast_as(name, spec.casts[name]).alias(name) if name in spec.casts else F.col(name) for name in spec.columns
        ])
    return df.fillna("") if blank_as_text else df
