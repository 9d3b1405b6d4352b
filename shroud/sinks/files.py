"""File sinks: ORC, quoted gzip TSV, per-object JSON text.

Writers run in parallel, one file per task; ``max_records_per_file`` bounds
file size instead of funnelling the data through one task.  A single output
file is available on request (``single_file=True``) for small exports only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _prepare(df: DataFrame, single_file: bool):
    return df.coalesce(1) if single_file else df


def write_orc(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False,
              max_records_per_file: int = 5_000_000) -> None:
    (_prepare(df, single_file).write.mode(mode)
     .option("compression", "snappy")
     .option("orc.create.index", "true")
     .option("maxRecordsPerFile", max_records_per_file)
     .orc(path))


def write_tsv_gzip(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False,
                   max_records_per_file: int = 5_000_000, sep: str = "\t") -> None:
    """Every value quoted, ``"`` doubled, whitespace kept, gzip, no header.

    With every value quoted, NULL and '' are both written as ``""`` and read
    back as NULL by the delimited scans (as the exports always behaved).
    """
    (_prepare(df, single_file).write.mode(mode)
     .option("sep", sep)
     .option("quoteAll", True)
     .option("quote", '"')
     .option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .option("compression", "gzip")
     .option("maxRecordsPerFile", max_records_per_file)
     .csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """Plain delimited export (quote when needed, whitespace kept)."""
    (df.write.mode(mode).option("sep", sep).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_by_format(df: DataFrame, path: str, fmt: str, **kw) -> None:
    """Dispatch on the export format name ('orc' or 'gzip')."""
    if fmt == "orc":
        write_orc(df, path, **kw)
    elif fmt == "gzip":
        write_tsv_gzip(df, path, **kw)
    else:
        raise ValueError(f"unknown output format {fmt!r}; expected 'orc' or 'gzip'")


def read_by_format(spark, path: str, fmt: str, schema) -> DataFrame:
    if fmt == "orc":
        return spark.read.schema(schema).orc(path)
    if fmt == "gzip":
        # the writer keeps line breaks inside its quotes
        return (spark.read.schema(schema).option("sep", "\t").option("quote", '"')
                .option("escape", '"').option("multiLine", True).csv(path))
    raise ValueError(f"unknown output format {fmt!r}; expected 'orc' or 'gzip'")
