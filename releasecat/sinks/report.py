"""Reports as Markdown text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMMARY_TITLES = {
    "dataset_type": "Type",
    "datasets": "Datasets",
    "files": "Files",
    "size": "Size",
    "bytes": "Bytes",
    "files_without_size": "Files of unknown size",
}


def report_lines(df: DataFrame, titles: Mapping[str, str]) -> DataFrame:
    """Each row of a report as a Markdown table row."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in titles]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def to_markdown(df: DataFrame, titles: Mapping[str, str], title: str | None = None) -> str:
    """A report with one row for each dataset type or dimension as text."""
    lines: Iterable[str] = (row["line"] for row in report_lines(df, titles).collect())
    head = [f"| {' | '.join(titles.values())} |", f"|{'---|' * len(titles)}"]
    return "\n".join([*([title, ""] if title else []), *head, *lines, ""])
