"""Reports on a dump."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from .. import fs
from ..operators.summary import count_report, release_summary, type_count_report
from ..sinks.report import SUMMARY_TITLES, to_markdown
from ..sources.release import Release


def summarize(release: Release, globs: Iterable[str] | None = None, listing: DataFrame | None = None) -> DataFrame:
    """Datasets, files and bytes of each dataset type.

    ``listing`` (``file``, ``size``) gives the size of files whose records have none.
    """
    chosen = release.select(globs)
    return release_summary(
        chosen.read_all_datasets(), chosen.read_all_datastore(), listing, chosen.type_table.select("name")
    )


def summary_text(summary: DataFrame, title: str = "Datasets") -> str:
    return to_markdown(summary, SUMMARY_TITLES, title)


def write_summary(summary: DataFrame, path: str, title: str = "Datasets") -> None:
    """Write the summary as a Markdown file."""
    fs.write_text(summary.sparkSession, path, summary_text(summary, title))


def dimension_counts(release: Release) -> DataFrame:
    """Records of each dimension element."""
    return count_report({name: release.read_dimension(name) for name in release.dimension_files})


def dataset_counts(release: Release) -> DataFrame:
    """Datasets, file records and associations of each dataset type."""
    return type_count_report(
        release.type_table,
        release.read_all_datasets(),
        release.read_all_datastore(),
        release.read_all_associations(),
    )
