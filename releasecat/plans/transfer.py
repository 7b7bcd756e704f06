"""Plan of the file transfers of a release."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import skip_existing
from ..operators.paths import file_list
from ..operators.transfer import assign_batches, transfer_pairs
from ..operators.validation import require_none
from ..session import cut_lineage
from ..sources.release import Release

BATCH_FILES = 100


def transfer_plan(
    release: Release,
    mapping: Mapping[str, str] | DataFrame,
    globs: Iterable[str] | None = None,
    listing: DataFrame | None = None,
    size: int = BATCH_FILES,
) -> DataFrame:
    """Source and destination of every file that has to be sent, in batches.

    ``listing`` (``destination``) holds what is at the destination already.
    """
    files = file_list(release.select(globs).read_all_datastore())
    # The list of files is made once; a file no prefix covers has no destination in it.
    pairs = cut_lineage(transfer_pairs(files, mapping), "pairs")
    require_none(pairs.where(F.col("destination").isNull()).select("source"), "Files under none of the prefixes")
    if listing is not None:
        pairs = skip_existing(pairs, listing)
    return assign_batches(pairs, size)
