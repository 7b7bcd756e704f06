"""Release catalog analytics on Spark.

Datasets, collections, file records, associations and dimension records are
DataFrames; every operator is a ``DataFrame -> DataFrame`` function.
"""

from .plans.export import export_release
from .plans.load import check_release, load_release
from .plans.summary import dataset_counts, dimension_counts, summarize
from .plans.transfer import transfer_plan
from .plans.transform import change_storage_class, prune_release, remove_value_from_release
from .session import build_session, configure
from .sinks.rewrite import remove_replaced
from .sources.catalog import Catalog, read_catalog
from .sources.listing import list_files
from .sources.release import Release, read_manifest

__all__ = [
    "Catalog",
    "Release",
    "build_session",
    "change_storage_class",
    "check_release",
    "configure",
    "dataset_counts",
    "dimension_counts",
    "export_release",
    "list_files",
    "load_release",
    "prune_release",
    "read_catalog",
    "read_manifest",
    "remove_replaced",
    "remove_value_from_release",
    "summarize",
    "transfer_plan",
]
