"""Table schemas, generated from a plain description of the dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Collection type codes (fixed values of the file format).
RUN = 1
TAGGED = 2
CHAINED = 3
CALIBRATION = 4

# Time spans keep whole nanoseconds; a NULL field is an open end.
TIMESPAN = T.StructType(
    [T.StructField("begin_nsec", T.LongType()), T.StructField("end_nsec", T.LongType())]
)

COLLECTIONS = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("type", T.ByteType(), False),
        T.StructField("doc", T.StringType()),
        T.StructField("children", T.ArrayType(T.StringType())),
    ]
)

DATASTORE = T.StructType(
    [
        T.StructField("datastore_name", T.StringType(), False),
        T.StructField("dataset_id", T.BinaryType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("formatter", T.StringType(), False),
        T.StructField("storage_class", T.StringType(), False),
        T.StructField("component", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("file_size", T.LongType()),
    ]
)

DATASET_TYPE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("storageClass", T.StringType()),
        T.StructField("dimensions", T.ArrayType(T.StringType())),
        T.StructField("parentStorageClass", T.StringType()),
        T.StructField("isCalibration", T.BooleanType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("collection_export_file", T.StringType()),
        T.StructField("dimension_config", T.StringType()),
        T.StructField("dimension_record_files", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "datasets",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("dataset_type", DATASET_TYPE),
                        T.StructField("dataset_export_file", T.StringType()),
                        T.StructField("datastore_export_file", T.StringType()),
                        T.StructField("association_export_file", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

PROGRESS_EVENTS = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("dataset_type", T.StringType()),
        T.StructField("total_datasets", T.LongType()),
        T.StructField("datasets_imported", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Dimension:
    """One dimension element: its own key, what it depends on and its other columns."""

    name: str
    key: str | None = None
    key_type: T.DataType = field(default_factory=T.LongType)
    requires: tuple[str, ...] = ()
    implies: tuple[str, ...] = ()
    columns: tuple[tuple[str, T.DataType], ...] = ()
    view_of: str | None = None

    @property
    def has_own_table(self) -> bool:
        return self.view_of is None


_TEXT, _INT, _REAL, _FLAG, _BYTES = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.BinaryType()

# The dimension elements of the file format (fixed values): key, dependencies, other columns.
STANDARD_DIMENSIONS = (
    Dimension("band", "name", _TEXT, view_of="physical_filter"),
    Dimension(
        "instrument",
        "name",
        _TEXT,
        columns=(
            ("visit_max", _INT),
            ("visit_system", _INT),
            ("exposure_max", _INT),
            ("detector_max", _INT),
            ("class_name", _TEXT),
        ),
    ),
    Dimension(
        "skymap",
        "name",
        _TEXT,
        columns=(("hash", _BYTES), ("tract_max", _INT), ("patch_nx_max", _INT), ("patch_ny_max", _INT)),
    ),
    Dimension("day_obs", "id", _INT, ("instrument",), columns=(("timespan", TIMESPAN),)),
    Dimension(
        "detector",
        "id",
        _INT,
        ("instrument",),
        columns=(("full_name", _TEXT), ("name_in_raft", _TEXT), ("raft", _TEXT), ("purpose", _TEXT)),
    ),
    Dimension("group", "name", _TEXT, ("instrument",)),
    Dimension("physical_filter", "name", _TEXT, ("instrument",), ("band",)),
    Dimension("subfilter", "id", _INT, ("band",)),
    Dimension("tract", "id", _INT, ("skymap",), columns=(("region", _BYTES),)),
    Dimension(
        "patch", "id", _INT, ("skymap", "tract"), columns=(("cell_x", _INT), ("cell_y", _INT), ("region", _BYTES))
    ),
    Dimension("visit_system", "id", _INT, ("instrument",), columns=(("name", _TEXT),)),
    Dimension(
        "exposure",
        "id",
        _INT,
        ("instrument",),
        ("physical_filter", "group", "day_obs"),
        columns=(
            ("obs_id", _TEXT),
            ("exposure_time", _REAL),
            ("dark_time", _REAL),
            ("observation_type", _TEXT),
            ("observation_reason", _TEXT),
            ("seq_num", _INT),
            ("seq_start", _INT),
            ("seq_end", _INT),
            ("target_name", _TEXT),
            ("science_program", _TEXT),
            ("tracking_ra", _REAL),
            ("tracking_dec", _REAL),
            ("sky_angle", _REAL),
            ("azimuth", _REAL),
            ("zenith_angle", _REAL),
            ("has_simulated", _FLAG),
            ("can_see_sky", _FLAG),
            ("timespan", TIMESPAN),
        ),
    ),
    Dimension(
        "visit",
        "id",
        _INT,
        ("instrument",),
        ("physical_filter", "day_obs"),
        columns=(
            ("name", _TEXT),
            ("seq_num", _INT),
            ("exposure_time", _REAL),
            ("target_name", _TEXT),
            ("observation_reason", _TEXT),
            ("science_program", _TEXT),
            ("azimuth", _REAL),
            ("zenith_angle", _REAL),
            ("region", _BYTES),
            ("timespan", TIMESPAN),
        ),
    ),
    Dimension("visit_definition", requires=("exposure", "visit")),
    Dimension("visit_detector_region", requires=("visit", "detector"), columns=(("region", _BYTES),)),
    Dimension("visit_system_membership", requires=("visit", "visit_system")),
    Dimension("ssp_hypothesis_table", "name", _TEXT),
    Dimension("ssp_balanced_index", "id", _INT, ("ssp_hypothesis_table",)),
    Dimension("ssp_hypothesis_bundle", "id", _INT, ("ssp_hypothesis_table",)),
)


class DimensionSpec:
    """Lookup over dimension elements: keys, dependencies, schemas and load order."""

    def __init__(self, dimensions: Iterable[Dimension] = STANDARD_DIMENSIONS) -> None:
        self._by_name = {d.name: d for d in dimensions}

    def __getitem__(self, name: str) -> Dimension:
        return self._by_name[name]

    def __contains__(self, name: str) -> bool:
        return name in self._by_name

    @property
    def names(self) -> list[str]:
        return list(self._by_name)

    def stored(self) -> list[Dimension]:
        """Elements with a table of their own; views are left out."""
        return [d for d in self._by_name.values() if d.has_own_table]

    def stored_name(self, name: str) -> str:
        """The element whose table holds the records of ``name``."""
        return self._by_name[name].view_of or name

    def required(self, names: Iterable[str]) -> list[str]:
        """The dimensions with all they require, each after its own requirements."""
        ordered: list[str] = []
        for name in names:
            for parent in self.required(self._by_name[name].requires):
                if parent not in ordered:
                    ordered.append(parent)
            if name not in ordered and self._by_name[name].key is not None:
                ordered.append(name)
        return ordered

    def key_columns(self, name: str) -> list[str]:
        """Columns that identify one record in the element's own table."""
        element = self._by_name[name]
        columns = self.required(element.requires)
        return [*columns, element.key] if element.key is not None else columns

    def load_order(self, names: Sequence[str]) -> list[list[str]]:
        """Stages of tables; every table comes after the tables its keys refer to."""
        waiting = list(names)
        stages: list[list[str]] = []
        while waiting:
            ready = [n for n in waiting if not (set(self.parents(n)) & set(waiting))]
            if not ready:
                raise ValueError(f"Dimensions depend on each other: {waiting}")
            stages.append(ready)
            waiting = [n for n in waiting if n not in ready]
        return stages

    def parents(self, name: str) -> list[str]:
        """Stored elements the table of ``name`` refers to, directly or not, without itself."""
        element = self._by_name[name]
        found: list[str] = []
        for parent in (*element.requires, *element.implies):
            stored = self.stored_name(parent)
            if stored == name:
                continue
            for candidate in (stored, *self.parents(stored)):
                if candidate not in found:
                    found.append(candidate)
        return found

    def references(self, name: str) -> list[tuple[str, dict[str, str]]]:
        """Declared references of a table: parent table and child column -> parent column.

        A reference to a view has no key of its own in the base table and is
        reported against the base table only where the child holds the base key.
        """
        element = self._by_name[name]
        found = []
        for parent in (*element.requires, *element.implies):
            stored = self.stored_name(parent)
            if stored == name or self._by_name[parent].view_of is not None:
                continue
            target = self._by_name[parent]
            columns = {c: c for c in self.required(target.requires)}
            columns[parent] = target.key
            found.append((stored, columns))
        return found

    def dataset_keys(self, name: str) -> dict[str, str]:
        """Data-ID column -> key column of the record a data ID names; empty for elements that no data ID names."""
        element = self._by_name[name]
        if element.key is None or not element.has_own_table:
            return {}
        return {**{c: c for c in self.required(element.requires)}, name: element.key}

    def record_schema(self, name: str) -> T.StructType:
        """Schema of one element's record table."""
        element = self._by_name[name]
        fields = [
            T.StructField(c, self._by_name[c].key_type, False) for c in self.required(element.requires)
        ]
        if element.key is not None:
            fields.append(T.StructField(element.key, element.key_type, False))
        fields += [T.StructField(c, self._by_name[c].key_type) for c in element.implies]
        fields += [T.StructField(c, t) for c, t in element.columns]
        return T.StructType(fields)

    def dataset_schema(self, dimensions: Iterable[str]) -> T.StructType:
        """``dataset_id``, ``run`` and one column for each required dimension."""
        fields = [T.StructField("dataset_id", T.BinaryType(), False), T.StructField("run", T.StringType(), False)]
        fields += [T.StructField(d, self._by_name[d].key_type, False) for d in self.required(dimensions)]
        return T.StructType(fields)

    def association_schema(self, dimensions: Iterable[str]) -> T.StructType:
        """A dataset row with the collection it is in and the time span it is valid for."""
        return (
            self.dataset_schema(dimensions)
            .add("collection", T.StringType(), False)
            .add("timespan", TIMESPAN, True)
        )


STANDARD_SPEC = DimensionSpec()


def by_dimensions(types: Iterable[Row]) -> dict[tuple[str, ...], list[str]]:
    """Names of dataset types with the same dimensions, whose tables have the same columns."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in types:
        groups.setdefault(tuple(row["dimensions"]), []).append(row["name"])
    return groups


def as_nullable(schema: T.StructType) -> T.StructType:
    """The schema with every column nullable, as Parquet scans report it."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order and types of ``schema``; NULL rules are checked by ``null_violations``."""
    return df.to(as_nullable(schema))


def empty_columns(df: DataFrame, columns: Mapping[str, T.DataType]) -> DataFrame:
    """Add the columns that are missing, as NULL."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
