"""Role schemas: which position holds which column and what each column is for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class RoleSchema:
    """Positional columns with the id, target, numerical and categorical roles."""

    name: str
    columns: tuple[str, ...]
    primary_id: str
    target: str
    numerical: tuple[str, ...]
    categorical: tuple[str, ...]
    target_is_feature: bool = False

    def resolve(self, column: str) -> str:
        """Case-insensitive lookup; unknown names raise."""
        wanted = column.upper()
        if wanted not in self.columns:
            raise ValueError(f"schema {self.name} has no column {column!r}")
        return wanted

    def resolve_all(self, columns) -> list[str]:
        return [self.resolve(c) for c in columns]

    def features(self, current) -> list[str]:
        """Feature columns present in `current`, in declared order."""
        roles = set(self.numerical) | set(self.categorical)
        if not self.target_is_feature:
            roles.discard(self.target)
        present = set(current)
        return [c for c in self.columns if c in roles and c in present]

    @property
    def label(self) -> str:
        """Column a model learns: the target, or a raw copy where the target is a feature too."""
        return f"{self.target}_LABEL" if self.target_is_feature else self.target

    def text_struct(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def typed_struct(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c, T.DoubleType() if c in self.numerical else T.StringType())
                for c in self.columns
            ]
        )


COMMODITY_FLOW = RoleSchema(
    name="commodity_flow",
    columns=(
        "SHIPMENT_ID",
        "ORIGIN_STATE",
        "ORIGIN_DISTRICT",
        "ORIGIN_CFS_AREA",
        "DESTINATION_STATE",
        "DESTINATION_DISTRICT",
        "DESTINATION_CFS_AREA",
        "NAICS",
        "QUARTER",
        "SCTG",
        "MODE",
        "SHIPMENT_VALUE",
        "SHIPMENT_WEIGHT",
        "SHIPMENT_DISTANCE_CIRCLE",
        "SHIPMENT_DISTANCE_ROUTE",
        "IS_TEMPERATURE_CONTROLLED",
        "IS_EXPORT",
        "EXPORT_COUNTRY",
        "HAZMAT",
        "WEIGHT_FACTOR",
    ),
    primary_id="SHIPMENT_ID",
    target="SHIPMENT_VALUE",
    numerical=(
        "SHIPMENT_VALUE",
        "SHIPMENT_WEIGHT",
        "SHIPMENT_DISTANCE_CIRCLE",
        "SHIPMENT_DISTANCE_ROUTE",
        "WEIGHT_FACTOR",
    ),
    categorical=(
        "ORIGIN_STATE",
        "ORIGIN_DISTRICT",
        "ORIGIN_CFS_AREA",
        "DESTINATION_STATE",
        "DESTINATION_DISTRICT",
        "DESTINATION_CFS_AREA",
        "NAICS",
        "QUARTER",
        "SCTG",
        "MODE",
        "EXPORT_COUNTRY",
        "HAZMAT",
    ),
)

SAMPLE = RoleSchema(
    name="sample",
    columns=("COLUMN_ID", "COLUMN_FEATURE", "COLUMN_FEATURE_DELETED", "COLUMN_TARGET"),
    primary_id="COLUMN_ID",
    target="COLUMN_TARGET",
    numerical=("COLUMN_FEATURE", "COLUMN_TARGET"),
    categorical=(),
    target_is_feature=True,
)

SAMPLE_TRANSFORMER = RoleSchema(
    name="sample_enum_transformer",
    columns=("COLUMN_ID", "COLUMN_CATEGORICAL", "COLUMN_NUMERICAL", "COLUMN_TARGET"),
    primary_id="COLUMN_ID",
    target="COLUMN_TARGET",
    numerical=("COLUMN_NUMERICAL",),
    categorical=("COLUMN_CATEGORICAL",),
)

REGISTRY = {s.name: s for s in (COMMODITY_FLOW, SAMPLE, SAMPLE_TRANSFORMER)}


def schema_named(name: str) -> RoleSchema:
    if name not in REGISTRY:
        raise ValueError(f"no schema named {name!r}; known: {sorted(REGISTRY)}")
    return REGISTRY[name]
