"""Plain configuration objects handed to the operators.

They mirror the versioned YAML documents (data contract, feature schema, model
schema, split definition); ``from_dict`` takes the parsed document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

LOGICAL_TYPES: dict[str, T.DataType] = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "string": T.StringType(),
}

IMPUTERS = ("mean", "median", "most_frequent", "constant")
SCALERS = ("standard", "minmax")
ENCODINGS = ("binary", "ordinal", "onehot")


@dataclass(frozen=True)
class ExternalFile:
    """A column whose values name files with declared image dimensions."""

    name: str
    type: str = "image"
    bands: int | None = None
    height: int | None = None
    width: int | None = None

    @property
    def path_column(self) -> str:
        return f"{self.name}_relative_path"


@dataclass(frozen=True)
class ColumnRule:
    type: str
    non_nullable: bool = False
    min: float | None = None
    max: float | None = None
    allowed_values: tuple[Any, ...] | None = None
    format: str | None = None
    external_file: ExternalFile | None = None

    def __post_init__(self) -> None:
        if self.type not in LOGICAL_TYPES:
            raise ValueError(f"unsupported column type {self.type!r}")

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> ColumnRule:
        external = spec.get("external_file")
        allowed = spec.get("allowed_values")
        return cls(
            type=spec["type"],
            non_nullable=bool(spec.get("non_nullable", False)),
            min=spec.get("min"),
            max=spec.get("max"),
            allowed_values=None if allowed is None else tuple(allowed),
            format=spec.get("format"),
            external_file=None if external is None else ExternalFile(**external),
        )


@dataclass(frozen=True)
class Contract:
    columns: Mapping[str, ColumnRule]
    primary_key: tuple[str, ...] = ()
    target: str | None = None
    dedup_subset: tuple[str, ...] | None = None
    dedup_keep: str | None = None  # "first", "last", "none"; None = no de-duplication
    tabular_extensions: tuple[str, ...] = ("csv",)
    image_extensions: tuple[str, ...] = ("tif",)
    version: int = 1

    def __post_init__(self) -> None:
        unknown = [c for c in self.primary_key if c not in self.columns]
        if unknown:
            raise ValueError(f"primary key columns not in the contract: {unknown}")
        if self.dedup_keep not in (None, "first", "last", "none"):
            raise ValueError(f"unsupported keep {self.dedup_keep!r}")

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> Contract:
        keep, subset = None, None
        if "deduplication" in doc:
            rules = doc["deduplication"]
            keep = rules.get("keep", "last")
            keep = "none" if keep is False else keep
            subset = rules.get("subset")
        return cls(
            columns={c: ColumnRule.from_dict(s) for c, s in doc["columns"].items()},
            primary_key=tuple(doc.get("primary_key") or ()),
            target=doc.get("target"),
            dedup_subset=None if subset is None else tuple(subset),
            dedup_keep=keep,
            tabular_extensions=tuple(doc.get("tabular_extensions", ())),
            image_extensions=tuple(doc.get("image_extensions", ())),
            version=int(doc.get("version", 1)),
        )

    def target_problem(self) -> str | None:
        """Why the target definition is unusable, or None."""
        if not self.target:
            return "no target defined in the contract"
        if self.target not in self.columns:
            return f"target {self.target!r} is not a contract column"
        if not self.columns[self.target].non_nullable:
            return f"target {self.target!r} must be non_nullable"
        if self.target in self.primary_key:
            return f"target {self.target!r} cannot be part of the primary key"
        return None

    def external_columns(self) -> dict[str, ExternalFile]:
        return {
            c: r.external_file
            for c, r in self.columns.items()
            if r.external_file is not None and r.external_file.type == "image"
        }

    def schema(self) -> T.StructType:
        """Typed Spark schema of a contract-conforming table."""
        return T.StructType(
            [T.StructField(c, LOGICAL_TYPES[r.type]) for c, r in self.columns.items()]
        )

    def raw_schema(self) -> T.StructType:
        """All-string schema: what a CSV is read as before the casts."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


@dataclass(frozen=True)
class Feature:
    name: str
    type: str  # "numeric" or "categorical"
    impute: str | None = None
    fill_value: Any = None
    clip: tuple[float, float] | None = None
    scaler: str | None = None
    encoding: str | None = None
    order: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.type not in ("numeric", "categorical"):
            raise ValueError(f"{self.name}: unsupported feature type {self.type!r}")
        if self.impute is not None and self.impute not in IMPUTERS:
            raise ValueError(f"{self.name}: unsupported imputation {self.impute!r}")
        if self.type == "categorical":
            if self.encoding not in ENCODINGS:
                raise ValueError(f"{self.name}: unsupported encoding {self.encoding!r}")
            if self.encoding == "ordinal" and not self.order:
                raise ValueError(f"{self.name}: ordinal encoding needs an order")
            if self.impute in ("mean", "median"):
                raise ValueError(f"{self.name}: {self.impute} needs a numeric feature")
        elif self.scaler is not None and self.scaler not in SCALERS:
            raise ValueError(f"{self.name}: unsupported scaler {self.scaler!r}")

    @classmethod
    def from_dict(cls, name: str, spec: Mapping[str, Any]) -> Feature:
        clip = spec.get("clip")
        order = spec.get("order") or spec.get("values")
        return cls(
            name=name,
            type=spec.get("type"),
            impute=spec.get("impute"),
            fill_value=spec.get("fill_value"),
            clip=None if clip is None else (clip[0], clip[1]),
            scaler=spec.get("scaler"),
            encoding=spec.get("encoding"),
            order=None if order is None else tuple(order),
        )


@dataclass(frozen=True)
class FeatureSchema:
    features: tuple[Feature, ...]
    version: int = 1
    data_contract: int = 1

    def __post_init__(self) -> None:
        if not self.features:
            raise ValueError("a feature schema needs at least one feature")

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> FeatureSchema:
        if doc.get("image_features"):
            raise NotImplementedError("image features are not supported")
        return cls(
            features=tuple(
                Feature.from_dict(n, s or {}) for n, s in doc["tabular_features"].items()
            ),
            version=int(doc.get("version", 1)),
            data_contract=int(doc.get("data_contract", 1)),
        )

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]

    def unknown_columns(self, contract: Contract) -> list[str]:
        return sorted(set(self.names) - set(contract.columns))


@dataclass(frozen=True)
class ModelSpec:
    type: str
    params: Mapping[str, Any] = field(default_factory=dict)
    version: int = 1

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> ModelSpec:
        model = doc["model"]
        return cls(model["type"], dict(model.get("params") or {}), int(doc.get("version", 1)))


@dataclass(frozen=True)
class SplitSpec:
    geographic_column: str
    periodic_column: str
    test_localities: tuple[str, ...]
    reference_min: int
    reference_max: int
    durations: tuple[int, ...] = ()
    version: int = 1

    def __post_init__(self) -> None:
        for d in self.durations:
            if isinstance(d, bool) or not isinstance(d, int) or d <= 0:
                raise ValueError(f"moving test duration must be a positive integer, got {d!r}")

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> SplitSpec:
        for key in ("geographic_column", "periodic_column", "test_localities",
                    "reference_test_period"):
            if key not in doc:
                raise ValueError(f"split definition lacks {key!r}")
        period = doc["reference_test_period"]
        if "min" not in period or "max" not in period:
            raise ValueError("reference_test_period needs 'min' and 'max'")
        return cls(
            geographic_column=doc["geographic_column"],
            periodic_column=doc["periodic_column"],
            test_localities=tuple(doc["test_localities"]),
            reference_min=period["min"],
            reference_max=period["max"],
            durations=tuple((doc.get("moving_test_period") or {}).get("durations", ())),
            version=int(doc.get("version", 1)),
        )

    def recent_names(self) -> list[str]:
        return [f"recent_{d}_{self.periodic_column}" for d in self.durations]


@dataclass(frozen=True)
class RunConfig:
    """The three versions that identify a training configuration."""

    split_version: int
    feature_version: int
    model_version: int


def load_yaml(path: str) -> dict[str, Any]:
    import yaml

    with open(path, encoding="utf-8") as handle:
        doc = yaml.safe_load(handle)
    if not isinstance(doc, dict):
        raise ValueError(f"{path}: expected a mapping")
    return doc


def names(columns: Sequence[str] | str) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)
