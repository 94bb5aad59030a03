"""Versioned JSON data contracts: loading, linting and the Spark schema.

A contract is a small JSON document (entity, version, description,
primary_key, columns[]). It is read on the driver: it is configuration, a few
kilobytes, never data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..functions.patterns import java_pattern

PACKAGE_CONTRACTS = Path(__file__).resolve().parent.parent / "contracts"

# --- fixed values ------------------------------------------------------------
# Declared type names and the Spark type each one stages to. Any other name is
# treated as string.
STAGED_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    min: float | int | None = None
    max: float | int | None = None
    allowed: tuple | None = None
    pattern: str | None = None
    has_min: bool = False
    has_max: bool = False

    @staticmethod
    def from_dict(d: dict) -> "ColumnSpec":
        allowed = d.get("allowed")
        return ColumnSpec(
            name=d["name"],
            type=d.get("type", "string"),
            nullable=bool(d.get("nullable", True)),
            min=d.get("min"),
            max=d.get("max"),
            allowed=tuple(allowed) if allowed is not None else None,
            pattern=d.get("pattern"),
            has_min="min" in d,
            has_max="max" in d,
        )

    @property
    def staged_type(self) -> T.DataType:
        return STAGED_TYPES.get(self.type, T.StringType())


@dataclass(frozen=True)
class Contract:
    entity: str
    version: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    description: str = ""
    raw: dict = field(default_factory=dict, compare=False, repr=False)

    @staticmethod
    def from_dict(d: dict) -> "Contract":
        for key in ("entity", "version", "columns"):
            if key not in d:
                raise KeyError(f"contract is missing required key {key!r}")
        return Contract(
            entity=d["entity"],
            version=str(d["version"]),
            columns=tuple(ColumnSpec.from_dict(c) for c in d["columns"]),
            primary_key=tuple(d.get("primary_key", []) or []),
            description=d.get("description", ""),
            raw=d,
        )

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def spec(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def staged_schema(self) -> T.StructType:
        """Schema of the typed (staged) form of the contracted columns."""
        return T.StructType([T.StructField(c.name, c.staged_type, True) for c in self.columns])

    def text_schema(self, names: list[str] | None = None) -> T.StructType:
        """All-string schema, as a CSV source is read."""
        return T.StructType([T.StructField(n, T.StringType(), True) for n in (names or self.names)])


class ContractFolder:
    """Contracts by entity name in a folder: a local path, or a URI that the
    active session's Hadoop configuration can open."""

    def __init__(self, location: str | Path | None = None):
        self.location = PACKAGE_CONTRACTS / "bank" if location is None else location
        self.remote = "://" in str(self.location)

    def _hadoop(self, *names: str):
        spark = SparkSession.active()
        path = spark._jvm.org.apache.hadoop.fs.Path("/".join([str(self.location).rstrip("/"), *names]))
        return path, path.getFileSystem(spark._jsc.hadoopConfiguration())

    def entities(self) -> list[str]:
        if self.remote:
            path, fs = self._hadoop()
            files = [str(s.getPath().getName()) for s in fs.listStatus(path)]
        else:
            files = [p.name for p in Path(self.location).iterdir()]
        return sorted(f.removesuffix(".json") for f in files if f.endswith(".json"))

    def text(self, entity: str) -> str | None:
        """The contract's JSON text, None if the folder has none for ``entity``."""
        if self.remote:
            path, fs = self._hadoop(f"{entity}.json")
            if not fs.exists(path):
                return None
            stream = fs.open(path)
            try:
                return bytes(stream.readAllBytes()).decode("utf-8")
            finally:
                stream.close()
        file = Path(self.location, f"{entity}.json")
        return file.read_text(encoding="utf-8") if file.is_file() else None

    def __getitem__(self, entity: str) -> Contract:
        text = self.text(entity)
        if text is None:
            raise FileNotFoundError(f"{self.location} holds no contract called {entity!r}")
        return Contract.from_dict(json.loads(text))


def load_contract(entity: str, contracts_dir: str | Path | None = None) -> Contract:
    return ContractFolder(contracts_dir)[entity]


def available_contracts(contracts_dir: str | Path | None = None) -> list[str]:
    return ContractFolder(contracts_dir).entities()


def lint_contract(contract: Contract) -> list[str]:
    """Problems in the contract itself (an empty list means none)."""
    problems = []
    names = contract.names
    internal = sorted(n for n in names if n.startswith("__"))
    if internal:
        problems.append(f"names beginning with two underscores are kept for the gate: {internal}")
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        problems.append(f"duplicate column names: {dupes}")
    for c in contract.columns:
        if c.type not in STAGED_TYPES:
            problems.append(f"{c.name}: unknown type {c.type!r} is read as string")
        if c.has_min and c.has_max and c.min is not None and c.max is not None and c.min > c.max:
            problems.append(f"{c.name}: min {c.min} is above max {c.max}")
        if c.pattern is not None:
            try:
                java_pattern(c.pattern)
            except ValueError as err:
                problems.append(f"{c.name}: {err}")
    missing_pk = [k for k in contract.primary_key if k not in names]
    if missing_pk:
        problems.append(f"primary key columns not in the contract: {missing_pk}")
    return problems


def contracts_table(spark, contracts_dir: str | Path | None = None):
    """All contracts of a folder as one DataFrame, one row per contracted column:
    ``(entity, version, primary_key, position, name, type, nullable, min, max,
    allowed, pattern)``. Read with Spark's JSON reader, so the folder may live on
    any Hadoop file system; useful to audit or diff contract versions."""
    from pyspark.sql import functions as F

    base = str(contracts_dir) if contracts_dir is not None else str(PACKAGE_CONTRACTS / "bank")
    df = spark.read.option("multiLine", "true").json(f"{base.rstrip('/')}/*.json")
    cols = F.posexplode("columns").alias("position", "c")
    out = df.select("entity", "version", "primary_key", cols)

    def field(name, default=None):
        if name in out.schema["c"].dataType.names:
            return F.col(f"c.{name}")
        return F.lit(default)

    return out.select(
        "entity", "version", "primary_key", "position",
        F.col("c.name").alias("name"),
        F.coalesce(field("type"), F.lit("string")).alias("type"),
        F.coalesce(field("nullable"), F.lit(True)).alias("nullable"),
        field("min").cast("double").alias("min"),
        field("max").cast("double").alias("max"),
        field("allowed").cast("array<string>").alias("allowed"),
        field("pattern").cast("string").alias("pattern"),
    )
