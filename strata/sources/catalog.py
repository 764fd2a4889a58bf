"""Dataset registry (S4, S6): name -> path, format, layer, mode, upstream datasets; in code or from a JSON file."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Dataset:
    name: str
    path: str
    format: str = "parquet"
    layer: str = "silver"
    depends_on: tuple[str, ...] = field(default_factory=tuple)
    partition_columns: tuple[str, ...] = field(default_factory=tuple)
    mode: str = "overwrite"
    enabled: bool = True


class Catalog:
    """Named datasets; loads are lazy ``spark.read`` scans."""

    def __init__(self, datasets: Mapping[str, Dataset] | None = None):
        self.datasets: dict[str, Dataset] = dict(datasets or {})

    @classmethod
    def from_mapping(cls, spec: Mapping[str, Mapping]) -> Catalog:
        """From a parsed YAML-like mapping ``{name: {path, format, layer, depends_on}}``."""
        out = {}
        for name, d in spec.items():
            out[name] = Dataset(
                name=name, path=d["path"], format=d.get("format", "parquet"), layer=d.get("layer", "silver"),
                depends_on=tuple(d.get("depends_on", ())), partition_columns=tuple(d.get("partition_columns", ())),
                mode=d.get("mode", "overwrite"), enabled=bool(d.get("enabled", True)),
            )
        return cls(out)

    @classmethod
    def from_file(cls, spark: SparkSession, path: str, root: str = "") -> Catalog:
        """From a JSON file of that mapping, wherever Spark can read it; ``{root}`` in a path stands for ``root``."""
        spec = json.loads(spark.read.text(path, wholetext=True).first()[0])
        for d in spec.values():
            d["path"] = d["path"].replace("{root}", root)
        return cls.from_mapping(spec)

    def enabled(self, layer: str | None = None) -> list[Dataset]:
        """Enabled datasets, optionally of one layer, in the order they are listed."""
        return [d for d in self.datasets.values() if d.enabled and layer in (None, d.layer)]

    def add(self, ds: Dataset) -> Catalog:
        self.datasets[ds.name] = ds
        return self

    def __getitem__(self, name: str) -> Dataset:
        return self.datasets[name]

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        from strata.sinks.writer import read_table

        ds = self.datasets[name]
        return read_table(spark, ds.path, ds.format)

    def load_dependencies(self, spark: SparkSession, name: str) -> dict[str, DataFrame]:
        """Every upstream dataset of ``name``, loaded lazily, by name."""
        return {dep: self.load(spark, dep) for dep in self.datasets[name].depends_on}
