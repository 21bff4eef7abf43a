"""Namespaces and materialisation: views over raw tables, stored relations.

Layers map to namespaces ``raw``, ``staging``, ``intermediate``, ``marts``
under one warehouse root in the shared folder. A model's custom schema name
is used verbatim (trimmed); without one it lands in the target default.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.snapshots import drop_folder, file_system

LAYER_SCHEMA = {"raw": "raw", "staging": "staging", "intermediate": "intermediate", "marts": "marts"}


def schema_name(custom: str | None, default: str) -> str:
    """Custom schema verbatim (trimmed), else the target's default schema."""
    return custom.strip() if custom and custom.strip() else default


class Catalog:
    def __init__(self, spark: SparkSession, root: str, default_schema: str = "public"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.default_schema = default_schema
        self.tables: dict[str, str] = {}

    def namespace(self, layer: str) -> str:
        return schema_name(LAYER_SCHEMA.get(layer), self.default_schema)

    def location(self, layer: str, name: str) -> str:
        return os.path.join(self.root, self.namespace(layer), name)

    def checkpoint_location(self, name: str) -> str:
        return os.path.join(self.root, "_checkpoints", name)

    def ensure_namespace(self, layer: str) -> str:
        """CREATE SCHEMA IF NOT EXISTS (a database in Spark's catalog)."""
        ns = self.namespace(layer)
        loc = os.path.join(self.root, ns)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{ns}` LOCATION '{loc}'")
        return ns

    def ensure_namespaces(self) -> None:
        for layer in LAYER_SCHEMA:
            self.ensure_namespace(layer)

    def register_table(self, layer: str, name: str, df: DataFrame, path: str) -> DataFrame:
        """Make a stored table addressable as ``<namespace>.<name>``. An entry
        with the same columns is pointed at ``path`` in one step; readers see
        the old version or the new one. With other columns the new entry is
        made under another name first and then takes the old one's, so the old
        entry stays until the new one exists."""
        ns = self.ensure_namespace(layer)
        full = f"`{ns}`.`{name}`"
        self.tables[f"{ns}.{name}"] = path
        kind = self._kind(ns, name)
        if kind == "EXTERNAL":
            old = self.spark.table(f"{ns}.{name}")
            if [(f.name, f.dataType) for f in old.schema] == [(f.name, f.dataType) for f in df.schema]:
                self.spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(f"{ns}.{name}")
                return df
        fresh = name if kind is None else f"{name}__{uuid.uuid4().hex[:8]}"
        self.spark.catalog.createTable(f"{ns}.{fresh}", path=path, source="parquet", schema=df.schema)
        if kind is not None:
            self.spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {full}")
            self.spark.sql(f"ALTER TABLE `{ns}`.`{fresh}` RENAME TO {full}")
        return df

    def register_folders(self, layer: str, name: str, df: DataFrame, paths: list[str]) -> DataFrame:
        """A table over one folder, or a view over all of a relation's folders."""
        if len(paths) == 1:
            return self.register_table(layer, name, df, paths[0])
        ns = self.ensure_namespace(layer)
        columns = ", ".join(f"`{c}`" for c in df.columns)
        body = " UNION ALL ".join(f"SELECT {columns} FROM parquet.`{p}`" for p in paths) or \
            "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema) + " WHERE FALSE"
        self._replace_view(ns, name, body)
        return df

    def _kind(self, ns: str, name: str) -> str | None:
        """Table type of an entry, None if there is none."""
        return self.spark.catalog.getTable(f"{ns}.{name}").tableType if self.spark.catalog.tableExists(f"{ns}.{name}") else None

    def _replace_view(self, ns: str, name: str, body: str) -> None:
        if self._kind(ns, name) not in (None, "VIEW"):
            self.spark.sql(f"DROP TABLE `{ns}`.`{name}`")
        self.spark.sql(f"CREATE OR REPLACE VIEW `{ns}`.`{name}` AS {body}")

    def write_candidate(self, layer: str, name: str, df: DataFrame) -> tuple[str, DataFrame]:
        """A version that no entry points at yet: its folder and its rows."""
        path = os.path.join(self.location(layer, name), f"v-{uuid.uuid4().hex[:12]}")
        df.write.option("compression", "zstd").parquet(path)
        return path, self.spark.read.schema(df.schema).parquet(path)

    def write_table(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """CREATE OR REPLACE TABLE … AS: written to a version folder of its own,
        then the entry is repointed, so a failed rebuild leaves the last good
        table in place. The version before the last one is removed."""
        last = self._versions(self.location(layer, name))
        path, stored = self.write_candidate(layer, name, df)
        self.register_table(layer, name, stored, path)
        for old in last[:-1]:
            drop_folder(self.spark, old)
        return stored

    def _versions(self, home: str) -> list[str]:
        """Version folders, the oldest first."""
        fs, p = file_system(self.spark, home)
        if not fs.exists(p):
            return []
        found = [x for x in fs.listStatus(p) if x.getPath().getName().startswith("v-")]
        return [x.getPath().toString() for x in sorted(found, key=lambda x: x.getModificationTime())]

    def register_view(self, layer: str, name: str, source: str, df: DataFrame) -> DataFrame:
        """CREATE OR REPLACE VIEW ``<namespace>.<name>``: the columns of ``df``
        from the table ``source`` (a model that renames or computes nothing)."""
        ns = self.ensure_namespace(layer)
        columns = ", ".join(f"`{c}`" for c in df.columns)
        self._replace_view(ns, name, f"SELECT {columns} FROM {source}")
        return self.spark.table(f"{ns}.{name}")
