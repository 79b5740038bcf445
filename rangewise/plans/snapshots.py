"""Snapshots: one manifest names the folders of all eight tables.

A commit is one new file, ``{folder}/{version}.json``, put only if it is absent:
the manifest is written beside it and moved into place by a rename that
refuses to replace. So a reader sees all tables of one version or of another,
never a mix, and of two writers of a version one fails. On a store without such
a rename (most object stores) writers must not run at the same time.

Old versions stay until ``retain`` removes their manifests first and then the
table folders that no manifest left names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rangewise.plans.model import Warehouse
from rangewise.schemas import PRODUCTION, SCHEMAS, STAGING
from rangewise.sources.fixtures import DEFAULT_SCOPE, ClassScope, RawTables


class Conflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    tables: dict[str, str]  # "layer.table" -> folder

    def frame(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[(layer, name)]).parquet(self.tables[f"{layer}.{name}"])

    def warehouse(self, spark: SparkSession, scope: ClassScope = DEFAULT_SCOPE) -> Warehouse:
        """All tables of this version, whatever is committed later."""
        names = ("taxa_raw", "observations_raw", "observers_raw", "species_geospatial_raw")
        raw = RawTables(**{n: (lambda n=n: self.frame(spark, STAGING, n)) for n in names})
        return Warehouse(raw, scope, tables={
            n: self.frame(spark, PRODUCTION, n)
            for n in ("taxa", "species_geospatial", "species_observations", "observers")})


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, folder: str):
    path = _path(spark, folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The committed versions, in order."""
    fs, path = _files(spark, folder)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _file(folder: str, version: int) -> str:
    return f"{folder}/{version:012d}.json"


def snapshot(spark: SparkSession, folder: str, version: int | None = None) -> Snapshot | None:
    """A version (by default the latest; None if nothing is committed)."""
    if version is None:
        known = versions(spark, folder)
        if not known:
            return None
        version = known[-1]
    text = spark.read.text(_file(folder, version), wholetext=True).first()["value"]
    return Snapshot(version, json.loads(text))


def commit(spark: SparkSession, folder: str, root: str, after: int | None = None) -> Snapshot:
    """Commit the tables written under ``root`` as the version after
    ``after`` (by default after the latest). Every table must be there."""
    tables = {f"{layer}.{name}": f"{root}/{layer}/{name}" for layer, name in SCHEMAS}
    fs, path = _files(spark, folder)
    for name, place in tables.items():
        if not fs.exists(_path(spark, f"{place}/_SUCCESS")):
            raise FileNotFoundError(f"{name} is not written whole at {place}")
    if after is None:
        after = (versions(spark, folder) or [0])[-1]
    fs.mkdirs(path)
    jvm = spark._jvm
    place = _path(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(place, False)
    out.write(json.dumps(tables, sort_keys=True, indent=1).encode())
    out.close()
    keep = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").NONE
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = keep
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(place, _path(spark, _file(folder, after + 1)), options)
    except Exception as e:
        fs.delete(place, False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"version {after + 1} is committed already") from e
        raise
    return Snapshot(after + 1, tables)


def retain(spark: SparkSession, folder: str, keep: int = 3) -> list[str]:
    """Keep the last ``keep`` versions. Returns the table folders deleted:
    those of older versions that no kept one names."""
    if keep < 1:
        raise ValueError("at least one version must stay")
    known = versions(spark, folder)
    old, kept = known[:-keep], known[-keep:]
    used = {p for v in kept for p in snapshot(spark, folder, v).tables.values()}
    gone = sorted({p for v in old for p in snapshot(spark, folder, v).tables.values()} - used)
    fs, _ = _files(spark, folder)
    for v in old:
        fs.delete(_path(spark, _file(folder, v)), False)
    for p in gone:
        fs.delete(_path(spark, p), True)
    return gone
