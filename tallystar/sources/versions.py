"""K2/K3 for tables that belong together: versioned folders and a manifest.

A run writes each table into a folder of its own version, partitioned by
``Year`` (``<root>/<table>/version=<id>/Year=<y>``). Nothing that readers see
changes until ``commit`` adds the next manifest, a small file that names the
year folders of every table; so all tables of a version appear together or
not at all, and a run that fails leaves the earlier version in place. A
refresh names the new folders of the years it wrote and the earlier ones of
all others: unchanged years are neither read nor copied.

A manifest is created exclusively under the next number: of two runs that
build on one version, the second fails. One that is not complete is no version
yet. Folders that no manifest names any more stay until someone removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def new_version() -> str:
    return uuid.uuid4().hex[:12]


def version_folder(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table}/version={version}"


def manifests(spark: SparkSession, root: str) -> list[dict]:
    """The complete manifests, oldest first."""
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    files = [n for n in _names(spark, folder) if n.endswith(".json") and not n.startswith((".", "_"))]
    out = []
    for name in files:
        row = spark.read.text(f"{folder}/{name}", wholetext=True).first()
        try:
            out.append(json.loads(row["value"]) | {"number": int(name.removesuffix(".json"))})
        except (json.JSONDecodeError, TypeError):  # being written, or left by a run that died
            continue
    return out


def current(spark: SparkSession, root: str) -> dict | None:
    found = manifests(spark, root)
    return found[-1] if found else None


def written_years(spark: SparkSession, root: str, folder: str) -> dict[str, str]:
    """Year to folder (relative to ``root``) of a written table."""
    base = root.rstrip("/") + "/"
    return {n.removeprefix("Year="): f"{folder.removeprefix(base)}/{n}" for n in _names(spark, folder) if n.startswith("Year=")}


def written_steps(spark: SparkSession, folder: str) -> list[str]:
    """The ``step=...`` folders of a written build."""
    return [n for n in _names(spark, folder) if n.startswith("step=")]


def commit(spark: SparkSession, root: str, written: Mapping[str, Sequence[str]], schemas: Mapping[str, StructType],
           refresh: bool = False, replaced: Mapping[str, Sequence[str]] | None = None) -> dict:
    """Make the written folders of each table the next version.

    With ``refresh``, the years of the last version that were not written stay;
    ``replaced`` names years of a table that go even if nothing was written for them."""
    root = root.rstrip("/")
    last = current(spark, root)
    tables: dict[str, list[list[str]]] = {}
    for table, folders in written.items():
        new = [[y, f] for folder in folders for y, f in written_years(spark, root, folder).items()]
        gone = {y for y, _ in new} | set((replaced or {}).get(table, ()))
        old = last["tables"].get(table, []) if refresh and last else []
        tables[table] = sorted([e for e in old if e[0] not in gone] + new)
    names = [n for n in _names(spark, f"{root}/{MANIFESTS}") if n.endswith(".json")]
    number = max([int(n.removesuffix(".json")) for n in names], default=0) + 1
    if last and number != last["number"] + 1 and refresh:
        raise RuntimeError(f"another run is committing to {root}")
    body = {"tables": tables, "schemas": {t: s.jsonValue() for t, s in schemas.items()}}
    fs, p = _fs(spark, f"{root}/{MANIFESTS}/{number:08d}.json")
    out = fs.create(p, False)  # fails if another run was first
    try:
        out.write(bytearray(json.dumps(body).encode()))
    finally:
        out.close()
    return body | {"number": number}


def read_table(spark: SparkSession, root: str, table: str, number: int | None = None) -> DataFrame:
    """A table of the last version, or of version ``number``."""
    root = root.rstrip("/")
    found = [m for m in manifests(spark, root) if number is None or m["number"] == number]
    if not found:
        raise ValueError(f"no such version: {root} {number or ''}")
    schema = StructType.fromJson(found[-1]["schemas"][table])
    folders = [f"{root}/{f}" for _, f in found[-1]["tables"].get(table, [])]
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{root}/{found[-1]['tables'][table][0][1].split('/')[0]}"
    return spark.read.option("basePath", base).schema(schema).parquet(*folders).select(*schema.fieldNames())
