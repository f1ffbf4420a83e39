"""Published tables: a numbered manifest names the folders that make up each table.

Data files are only ever added, in folders of their own; what readers see is the newest manifest.  A writer
reads manifest N, writes its folders and creates manifest N + 1 under a name that
must not exist yet, so of two writers that began from the same manifest the second is refused
(``Conflict``) and the table stays as the first one left it.  A failure before that leaves the table
whole.  A manifest is as large as the number of partitions, not of rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLDER = "_manifest"
WHOLE = ""  # the one part of a table without partitions


class Conflict(RuntimeError):
    """Another writer has published first."""


@dataclass
class Table:
    """``parts``: folders of each partition value, relative to the root; ``schema`` as JSON."""

    schema: str
    part: str | None = None
    parts: dict[str, list[str]] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass
class Manifest:
    version: int = 0
    run: str | None = None
    tables: dict[str, Table] = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    where = _path(spark, path)
    system = _system(spark, where)
    if not system.exists(where):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(where) if f.isDirectory())


def newest(spark: SparkSession, root: str) -> int:
    where = _path(spark, f"{root}/{FOLDER}")
    system = _system(spark, where)
    if not system.exists(where):
        return 0
    names = [f.getPath().getName() for f in system.listStatus(where)]
    return max((int(n.removesuffix(".json")) for n in names if n[0].isdigit()), default=0)


def load(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest (or an earlier) manifest; an empty one before the first publication.  Nothing is written."""
    version = newest(spark, root) if version is None else version
    if not version:
        return Manifest()
    file = _path(spark, f"{root}/{FOLDER}/{version:012d}.json")
    stream = _system(spark, file).open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    content = json.loads(text)
    return Manifest(version, content["run"], {name: Table(**t) for name, t in content["tables"].items()})


def commit(spark: SparkSession, root: str, manifest: Manifest) -> Manifest:
    """Publish ``manifest`` as the successor of the version it was read as."""
    version = manifest.version + 1
    text = json.dumps({"run": manifest.run, "tables": {n: vars(t) for n, t in manifest.tables.items()}}, sort_keys=True)
    draft, final = (_path(spark, f"{root}/{FOLDER}/{n}") for n in (f".draft-{uuid.uuid4().hex}", f"{version:012d}.json"))
    system = _system(spark, draft)
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        # A rename without overwriting, which fails if the name is taken.
        hadoop = spark._jvm.org.apache.hadoop.fs
        options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
        context.rename(system.makeQualified(draft), system.makeQualified(final), options)
    except Exception as error:
        system.delete(draft, False)
        if system.exists(final):
            raise Conflict(f"version {version} of {root} was published by another writer") from error
        raise
    return Manifest(version, manifest.run, manifest.tables)


def parts_of(spark: SparkSession, root: str, folder: str) -> tuple[str | None, dict[str, list[str]]]:
    """Partition column and folders of what has been written to a folder."""
    named = [n for n in folders(spark, f"{root}/{folder}") if "=" in n and not n.startswith(("_", "."))]
    if not named:
        return None, {WHOLE: [folder]}
    column = named[0].split("=", 1)[0]
    return column, {unquote(n.split("=", 1)[1]): [f"{folder}/{n}" if folder else n] for n in named}


def read(spark: SparkSession, root: str, table: str, manifest: Manifest | None = None) -> DataFrame:
    """The table as the newest (or given) manifest names it: one scan of the folders of all runs."""
    manifest = manifest or load(spark, root)
    if table not in manifest.tables:
        raise ValueError(f"{table or root} has not been published")
    entry = manifest.tables[table]
    struct = entry.struct
    # Folders of runs lie below ``run=``, those of a table that was stored without a manifest do not: two scans at most.
    named: dict[str, list[str]] = {}
    for path in sum(entry.parts.values(), []):
        named.setdefault(path.rpartition("run=")[0] if "run=" in path else path.rpartition("/")[0] + "/.", []).append(path)
    if not named:
        return spark.createDataFrame([], struct)
    scans = []
    for base, paths in named.items():
        reader = spark.read.schema(struct)
        if entry.part is not None:
            reader = reader.option("basePath", f"{root}/{base.removesuffix('/.')}".rstrip("/"))
        scans.append(reader.parquet(*[f"{root}/{path}" for path in paths]).select(*struct.names))
    return reduce(DataFrame.unionByName, scans)


def values_within(spark: SparkSession, entry: Table, condition) -> set[str]:
    """Partition values of a table that meet a condition on its partition column."""
    kind = entry.struct[entry.part].dataType
    values = spark.createDataFrame([(v,) for v in entry.parts], "text string")
    return {r["text"] for r in values.withColumn(entry.part, values["text"].cast(kind)).filter(condition).collect()}
