"""Writes: append, keyed merge, window replacement, versioned full reload."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.joins import update_from
from lectern.sources import manifest


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def merge_add(target: DataFrame, delta: DataFrame, keys: Sequence[str], value: str, text_keys: Sequence[str] = ()) -> DataFrame:
    """Keyed upsert in which matched values add up.

    In ``text_keys`` NULL equals the empty string; a matched row keeps the
    spelling of the target.
    """
    sides = [df.select(*keys, value, F.lit(own).alias("_own")) for df, own in ((target, True), (delta, False))]
    both = sides[0].unionByName(sides[1])
    rest = [k for k in keys if k not in text_keys]
    by = [F.coalesce(F.col(k), F.lit("")).alias(f"_{k}") for k in text_keys]
    was_null = {k: F.col(k).isNull().cast("int") for k in text_keys}
    merged = both.groupBy(*rest, *by).agg(
        F.sum(value).cast(target.schema[value].dataType).alias(value),
        *[
            F.coalesce(F.max(F.when(F.col("_own"), is_null)), F.max(is_null)).alias(f"_null_{k}")
            for k, is_null in was_null.items()
        ],
    )
    text = {k: F.when(F.col(f"_null_{k}") == 0, F.col(f"_{k}")) for k in text_keys}
    return merged.select(*[text[k].alias(k) if k in text else F.col(k) for k in keys], value)


def write_parts(df: DataFrame, path: str, part: str, sort_by: Sequence[str] = ()) -> None:
    """Write a new folder by partition; ``rebalance`` splits big partitions over several writers and merges small ones."""
    df.hint("rebalance", part).sortWithinPartitions(part, *sort_by).write.partitionBy(part).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` as it was last replaced."""
    return manifest.read(spark, path, "")


def _adopted(df: DataFrame, path: str, part: str) -> manifest.Manifest:
    """The manifest of the table at ``path``; without one, the partitions that are there now."""
    spark = df.sparkSession
    now = manifest.load(spark, path)
    if not now.tables:
        column, parts = manifest.parts_of(spark, path, "")
        now.tables[""] = manifest.Table(df.schema.json(), part, parts if column == part else {})
    return now


def replace_where(
    df: DataFrame, path: str, part: str, touched: Column, goes: Column, sort_by: Sequence[str] = ()
) -> None:
    """Delete stored rows that meet ``goes``, insert ``df``.

    Only the partitions selected by ``touched`` are read.  Their new rows go to new files, and one manifest
    publishes them all: readers (``stored``) see the table before or after, never between, and
    a second writer from the same version gets ``manifest.Conflict``.
    """
    spark = df.sparkSession
    now = _adopted(df, path, part)
    entry = now.tables[""]
    old = manifest.read(spark, path, "", now).filter(touched)
    run = f"run={uuid.uuid4().hex}"
    kept = old.filter(~F.coalesce(goes, F.lit(False)))
    write_parts(kept.unionByName(df.select(*kept.columns)), f"{path}/{run}", part, sort_by)
    parts = {v: paths for v, paths in entry.parts.items() if v not in manifest.values_within(spark, entry, touched)}
    column, new = manifest.parts_of(spark, path, run)
    for value, paths in new.items() if column else ():
        parts[value] = parts.get(value, []) + paths
    now.tables[""] = manifest.Table(entry.schema, part, parts)
    manifest.commit(spark, path, now)


def replace_window(
    df: DataFrame, path: str, day: str, ts: str, t0: dt.datetime, t1: dt.datetime, drop: Column | None = None
) -> None:
    """Replace the rows with ``ts`` in the closed window of a table stored by day.

    Rows not matching ``drop`` are kept.
    """
    kind = df.schema[ts].dataType.typeName()
    goes = F.col(ts).between(F.lit(t0).cast(kind), F.lit(t1).cast(kind))
    touched = F.col(day).between(F.lit(t0.date()), F.lit(t1.date()))
    replace_where(df, path, day, touched, goes if drop is None else goes & drop, [ts])


def counted_write(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> int:
    """Write once and count the rows from the files' footers."""
    out = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by) if partition_by else df
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


OBSERVED = "rows long, filled long, total decimal(38,4), chars long"


def _observed(df: DataFrame) -> list[Column]:
    """Rows, filled values, sum of all numbers and length of all texts of a table; time stamps are left out."""
    named = [(f.name, f.dataType.typeName()) for f in df.schema.fields if not f.dataType.typeName().startswith("timestamp")]
    zero = F.lit(0).cast("decimal(38,4)")
    kinds = {"byte", "short", "integer", "long", "decimal"}
    total = sum((F.coalesce(F.sum(F.col(c).cast("decimal(28,4)")), zero) for c, k in named if k in kinds), zero)
    chars = sum((F.coalesce(F.sum(F.length(c)), F.lit(0)) for c, k in named if k == "string"), F.lit(0))
    filled = sum((F.count(c) for c, _ in named), F.lit(0))
    return [
        F.count("*").alias("rows"), filled.cast("long").alias("filled"), total.cast("decimal(38,4)").alias("total"),
        chars.cast("long").alias("chars"),
    ]


def observed_write(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> dict[str, object]:
    """Write once and take row count and checksums on the way, in the tasks that write; nothing is read again."""
    out = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by) if partition_by else df
    seen = Observation()
    writer = out.observe(seen, *_observed(df)).write.mode("overwrite").option("compression", "zstd")
    writer.partitionBy(*partition_by).parquet(path)
    return seen.get


def full_reload(tables: dict[str, DataFrame], out: str, run: str, partition_by: dict[str, str] | None = None) -> DataFrame:
    """Write every table under a new run folder, then publish the run.

    Readers see the run only after its last table is complete, so a failure
    leaves the previous one in place.  Returns (table, rows).
    """
    partition_by = partition_by or {}
    counts = {}
    for name, df in tables.items():
        by = [partition_by[name]] if name in partition_by else []
        counts[name] = counted_write(df, f"{out}/{name}/run={run}", by)
    schemas = {name: df.schema for name, df in tables.items()}
    return publish(next(iter(tables.values())).sparkSession, out, run, counts, schemas)


def publish(
    spark: SparkSession, out: str, run: str, counts: Mapping[str, int | dict], schemas: Mapping[str, T.StructType],
    parts: Mapping[str, Sequence[object]] | None = None, base: manifest.Manifest | None = None,
) -> DataFrame:
    """Make the tables of a run the current ones, all by one manifest, which follows ``base`` (the newest, if not given).

    A table named in ``parts`` replaces only these values of its partition column; its
    other partitions stay those of earlier runs.  ``counts`` are row counts or the results of
    ``observed_write``, and come back as a table.
    """
    now = base or manifest.load(spark, out)
    for name in counts:
        part, written = manifest.parts_of(spark, out, f"{name}/run={run}")
        if parts and name in parts:
            old = now.tables[name]
            gone = {str(v) for v in parts[name]}
            kept = {v: paths for v, paths in old.parts.items() if v not in gone}
            now.tables[name] = manifest.Table(old.schema, old.part, kept | (written if part else {}))
        else:
            now.tables[name] = manifest.Table(schemas[name].json(), part, written)
    now.run = run
    manifest.commit(spark, out, now)
    if all(isinstance(n, int) for n in counts.values()):
        return spark.createDataFrame(list(counts.items()), "table string, rows long")
    kinds = T.StructType.fromDDL(f"table string, {OBSERVED}")
    return spark.createDataFrame([(name, *(seen[c] for c in kinds.names[1:])) for name, seen in counts.items()], kinds)


def current(spark: SparkSession, out: str, table: str, now: manifest.Manifest | None = None) -> DataFrame:
    """The table as last published: the partitions of its newest runs, by one scan."""
    return manifest.read(spark, out, table, now)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the file system that Spark writes to, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """One folder per micro-batch; a replayed batch overwrites its own folder."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    """Micro-batches whose folder is complete; one that is being written has no mark yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def latest_version(base: DataFrame, changes: DataFrame, key: str, assigned: Sequence[str]) -> DataFrame:
    """Base rows with the columns of their newest change; ``changes`` carries batch_id."""
    newest = changes.groupBy(key).agg(F.max(F.struct("batch_id", *assigned)).alias("_v"))
    newest = newest.select(key, *[F.col(f"_v.{c}").alias(f"_new_{c}") for c in assigned])
    return update_from(base, newest, key, {c: F.col(f"_new_{c}") for c in assigned})
