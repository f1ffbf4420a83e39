"""Structured Streaming jobs.

Every sink writes one folder per micro-batch (``batch_id=N``).  A batch that is
replayed after a failure overwrites its own folder, so nothing is added twice,
and no batch rewrites what earlier ones wrote.  Readers fold the folders.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.aggregates import minute_counts, payments_rollup, weighted_mean
from lectern.operators.integrity import CrossTable
from lectern.operators.joins import having_key
from lectern.operators.sets import union_all
from lectern.plans.bulk import apply_payments, code_events
from lectern.session import stage
from lectern.sources import manifest
from lectern.sources.scan import fill_defaults
from lectern.streaming import grade_state
from lectern.sources.sinks import (
    committed_batches, current, full_reload, latest_version, merge_add, write_batch,
)

METRIC_KEYS = ("MetricName", "MetricMinute", "Dimension1", "Dimension2")


def _run(df: DataFrame, step: Callable[[DataFrame, int], None], ckpt: str, mode: str, trigger: dict) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(step)
        .outputMode(mode)
        .option("checkpointLocation", ckpt)
        .trigger(**trigger)
        .start()
    )


# ---- minute metric ----------------------------------------------------------
def stream_minute_counts(src: DataFrame, types: DataFrame, out: str, ckpt: str, **trigger) -> StreamingQuery:
    """Per batch: events per minute, code and source, stored as increments.  Any lateness is accepted."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(minute_counts(batch, types), out, batch_id)

    return _run(src, step, ckpt, "append", trigger or {"availableNow": True})


def read_minute_metric(
    spark: SparkSession, out: str, base: DataFrame | None = None, after: int = -1, upto: int | None = None
) -> DataFrame:
    """The increments of batches in (after, upto] added up, on top of an earlier metric table if given."""
    parts = spark.read.parquet(out).filter(F.col("batch_id") > after)
    if upto is not None:
        parts = parts.filter(F.col("batch_id") <= upto)
    start = parts.limit(0) if base is None else base
    return merge_add(start, parts, METRIC_KEYS, "MetricValue", ["Dimension1", "Dimension2"])


def fold_minute_metric(spark: SparkSession, out: str, store: str) -> int:
    """Add the committed increments so far to the published table in ``store``; returns the last batch folded.

    Run it now and then while the stream goes on: the published run is named by
    its last batch, so later readers add only what came after.
    """
    upto = max(committed_batches(spark, out), default=-1)
    done = folded_upto(spark, store)
    if done < upto:
        base = None if done < 0 else current(spark, store, "MetricMinute")
        metric = read_minute_metric(spark, out, base, done, upto)
        full_reload({"MetricMinute": metric}, store, f"{upto:012d}")
    return upto


def folded_upto(spark: SparkSession, store: str) -> int:
    last = manifest.load(spark, store).run
    return -1 if last is None else int(last)


def folded_minute_metric(spark: SparkSession, out: str, store: str) -> DataFrame:
    """Published table plus the increments that came later."""
    return read_minute_metric(spark, out, current(spark, store, "MetricMinute"), folded_upto(spark, store))


def windowed_counts(events: DataFrame, types: DataFrame, delay: str) -> DataFrame:
    """Tumbling one-minute windows with bounded lateness; on a stream only closed windows come out."""
    timed = events.withColumn("_ts", F.col("OccurredAt").cast("timestamp")).withWatermark("_ts", delay)
    named = timed.join(types.select("EventTypeID", "EventCode"), "EventTypeID")
    counts = named.groupBy(F.window("_ts", "1 minute").alias("_w"), "EventCode", "SourceSystem").count()
    return counts.select(
        F.lit("EVENT_COUNT").alias("MetricName"),
        F.col("_w.start").cast("timestamp_ntz").alias("MetricMinute"),
        F.col("EventCode").alias("Dimension1"),
        F.col("SourceSystem").alias("Dimension2"),
        F.col("count").cast("decimal(18,4)").alias("MetricValue"),
    )


def stream_minute_windowed(src: DataFrame, types: DataFrame, delay: str, out: str, ckpt: str, **trigger) -> StreamingQuery:
    return (
        windowed_counts(src, types, delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", ckpt)
        .trigger(**(trigger or {"availableNow": True}))
        .start(out)
    )


# ---- payments ---------------------------------------------------------------
def stream_payment_rollup(
    src: DataFrame, history: DataFrame | None, instalments: DataFrame, as_of: dt.date, out: str, ckpt: str, **trigger
) -> StreamingQuery:
    """Touched instalments with their totals so far, one folder per batch.

    The running sum and last time of each instalment live in the state store, so
    a batch costs its own payments and instalments, not a rescan of all payments.
    ``history`` holds payments from before the stream; it is totalled once and written, so
    no batch reads the payments themselves.
    """
    running = payments_rollup(src)
    past = None if history is None else stage(payments_rollup(history), "payment-history")

    def step(batch: DataFrame, batch_id: int) -> None:
        # Stored first: the state of the batch is then computed exactly once.
        write_batch(batch, f"{out}/totals", batch_id)
        spark = batch.sparkSession
        totals = spark.read.schema(batch.schema).parquet(f"{out}/totals/batch_id={batch_id}")
        if past is not None:
            totals = totals.unionByName(having_key(past, totals, "ParcelaID")).groupBy("ParcelaID").agg(
                F.sum("TotalPago").alias("TotalPago"), F.max("UltimoPagamento").alias("UltimoPagamento")
            )
        touched = apply_payments(having_key(instalments, totals, "ParcelaID"), totals, as_of)
        changed = touched.select("ParcelaID", "ValorPago", "DataPagamento", "StatusParcela")
        write_batch(changed, f"{out}/instalments", batch_id)

    return _run(running, step, ckpt, "update", trigger or {"availableNow": True})


def read_instalments(spark: SparkSession, instalments: DataFrame, out: str, store: str | None = None) -> DataFrame:
    """Instalments with their newest changes; ``store`` is where ``compact_changes`` has merged earlier ones."""
    changes = read_changes(spark, f"{out}/instalments", store)
    if changes is None:
        return instalments
    return latest_version(instalments, changes, "ParcelaID", ["ValorPago", "DataPagamento", "StatusParcela"])


# ---- compaction -------------------------------------------------------------
CHANGES = "changes"


def _batches(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={n}" for n in ids])
    return rows.withColumn("batch_id", F.col("batch_id").cast("long"))


def read_changes(spark: SparkSession, path: str, store: str | None = None) -> DataFrame | None:
    """Rows of the merged pieces in ``store`` and of the later batch folders, with batch_id; None before the first."""
    now = manifest.Manifest() if store is None else manifest.load(spark, store)
    later = [n for n in committed_batches(spark, path) if n > int(now.run or -1)]
    found = [manifest.read(spark, store, CHANGES, now)] if CHANGES in now.tables else []
    found += [_batches(spark, path, later)] if later else []
    return union_all(*found) if found else None


def compact_changes(spark: SparkSession, path: str, store: str, key: str, fan: int = 4) -> int:
    """Merge the committed batches so far into pieces of growing size; returns the last batch merged.

    A log-structured merge: the new batches become one piece of level 0 with the newest version of each ``key``,
    and ``fan`` pieces of a level become one of the next, so a row is rewritten once a level and after
    n runs of this job there are fewer than fan * log(n) pieces to read.  All goes to
    new folders and is published by one manifest: the stream and readers go on meanwhile, and of two compactions at
    once the second is refused.
    """
    now = manifest.load(spark, store)
    new = [n for n in committed_batches(spark, path) if n > int(now.run or -1)]
    if not new:
        return int(now.run or -1)
    pieces = dict(now.tables[CHANGES].parts) if CHANGES in now.tables else {}

    def merged(rows: DataFrame, level: int, low: int, high: int) -> None:
        others = [c for c in rows.columns if c not in (key, "batch_id")]
        newest = rows.groupBy(key).agg(F.max(F.struct("batch_id", *others)).alias("_v")).select(key, "_v.*")
        folder = f"{CHANGES}/run={level}-{low}-{high}-{uuid.uuid4().hex}"
        newest.select(*rows.columns).write.parquet(f"{store}/{folder}")
        pieces[f"{level}:{low}:{high}"] = [folder]
        now.tables[CHANGES] = manifest.Table(rows.schema.json(), None, pieces)

    merged(_batches(spark, path, new), 0, new[0], new[-1])
    level = 0
    while len(full := [p for p in pieces if p.startswith(f"{level}:")]) >= fan:
        bounds = [int(n) for p in full for n in p.split(":")[1:]]
        part = manifest.Table(now.tables[CHANGES].schema, None, {p: pieces.pop(p) for p in full})
        rows = manifest.read(spark, store, CHANGES, manifest.Manifest(0, None, {CHANGES: part}))
        merged(rows, level + 1, min(bounds), max(bounds))
        level += 1
    now.run = str(new[-1])
    manifest.commit(spark, store, now)
    return new[-1]


# ---- grades -----------------------------------------------------------------
UPDATED = "UltimaAtualizacao"


@dataclass
class Chain:
    """Streaming queries of which each follows what the one before has written."""

    queries: list[StreamingQuery]

    def awaitTermination(self) -> None:
        for q in self.queries:
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def initial_grades(enrolments: DataFrame, history: DataFrame | None, assessments: DataFrame) -> DataFrame:
    """One row per enrolment with its outcome and the newest earlier grade of each of its assessments."""
    posted = F.col(UPDATED) if UPDATED in enrolments.columns else F.lit(None)
    base = enrolments.select(
        "MatriculaID", F.lit(True).alias("known"), F.col("FrequenciaPercentual").cast("decimal(5,2)").alias("FrequenciaPercentual"),
        F.col("NotaFinal").cast("decimal(5,2)").alias("NotaFinal"), "StatusMatricula", posted.cast("timestamp_ntz").alias("posted"),
    )
    if history is None:
        grade = T.StructType([assessments.schema["AvaliacaoID"]]).add("batch_id", "long").add("LancadaEm", "timestamp_ntz")
        grade = grade.add("NotaObtida", "decimal(5,2)").add("Peso", "decimal(5,2)")
        return base.withColumn("grades", F.lit(None).cast(T.ArrayType(grade)))
    history = with_weights(history, assessments)
    newest = history.groupBy("MatriculaID", "AvaliacaoID").agg(F.max(F.struct("LancadaEm", "NotaObtida", "Peso")).alias("v"))
    grade = F.struct("AvaliacaoID", F.lit(-1).cast("long").alias("batch_id"), "v.*")
    return base.join(newest.groupBy("MatriculaID").agg(F.collect_list(grade).alias("grades")), "MatriculaID", "left")


GROUP_ROWS = 256  # enrolments whose state is kept together, on average: to read and write them takes no longer than the calls


def state_groups(enrolments: DataFrame, ckpt: str) -> int:
    """Number of groups of enrolments: taken at the first start and kept beside the state, whose keys depend on it."""
    spark, path = enrolments.sparkSession, f"{ckpt}/groups"
    if not committed_batches(spark, path):
        groups = enrolments.agg(F.ceil(F.greatest(F.count("*"), F.lit(1)) / GROUP_ROWS).alias("groups"))
        write_batch(groups, path, 0)
    return spark.read.parquet(path).first()["groups"]


def in_groups(df: DataFrame, groups: int) -> DataFrame:
    """Rows with ``_group``, which does not depend on the kind of number that identifies an enrolment."""
    return df.withColumn("_group", F.pmod(F.xxhash64(F.col("MatriculaID").cast("string")), F.lit(groups)))


def final_grades(grades: DataFrame, assessments: DataFrame) -> DataFrame:
    """Weighted mean per enrolment."""
    weighted = grades.select("MatriculaID", "AvaliacaoID", "NotaObtida").join(
        assessments.select("AvaliacaoID", "Peso"), "AvaliacaoID"
    )
    return weighted_mean(weighted, "MatriculaID", "NotaObtida", "Peso", "_final")


def with_weights(grades: DataFrame, assessments: DataFrame) -> DataFrame:
    """Grades with the weight of their assessment, NULL if it is unknown."""
    weights = assessments.select("AvaliacaoID", F.col("Peso").cast("decimal(5,2)").alias("Peso"))
    return grades.select(
        "MatriculaID", "AvaliacaoID", F.col("NotaObtida").cast("decimal(5,2)").alias("NotaObtida"),
        F.col("LancadaEm").cast("timestamp_ntz").alias("LancadaEm"),
    ).join(weights, "AvaliacaoID", "left")


def stream_grade_derive(
    src: DataFrame, history: DataFrame | None, assessments: DataFrame, enrolments: DataFrame, out: str, ckpt: str,
    reject: str = "row", max_files: int = 1000, **trigger,
) -> Chain:
    """New and changed grades → touched enrolments recomputed from all their grades.

    Two queries.  The first checks each batch and writes its accepted grades with their weights to ``out/grades``;
    a grade above the assessment's maximum is left out, or its whole batch with ``reject="batch"``.  The second follows
    that log and keeps the newest grade of each assessment of an enrolment in keyed state (``GradeState``), in groups of
    about ``GROUP_ROWS`` enrolments, so a batch reads its own rows and the state of their groups, whatever came before.
    Changed enrolments go to ``out/enrolments``.  ``enrolments`` and ``history``, grades from before the stream, become
    the initial state when the stream first starts; enrolments added later have no outcome until
    it is started anew.  ``max_files`` bounds a batch of the second query.  A recomputed enrolment has the time of its newest grade as ``UltimaAtualizacao``.
    """
    spark = enrolments.sparkSession
    trigger = trigger or {"availableNow": True}
    limit = CrossTable("grade-limit", "limits", "AvaliacaoID", "NotaObtida", "NotaMaxima", reject)
    grades_path = f"{out}/grades"

    def accept(batch: DataFrame, batch_id: int) -> None:
        bad = limit.violations(batch, {"limits": assessments}).select("AvaliacaoID", "MatriculaID").distinct()
        good = batch.join(bad, ["AvaliacaoID", "MatriculaID"], "left_anti")
        write_batch(with_weights(good, assessments), grades_path, batch_id)

    def changed(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumnRenamed("posted", UPDATED), f"{out}/enrolments", batch_id)

    accepted = _run(src, accept, f"{ckpt}/accept", "append", trigger)
    if "availableNow" in trigger:
        accepted.awaitTermination()
    kinds = with_weights(src, assessments).schema.add("batch_id", "long")
    # Files of a batch that is accepted again are replaced by equal ones under other names.
    log = spark.readStream.schema(kinds).option("ignoreMissingFiles", "true").option("maxFilesPerTrigger", max_files)
    groups = state_groups(enrolments, ckpt)
    initial = initial_grades(enrolments, history, assessments)
    members = F.to_json(F.collect_list(grade_state.member(F.col("grades")))).alias("members")
    identity = initial.schema["MatriculaID"].dataType
    initial = in_groups(initial, groups).groupBy("_group").agg(members)
    arriving = grade_state.arriving(in_groups(log.parquet(grades_path), groups))
    derived = arriving.groupBy("_group").transformWithState(
        grade_state.GradeState(), grade_state.OUTCOMES, "update", "none", initial.groupBy("_group")
    )
    derived = grade_state.decoded(derived, identity)
    return Chain([accepted, _run(derived, changed, f"{ckpt}/derive", "update", trigger)])


def read_enrolments(spark: SparkSession, enrolments: DataFrame, out: str, store: str | None = None) -> DataFrame:
    """Enrolments with their newest outcomes; ``store`` is where ``compact_changes`` has merged earlier ones."""
    changes = read_changes(spark, f"{out}/enrolments", store)
    if changes is None:
        return enrolments
    updated = [UPDATED] if UPDATED in enrolments.columns else []
    return latest_version(enrolments, changes, "MatriculaID", ["NotaFinal", "StatusMatricula", *updated])


# ---- events -----------------------------------------------------------------
def stream_event_ingest(
    src: DataFrame, types: DataFrame, as_of: dt.datetime, out: str, ckpt: str, **trigger
) -> StreamingQuery:
    """Checked events, good and bad ones apart (``route=good`` / ``route=bad``), in one write per batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        coded = code_events(batch, types)
        defaults = {"OccurredAt": "@now", "IngestedAt": "@now", "CorrelationID": "@uuid", "ProcessingStatus": "N"}
        routed = fill_defaults(coded, defaults, as_of).withColumn(
            "route", F.when(F.col("Codigo").isNull(), "good").otherwise("bad")
        )
        write_batch(routed, out, batch_id, ["route"])

    return _run(src, step, ckpt, "append", trigger or {"availableNow": True})


def read_events(spark: SparkSession, out: str, route: str) -> DataFrame:
    return spark.read.parquet(out).filter(F.col("route") == route).drop("route", "batch_id")
