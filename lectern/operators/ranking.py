"""Rankings within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.skew import null_safe_join, numbered, slice_cuts, sliced
from lectern.session import stage

# Output names of the six measures.
ROW_NUMBER, RANK, DENSE_RANK, NTILE, LAG, LEAD = (
    "RowNumberTurma", "RankTurma", "DenseRankTurma", "Quartil", "NotaAnterior", "NotaSeguinte",
)
ALL = (ROW_NUMBER, RANK, DENSE_RANK, NTILE, LAG, LEAD)


def first_classes(enrolments: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The classes with the ``k`` smallest codes that have a graded enrolment: they hold the first k rows of a ranking by code."""
    graded = enrolments.filter(F.col("NotaFinal").isNotNull()).select("TurmaID").distinct()
    codes = classes.join(graded, "TurmaID", "left_semi").select("CodigoTurma").distinct()
    return null_safe_join(classes, codes.orderBy("CodigoTurma").limit(k), ["CodigoTurma"], "left_semi")


def windows_within(
    df: DataFrame, key: str, value: str, ties: Sequence[str], tiles: int = 4, want: Sequence[str] = ALL
) -> DataFrame:
    """The measures of ``rank_within`` as plain windows: lazy, but each group is sorted in one task."""
    # The full order comes first: its sort also serves the order by value alone.
    full = Window.partitionBy(key).orderBy(F.col(value).desc(), *ties)
    plain = Window.partitionBy(key).orderBy(F.col(value).desc())
    measures = {
        ROW_NUMBER: F.row_number().over(full).cast("long"),
        NTILE: F.ntile(tiles).over(full).cast("long"),
        LAG: F.lag(value).over(full),
        LEAD: F.lead(value).over(full),
        RANK: F.rank().over(plain).cast("long"),
        DENSE_RANK: F.dense_rank().over(plain).cast("long"),
    }
    return df.withColumns({name: measures[name] for name in measures if name in want})


def _tile(position: Column, total: Column, tiles: int) -> Column:
    """Tile of a position when the first ``total mod tiles`` tiles are one longer."""
    size = F.floor(total / tiles)
    extra = total % tiles
    in_long = extra * (size + 1)
    long_tile = F.floor((position - 1) / (size + 1)) + 1
    short_tile = extra + F.floor((position - 1 - in_long) / F.nullif(size, F.lit(0))) + 1
    return F.when(position <= in_long, long_tile).otherwise(short_tile).cast("long")


def _place(key: str, value: str, ties: Sequence[str]) -> Column:
    """A struct that compares as the rows are ordered: highest value first, then those without one."""
    return F.struct(F.col(key).alias("key"), F.col(value).isNull().alias("none"), (-F.col(value)).alias("value"), *numbered(ties))


def _carries(rows: DataFrame, cuts: DataFrame, key: str, value: str) -> DataFrame:
    """What a slice of a key needs to know of the key's other slices: one row per (slice, key) of keys that are cut.

    Counts of equal values are combined before the shuffle; the windows see one row for each slice.
    """
    cut_keys = cuts.select(F.explode("cuts.key").alias(key)).distinct()
    levels = null_safe_join(rows.select("_slice", key, value), cut_keys, [key], "left_semi")
    levels = levels.groupBy("_slice", key, value).agg(F.count("*").alias("n"))
    order = F.struct(F.col(value).isNotNull(), F.col(value))
    runs = levels.groupBy("_slice", key).agg(
        F.sum("n").alias("n"), F.count("*").alias("values"), F.max_by(value, order).alias("first"),
        F.min_by(value, order).alias("last"), F.min_by("n", order).alias("n_last"),
    )
    by_slice = Window.partitionBy(key).orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({
        "_before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        "_total": F.sum("n").over(Window.partitionBy(key)),
        "_has_before": F.lag(F.lit(True), 1, False).over(by_slice),
        "_value_before": F.lag("last").over(by_slice),
        "_value_after": F.lead("first").over(by_slice),
    }).withColumn("_goes_on", F.col("_has_before") & F.col("first").eqNullSafe(F.col("_value_before")))
    # Rows ahead of the first row with the slice's last value, which may lie in an earlier slice.
    same_last = Window.partitionBy(key, "last").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("ahead", F.min(F.col("_before") + F.col("n") - F.col("n_last")).over(same_last))
    runs = runs.withColumns({
        "_ahead": F.lag("ahead").over(by_slice),
        "_values": F.coalesce(F.sum(F.col("values") - F.col("_goes_on").cast("int")).over(earlier), F.lit(0)),
    })
    return runs.select(
        "_slice", key, "_before", "_total", "_has_before", "_value_before", "_value_after", "_goes_on", "_ahead", "_values"
    )


def rank_within(
    df: DataFrame, key: str, value: str, ties: Sequence[str], tiles: int = 4, want: Sequence[str] = ALL,
    slice_rows: int = 500_000,
) -> DataFrame:
    """Add the wanted measures per ``key``, highest (numeric) ``value`` first, ``ties`` making the order total.

    A prefix scan over slices.  The rows are written once and cut, in their full order, into slices of about
    ``slice_rows``, so a group spans as many slices as it needs.  One shuffle brings the rows of each
    (slice, key) together, where windows give the local measures.  For the few keys that are cut, each
    slice gets one carry from the key's other slices: rows and distinct values before it,
    the values at its edges.  Only what ``want`` names is computed.
    """
    rows = stage(df, "to-rank")
    place = _place(key, value, ties)
    cuts = slice_cuts(rows, place, slice_rows)
    rows = sliced(rows, place, cuts)
    full = Window.partitionBy("_slice", key).orderBy(F.col(value).desc(), *ties)
    plain = Window.partitionBy("_slice", key).orderBy(F.col(value).desc())
    local = {
        "_row": (F.row_number().over(full), {ROW_NUMBER, NTILE, LAG} & set(want)),
        "_n": (F.count("*").over(Window.partitionBy("_slice", key)), {NTILE} & set(want)),
        "_prior": (F.lag(value).over(full), {LAG} & set(want)),
        "_next": (F.lead(value).over(full), {LEAD} & set(want)),
        "_is_last": (F.lead(F.lit(False), 1, True).over(full), {LEAD} & set(want)),
        "_rank": (F.rank().over(plain), {RANK} & set(want)),
        "_dense": (F.dense_rank().over(plain), {DENSE_RANK} & set(want)),
    }
    ranked = rows.withColumns({name: column for name, (column, used) in local.items() if used})
    if cuts is None:
        before = ahead = values = F.lit(0)
        total, goes_on = F.col("_n"), F.lit(False)
        value_before = value_after = F.lit(None)
    else:
        # At most two rows a slice, so the broadcast is bounded by skew.MOST_SLICES.
        carries = F.broadcast(_carries(rows, cuts, key, value))
        ranked = null_safe_join(ranked, carries, ["_slice", key], "left")
        before, values = F.coalesce("_before", F.lit(0)), F.coalesce("_values", F.lit(0))
        total, ahead = F.coalesce("_total", "_n"), F.col("_ahead")
        goes_on = F.coalesce("_goes_on", F.lit(False)) & F.col(value).eqNullSafe(F.col("_value_before"))
        value_before, value_after = F.col("_value_before"), F.col("_value_after")
    measures = {
        ROW_NUMBER: lambda: before + F.col("_row"),
        RANK: lambda: F.when(goes_on, ahead + 1).otherwise(before + F.col("_rank")),
        DENSE_RANK: lambda: values + F.col("_dense") - (F.coalesce("_goes_on", F.lit(False)).cast("int") if cuts is not None else F.lit(0)),
        NTILE: lambda: _tile(before + F.col("_row"), total, tiles),
        LAG: lambda: F.when(F.col("_row") > 1, F.col("_prior")).otherwise(value_before),
        LEAD: lambda: F.when(F.col("_is_last"), value_after).otherwise(F.col("_next")),
    }
    kept = [measures[m]().cast("long" if m not in (LAG, LEAD) else df.schema[value].dataType).alias(m) for m in ALL if m in want]
    return ranked.select(*df.columns, *kept)


def class_ranking(
    enrolments: DataFrame, classes: DataFrame, students: DataFrame, people: DataFrame,
    want: Sequence[str] = ALL,
) -> DataFrame:
    """Graded enrolments with their place in the class.

    The name is the tie-break, so it is joined before the ranking.
    """
    graded = enrolments.filter(F.col("NotaFinal").isNotNull()).select(
        "TurmaID", "MatriculaID", "AlunoID", "NotaFinal", "FrequenciaPercentual", "StatusMatricula"
    )
    names = students.select("AlunoID", "RA", "PessoaID").join(
        people.select("PessoaID", F.col("NomeExibicao").alias("NomeAluno")), "PessoaID"
    )
    rows = graded.join(names.drop("PessoaID"), "AlunoID").join(classes.select("TurmaID", "CodigoTurma"), "TurmaID")
    ranked = rank_within(rows, "TurmaID", "NotaFinal", ["NomeAluno", "MatriculaID"], want=want)
    return ranked.select(
        "TurmaID", "CodigoTurma", "MatriculaID", "AlunoID", "RA", "NomeAluno", "NotaFinal",
        "FrequenciaPercentual", "StatusMatricula", *[m for m in ALL if m in want],
    )
