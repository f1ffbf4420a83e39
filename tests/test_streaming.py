"""Several micro-batches, replays, late rows: the stream must end where the batch job does."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lectern.operators.aggregates import minute_counts, payments_rollup
from lectern.plans.bulk import apply_payments
from lectern.session import work_path
from lectern.sources import manifest
from lectern.sources.sinks import committed_batches, current, remove
from lectern.streaming import jobs
from tests.seed import AS_OF


def arrive(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def follow(spark, like, path):
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).parquet(path)


def table(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(cols).collect()), key=str)


@pytest.fixture
def paths(spark):
    base = work_path(spark, "stream-test")
    return f"{base}/in", f"{base}/out", f"{base}/ckpt"


def test_minute_counts_over_batches_and_replay(spark, campus, paths):
    src, out, ckpt = paths
    events, types = campus["EventStream"], campus["EventType"]
    arrive(events.filter("EventID <= 3"), src)
    arrive(events.filter("EventID > 3"), src)
    jobs.stream_minute_counts(follow(spark, events, src), types, out, ckpt).awaitTermination()
    want = table(minute_counts(events, types))
    assert table(jobs.read_minute_metric(spark, out)) == want

    # The same batch once more: its folder is overwritten, nothing is added twice.
    jobs.write_batch(minute_counts(spark.read.parquet(f"{src}").filter("EventID <= 3"), types), f"{out}-copy", 0)
    jobs.write_batch(minute_counts(spark.read.parquet(f"{src}").filter("EventID <= 3"), types), f"{out}-copy", 0)
    assert jobs.read_minute_metric(spark, f"{out}-copy").agg(F.sum("MetricValue")).first()[0] == 3

    # A very late event is accepted.
    late = events.filter("EventID = 1").withColumn("OccurredAt", F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz"))
    arrive(late, src)
    jobs.stream_minute_counts(follow(spark, events, src), types, out, ckpt).awaitTermination()
    assert table(jobs.read_minute_metric(spark, out)) == table(minute_counts(events.unionByName(late), types))
    every = table(minute_counts(events.unionByName(late), types))
    store = f"{out}-store"
    assert jobs.fold_minute_metric(spark, out, store) == 2 == jobs.fold_minute_metric(spark, out, store)
    assert table(jobs.folded_minute_metric(spark, out, store)) == every
    arrive(late, src)
    jobs.stream_minute_counts(follow(spark, events, src), types, out, ckpt).awaitTermination()
    more = table(jobs.read_minute_metric(spark, out))
    assert more != every and table(jobs.folded_minute_metric(spark, out, store)) == more
    assert jobs.fold_minute_metric(spark, out, store) == 3
    assert table(jobs.folded_minute_metric(spark, out, store)) == more

    base = jobs.read_minute_metric(spark, out)
    assert jobs.read_minute_metric(spark, out, base).agg(F.sum("MetricValue")).first()[0] == 18


def test_uncommitted_batch_is_not_folded(spark, campus, paths):
    src, out, ckpt = paths
    events, types = campus["EventStream"], campus["EventType"]
    for n in (1, 2):
        arrive(events.filter(F.col("EventID") == n), src)
    jobs.stream_minute_counts(follow(spark, events, src), types, out, ckpt).awaitTermination()
    last = max(committed_batches(spark, out))
    remove(spark, f"{out}/batch_id={last}/_SUCCESS")  # as if its job were still committing files
    store = out + "-store"
    assert jobs.fold_minute_metric(spark, out, store) == last - 1
    assert current(spark, store, "MetricMinute").agg(F.sum("MetricValue")).first()[0] == 1


def test_windowed_counts_emit_closed_windows_and_drop_late_rows(spark, campus, paths):
    src, out, ckpt = paths
    events, types = campus["EventStream"], campus["EventType"]
    arrive(events, src)
    jobs.stream_minute_windowed(follow(spark, events, src), types, "2 minutes", out, ckpt).awaitTermination()
    closed = minute_counts(events, types).filter("MetricMinute <= timestamp_ntz'2026-03-09 10:13:20'")
    assert table(spark.read.parquet(out)) == table(closed)
    arrive(events.filter("EventID = 1"), src)
    jobs.stream_minute_windowed(follow(spark, events, src), types, "2 minutes", out, ckpt).awaitTermination()
    assert table(spark.read.parquet(out)) == table(closed)


def test_payments_over_batches(spark, campus, paths):
    src, out, ckpt = paths
    old, inst = campus["Pagamento"], campus["ParcelaFinanceira"]
    cols = ["PagamentoID", "ParcelaID", "DataPagamento", "ValorPagamento"]
    new = spark.createDataFrame(
        [
            (10, 3, dt.datetime(2026, 3, 11), D("1000.00")), (11, 3, dt.datetime(2026, 3, 12), D("370.00")),
            (12, 1, dt.datetime(2026, 3, 8), D("5.00")), (13, 6, dt.datetime(2026, 3, 12), D("1.00")),
        ],
        "PagamentoID long, ParcelaID long, DataPagamento timestamp_ntz, ValorPagamento decimal(10,2)",
    )
    for n in (10, 11, 12, 13):
        arrive(new.filter(F.col("PagamentoID") == n), src)
    stream = follow(spark, new, src)
    jobs.stream_payment_rollup(stream, old.select(*cols), inst, AS_OF, out, ckpt).awaitTermination()
    touched = new.select("ParcelaID").distinct()
    every = payments_rollup(old.select(*cols).unionByName(new)).join(touched, "ParcelaID", "left_semi")
    assert table(jobs.read_instalments(spark, inst, out)) == table(apply_payments(inst, every, AS_OF))
    state = {r["ParcelaID"]: r["StatusParcela"] for r in jobs.read_instalments(spark, inst, out).collect()}
    assert state[3] == "PAGA" and state[6] == "ATRASADA"


def test_changes_are_compacted_in_levels(spark, campus, paths):
    """However many batches there were, readers open a bounded number of pieces and see the newest versions."""
    _, out, store = paths
    inst, like = campus["ParcelaFinanceira"], "ParcelaID int, ValorPago decimal(10,2), DataPagamento date, StatusParcela string"
    assert table(jobs.read_instalments(spark, inst, out, store)) == table(inst)
    for n in range(22):
        rows = [(1 + n % 3, D(n), dt.date(2026, 3, 1), "PAGA"), (5, D(100 + n), None, "ABERTA")]
        jobs.write_batch(spark.createDataFrame(rows, like).coalesce(1), f"{out}/instalments", n)
        if n % 2:
            assert jobs.compact_changes(spark, f"{out}/instalments", store, "ParcelaID", fan=3) == n
    assert jobs.compact_changes(spark, f"{out}/instalments", store, "ParcelaID", fan=3) == 21
    plain = jobs.read_instalments(spark, inst, out)
    merged = jobs.read_instalments(spark, inst, out, store)
    assert table(merged) == table(plain)
    assert {r["ParcelaID"]: r["ValorPago"] for r in merged.collect()}[5] == D(121)
    pieces = manifest.load(spark, store).tables["changes"].parts
    assert set(pieces) == {"0:18:19", "0:20:21", "2:0:17"}  # 11 runs, in base 3
    assert len(jobs.read_changes(spark, f"{out}/instalments", store).inputFiles()) <= 2 * len(pieces) < 22
    jobs.write_batch(spark.createDataFrame([(5, D(7), None, "PAGA")], like), f"{out}/instalments", 22)
    assert {r["ParcelaID"]: r["ValorPago"] for r in jobs.read_instalments(spark, inst, out, store).collect()}[5] == D(7)


def test_grades_over_batches(spark, campus, paths):
    src, out, ckpt = paths
    grades, enrol, limits = campus["Nota"], campus["Matricula"], campus["Avaliacao"]
    cols = ["MatriculaID", "AvaliacaoID", "NotaObtida", "LancadaEm"]
    day = dt.datetime(2026, 7, 1)
    changes = [
        [(3, 2, D("9.90"), day)],                                # corrected grade: fails → passes on grade, not attendance
        [(4, 3, D("6.00"), day), (2, 1, D("10.50"), day)],       # new grade; one above the maximum
        [(2, 2, D("3.00"), day), (4, 3, D("7.00"), day)],
    ]
    for rows in changes:
        arrive(spark.createDataFrame(rows, grades.select(*cols).schema), src)
    stream = follow(spark, grades.select(*cols), src)
    jobs.stream_grade_derive(stream, grades.select(*cols), limits, enrol, out, ckpt).awaitTermination()
    got = {r["MatriculaID"]: (r["NotaFinal"], r["StatusMatricula"]) for r in jobs.read_enrolments(spark, enrol, out).collect()}
    assert got[3] == (D("7.94"), "REPROVADA")       # (5.00·40 + 9.90·60) / 100
    assert got[2] == (D("4.72"), "REPROVADA")       # (7.30·40 + 3.00·60) / 100; 10.50 was refused
    assert got[4] == (D("7.00"), "APROVADA")
    assert got[1] == (D("8.70"), "APROVADA")        # untouched
    stamped = enrol.withColumn("UltimaAtualizacao", F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz"))
    stamps = {r["MatriculaID"]: r["UltimaAtualizacao"] for r in jobs.read_enrolments(spark, stamped, out).collect()}
    assert stamps[3] == day and stamps[1] == dt.datetime(2026, 1, 1)


def test_grade_batches_read_their_own_rows(spark, campus, paths):
    """Twenty batches on a history: every one reads its own rows, the state stays as it is, and a replay changes nothing."""
    src, out, ckpt = paths
    grades, enrol, limits = campus["Nota"], campus["Matricula"], campus["Avaliacao"]
    cols = ["MatriculaID", "AvaliacaoID", "NotaObtida", "LancadaEm"]
    like = grades.select(*cols)
    day, rows = dt.datetime(2026, 7, 1), []
    for n in range(20):
        rows.append([(3, 1 + n % 2, D(n % 9) + D("0.25"), day + dt.timedelta(n)), (99, 1, D("5.00"), day)])
        arrive(spark.createDataFrame(rows[-1], like.schema), src)
    chain = jobs.stream_grade_derive(follow(spark, like, src), like, limits, enrol, out, ckpt, max_files=1)
    chain.awaitTermination()
    derived = chain.queries[1].recentProgress
    moved = [p for p in derived if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in moved) == 40 and max(p["numInputRows"] for p in moved) <= 2
    sizes = {p["stateOperators"][0]["numRowsTotal"] for p in moved[1:]}
    assert len(sizes) == 1  # neither more grades nor more enrolments, whatever the number of batches
    newest = like.filter("MatriculaID = 3 AND AvaliacaoID NOT IN (1, 2)").unionByName(
        spark.createDataFrame([rows[18][0], rows[19][0]], like.schema))
    want = jobs.final_grades(newest, limits).first()["_final"]
    got = {r["MatriculaID"]: r for r in jobs.read_enrolments(spark, enrol, out).collect()}
    assert got[3]["NotaFinal"] == want and 99 not in got
    before = table(spark.read.parquet(f"{out}/enrolments"))
    jobs.stream_grade_derive(follow(spark, like, src), like, limits, enrol, out, ckpt).awaitTermination()
    assert table(spark.read.parquet(f"{out}/enrolments")) == before


def test_grade_state_is_kept_by_groups(spark, campus, paths):
    """Enrolments share state values, whose number stays as it was at the first start; identities may be of another kind."""
    src, out, ckpt = paths
    limits, many = campus["Avaliacao"], 3 * jobs.GROUP_ROWS
    enrol = spark.range(1, many + 1).selectExpr(
        "CAST(id AS int) AS MatriculaID", "CAST(80 AS decimal(5,2)) AS FrequenciaPercentual",
        "CAST(NULL AS decimal(5,2)) AS NotaFinal", "IF(id = 7, 'TRANCADA', 'ATIVA') AS StatusMatricula")
    like = campus["Nota"].select("MatriculaID", "AvaliacaoID", "NotaObtida", "LancadaEm")
    day = dt.datetime(2026, 7, 1)
    grade = lambda n, value: spark.createDataFrame([(n, 1, D(value), day), (many + 1, 1, D("9.00"), day)], like.schema)
    arrive(spark.createDataFrame([(n, 1, D("5.00"), day) for n in range(1, many, 2)], like.schema), src)
    chain = jobs.stream_grade_derive(follow(spark, like, src), None, limits, enrol, out, ckpt)
    chain.awaitTermination()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in chain.queries[1].recentProgress if p["numInputRows"]]
    assert 1 <= state[-1] <= 3
    arrive(grade(9, "8.00"), src)
    more = enrol.unionByName(enrol.withColumn("MatriculaID", (F.col("MatriculaID") + 1000).cast("int")))
    jobs.stream_grade_derive(follow(spark, like, src), None, limits, more, out, ckpt).awaitTermination()
    got = {r["MatriculaID"]: (r["NotaFinal"], r["StatusMatricula"]) for r in jobs.read_enrolments(spark, more, out).collect()}
    assert len(got) == 2 * many and got[2] == (None, "ATIVA") and got[7] == (None, "TRANCADA")
    assert got[9] == (D("8.00"), "APROVADA")  # graded again, in a later batch
    assert sum(v[0] is not None for v in got.values()) == many // 2 - 1


def test_grade_state_moves_texts(spark):
    """A group's state is one text, a grade comes as one, and the outcomes of a group leave as one row."""
    from pyspark.sql import Row

    from lectern.streaming import grade_state as g

    day = dt.datetime(2026, 7, 1)
    base = spark.createDataFrame(
        [('7-"x"', True, D("80.00"), None, "ATIVA", None, [(1, -1, day, D("5.00"), D("40.00"))]),
         ("8", True, None, D("9.00"), None, day, None), ("9", True, D("60.00"), D("9.00"), "CANCELADA", None, None)],
        "MatriculaID string, known boolean, FrequenciaPercentual decimal(5,2), NotaFinal decimal(5,2), StatusMatricula string,"
        " posted timestamp_ntz, grades array<struct<AvaliacaoID int, batch_id long, LancadaEm timestamp_ntz, NotaObtida decimal(5,2),"
        " Peso decimal(5,2)>>")
    held = base.agg(F.to_json(F.collect_list(g.member(F.col("grades")))).alias("m")).first()["m"]
    rows = spark.createDataFrame(
        [(0, '7-"x"', 2, 0, day + dt.timedelta(1), D("9.90"), D("60.00")), (0, '7-"x"', 2, 0, day, D("1.00"), D("60.00")),
         (0, '7-"x"', 1, 0, None, None, D("40.00")), (0, "8", 1, 0, day, D("7.00"), None), (0, None, 1, 0, day, D("7.00"), D(1)),
         (0, "9", 1, 0, day, D("2.00"), D("0.50")), (0, "77", 1, 0, day, D("2.00"), D(1))],
        "_group int, MatriculaID string, AvaliacaoID int, batch_id long, LancadaEm timestamp_ntz, NotaObtida decimal(5,2), Peso decimal(5,2)")
    arriving = g.arriving(rows)
    assert arriving.columns == ["_group", "grade"]

    class Value:
        now = (held,)

        def get(self):
            return self.now

        def update(self, value):
            self.now = value

    state = g.GradeState()
    state.members = Value()
    out = list(state.handleInputRows((0,), iter(arriving.collect()), None))
    assert len(out) == 1 and isinstance(state.members.now[0], str)
    got = g.decoded(spark.createDataFrame([Row(outcomes=out[0].outcomes)], g.OUTCOMES), base.schema["MatriculaID"].dataType)
    assert {tuple(r) for r in got.collect()} == {  # an unknown grade still weighs: 9.90 of 60 of 100
        ('7-"x"', D("5.94"), "REPROVADA", day + dt.timedelta(1)), ("8", D("9.00"), None, day), ("9", D("9.00"), "CANCELADA", None)}
    again = state.members.now
    assert [r.outcomes for r in state.handleInputRows((0,), iter(arriving.collect()), None)] == [out[0].outcomes]
    assert state.members.now == again  # a replay changes nothing


def test_grade_query_derives_its_inputs_once(spark, monkeypatch):
    from lectern.registry import QUERIES

    seen, plain = [], jobs.stream_grade_derive
    monkeypatch.setattr(jobs, "stream_grade_derive", lambda *given: seen.extend(given[2:4]) or plain(*given))
    QUERIES["stream_grade_derive"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 2 and not [f for df in seen for f in df.inputFiles() if f.endswith(("lineitem.parquet", "part.parquet"))]


def test_grade_state_rules():
    from lectern.streaming.grade_state import derived_status, weighted_mean

    assert weighted_mean([(D("7.30"), D(40)), (D("3.00"), D(60))]) == D("4.72")
    assert weighted_mean([(D("0.01"), D(1)), (D("0.00"), D(1))]) == D("0.01")  # half up
    assert weighted_mean([(None, D(40)), (D("5.00"), D(60))]) == D("3.00")
    assert weighted_mean([]) is None and weighted_mean([(D(5), D(0))]) is None and weighted_mean([(None, D(1))]) is None
    assert derived_status(D(6), D(75), "ATIVA") == "APROVADA" and derived_status(D("5.99"), None, "ATIVA") == "REPROVADA"
    assert derived_status(D(9), None, "ATIVA") == "ATIVA" and derived_status(None, D(74), "ATIVA") == "REPROVADA"


def test_grade_batch_rejected_as_a_whole(spark, campus, paths):
    src, out, ckpt = paths
    cols = ["MatriculaID", "AvaliacaoID", "NotaObtida", "LancadaEm"]
    day = dt.datetime(2026, 7, 1)
    like = campus["Nota"].select(*cols)
    arrive(spark.createDataFrame([(4, 3, D("6.00"), day), (2, 1, D("10.50"), day)], like.schema), src)
    jobs.stream_grade_derive(
        follow(spark, like, src), like, campus["Avaliacao"], campus["Matricula"], out, ckpt, reject="batch"
    ).awaitTermination()
    same = jobs.read_enrolments(spark, campus["Matricula"], out)
    cols = ["MatriculaID", "NotaFinal", "StatusMatricula"]
    assert table(same.select(*cols)) == table(campus["Matricula"].select(*cols))


def test_event_routes(spark, campus, paths):
    src, out, ckpt = paths
    req = spark.createDataFrame(
        [(1, "API_CALL", "{}"), (2, "NOPE", "{}"), (3, "API_CALL", "nope"), (4, "API_CALL", None)],
        "EventID long, EventCode string, PayloadJson string",
    )
    arrive(req.filter("EventID <= 2"), src)
    arrive(req.filter("EventID > 2"), src)
    now = dt.datetime(2026, 3, 20)
    jobs.stream_event_ingest(follow(spark, req, src), campus["EventType"], now, out, ckpt).awaitTermination()
    good = {r["EventID"]: r for r in jobs.read_events(spark, out, "good").collect()}
    bad = {r["EventID"]: r["Codigo"] for r in jobs.read_events(spark, out, "bad").collect()}
    assert set(good) == {1, 4} and good[1]["OccurredAt"] == now and bad == {2: 51041, 3: 51042}
