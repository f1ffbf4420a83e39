"""Functions, sinks and rules on small literal inputs."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lectern.functions import scalar as s
from lectern.functions import status as st
from lectern.operators import audit as au
from lectern.operators import integrity as i
from lectern.operators import joins as j
from lectern.operators.sets import date_series
from lectern.plans import warehouse as w
from lectern.session import work_path
from lectern.sources import manifest, sinks


def one(spark, col):
    return spark.range(1).select(col).first()[0]


def test_json_checks(spark):
    valid = ['{"a":1}', "[1]", '{"a":1,"a":2}', " [ ] ", '{"a":{"b":[null,"]"]}}']
    wrong = ['{"a":1} x', "[1] ]", "{'a':1}", '{"a":NaN}', "[1,]", "5", "", "null", '{"a":1}{"b":2}', '{"a":1},{"b":2}',
             "1],[2", '"', "[" * 100_000]
    texts = [*valid, *wrong, None]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    got = {texts[r["n"]]: r["ok"] for r in df.select("n", s.is_json("t").alias("ok")).collect()}
    assert got == {**dict.fromkeys(valid, True), **dict.fromkeys(wrong, False), None: None}


def test_calendar(spark):
    week = lambda d: one(spark, s.week_us(F.lit(d)))
    assert week(dt.date(2026, 1, 1)) == 1 and week(dt.date(2026, 1, 4)) == 2
    assert week(dt.date(2000, 12, 31)) == 54
    days = w.describe_days(date_series(spark, dt.date(2025, 1, 1), dt.date(2027, 12, 31)))
    assert days.count() == 1095
    r = days.filter("TempoKey = 20260307").first()
    assert (r["NomeDia"], r["NomeMes"], r["IsFimSemana"], r["DiaSemana"]) == ("Saturday", "March", True, 7)
    assert date_series(spark, dt.date(2026, 1, 5), dt.date(2026, 1, 1)).collect()[0][0] == dt.date(2026, 1, 5)
    assert one(spark, s.minute_floor(F.lit(dt.datetime(2026, 1, 1, 5, 6, 7)).cast("timestamp_ntz"))) == dt.datetime(2026, 1, 1, 5, 6)


def test_status_with_nulls(spark):
    null = F.lit(None).cast("decimal(5,2)")
    assert one(spark, st.grade_status(null, F.lit(90))) == "REPROVADA"
    assert one(spark, st.grade_status_derived(null, F.lit(90), F.lit("ATIVA"))) == "ATIVA"
    assert one(spark, st.grade_status_derived(null, F.lit(10), F.lit("ATIVA"))) == "REPROVADA"
    assert one(spark, s.concat0(F.lit("a"), null, F.lit("b"))) == "ab"
    assert one(spark, st.is_pending(F.lit("CANCELADA"))) is False


def test_latest_and_mode_without_rows(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, None, "c")], "k int, ts int, v string")
    got = {r["k"]: r["v"] for r in j.latest_per_key(left, right, "k", ["ts"], ["v"]).collect()}
    assert got == {1: "b", 2: None}
    got = {r["k"]: r["v"] for r in j.mode_per_key(left, right, "k", ["v"], ["v"]).collect()}
    assert got == {1: "a", 2: None}


def test_merge_add(spark):
    target = spark.createDataFrame([("a", None, D(1)), ("b", "x", D(2))], "m string, d string, v decimal(18,4)")
    delta = spark.createDataFrame([("a", "", D(5)), ("c", None, D(3))], "m string, d string, v decimal(18,4)")
    got = {(r["m"], r["d"]): r["v"] for r in sinks.merge_add(target, delta, ["m", "d"], "v", ["d"]).collect()}
    assert got == {("a", None): D(6), ("b", "x"): D(2), ("c", None): D(3)}


def test_replace_window_empties_days_and_keeps_the_rest(spark):
    path = work_path(spark, "test-window")
    rows = spark.createDataFrame(
        [(n, dt.datetime(2026, 1, d, h)) for n, (d, h) in enumerate([(1, 5), (2, 5), (2, 20), (3, 5), (4, 5)])],
        "n int, ts timestamp_ntz",
    ).withColumn("day", F.to_date("ts"))
    sinks.append(rows, path, ["day"])
    fresh = spark.createDataFrame([(9, dt.datetime(2026, 1, 2, 6))], "n int, ts timestamp_ntz").withColumn("day", F.to_date("ts"))
    sinks.replace_window(fresh, path, "day", "ts", dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 3, 23))
    assert sorted(r["n"] for r in sinks.stored(spark, path).collect()) == [0, 4, 9]
    sinks.replace_window(fresh, path, "day", "ts", dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 2, 12), F.col("n") == 1)
    assert sorted(r["n"] for r in sinks.stored(spark, path).collect()) == [0, 4, 9, 9]


def day_table(spark, name, days=3):
    path = work_path(spark, name)
    rows = spark.range(days * 4).select(
        "id", (F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") * 6)).alias("ts")
    ).withColumn("day", F.to_date("ts"))
    sinks.replace_window(rows, path, "day", "ts", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1 + days))
    return path, rows


def test_second_writer_is_refused(spark, monkeypatch):
    """Two writers begin from one version: the first wins, the second changes nothing and can try again."""
    path, rows = day_table(spark, "test-two-writers")
    window = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1, 23)
    mine = rows.filter("id < 2").withColumn("id", F.col("id") + 100)
    theirs = rows.filter("id < 1").withColumn("id", F.col("id") + 200)
    plain, other = sinks.write_parts, []

    def meanwhile(df, *args):
        plain(df, *args)
        if not other:
            other.append(True)
            sinks.replace_window(theirs, path, "day", "ts", *window)

    monkeypatch.setattr(sinks, "write_parts", meanwhile)
    with pytest.raises(manifest.Conflict):
        sinks.replace_window(mine, path, "day", "ts", *window)
    assert manifest.newest(spark, path) == 2
    assert sorted(r["id"] for r in sinks.stored(spark, path).collect()) == [*range(4, 12), 200]
    sinks.replace_window(mine, path, "day", "ts", *window)
    assert sorted(r["id"] for r in sinks.stored(spark, path).collect()) == [*range(4, 12), 100, 101]


def test_failure_before_publication_leaves_the_table_whole(spark):
    path, rows = day_table(spark, "test-failed-writer")
    bad = rows.filter("id < 6").withColumn("id", F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("long"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_window(bad, path, "day", "ts", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2, 23))
    assert manifest.newest(spark, path) == 1
    assert sorted(r["id"] for r in sinks.stored(spark, path).collect()) == list(range(12))


def test_readers_do_not_write(spark):
    path = work_path(spark, "test-readers")
    with pytest.raises(ValueError):
        sinks.stored(spark, path)
    assert manifest.load(spark, path).version == 0 and manifest.folders(spark, path) == []
    path, _ = day_table(spark, "test-readers")
    before = sorted(manifest.folders(spark, path))
    assert sinks.stored(spark, path).count() == 12 and sorted(manifest.folders(spark, path)) == before


def test_many_refreshes_are_one_scan(spark):
    """However often partitions were replaced, a table is read by one scan of the folders that hold it now."""
    out = work_path(spark, "test-refreshes")
    rows = spark.range(12).select("id", (F.col("id") % 4).cast("int").alias("m"))
    sinks.full_reload({"t": rows, "whole": rows.limit(1)}, out, "0", {"t": "m"})
    for n in range(1, 6):
        part = rows.filter(F.col("m") == n % 4).withColumn("id", F.col("id") + 100 * n)
        counts = {"t": sinks.counted_write(part, f"{out}/t/run={n}", ["m"])}
        sinks.publish(spark, out, str(n), counts, {"t": rows.schema}, {"t": [n % 4]})
    now = sinks.current(spark, out, "t")
    want = {0: 400, 1: 500, 2: 200, 3: 300}
    assert sorted(r["id"] for r in now.collect()) == sorted(i + want[i % 4] for i in range(12))
    assert now._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    sinks.publish(spark, out, "6", {"t": sinks.counted_write(rows.limit(0), f"{out}/t/run=6", ["m"])}, {}, {"t": [2]})
    assert sinks.current(spark, out, "t").filter("m = 2").count() == 0 and sinks.current(spark, out, "t").count() == 9
    assert sinks.current(spark, out, "whole").count() == 1


def test_full_reload_shows_only_published_runs(spark):
    out = work_path(spark, "test-reload")
    df = spark.range(3).toDF("n")
    sinks.full_reload({"t": df}, out, "1")
    sinks.counted_write(df.limit(1), f"{out}/t/run=2")      # a run that never finished
    assert sinks.current(spark, out, "t").count() == 3
    sinks.full_reload({"t": df.limit(2)}, out, "3")
    assert sinks.current(spark, out, "t").count() == 2


def test_rules_pass_on_null_and_split_rows(spark):
    df = spark.createDataFrame(
        [(1, "A", 5, 1), (2, None, None, None), (3, "Z", 11, 9), (4, "A", 5, 1)], "id int, c string, n int, p int"
    )
    parents = spark.createDataFrame([(1,)], "pid int")
    rules = [
        i.Domain("d", "c", ("A", "B")), i.Range("r", "n", 0, 10), i.NotNull("nn", ("c",)),
        i.Unique("u", ("c", "n")), i.ForeignKey("f", "p", "parents", "pid"),
    ]
    good, bad = i.validate(df, rules, "id", {"parents": parents})
    assert sorted((r["rule"], r["key"]) for r in bad.collect()) == [
        ("d", "3"), ("f", "3"), ("nn", "2"), ("r", "3"), ("u", "1"), ("u", "4"),
    ]
    assert good.count() == 0
    twins = spark.createDataFrame([(1, None), (2, None)], "id int, c string")
    assert i.validate(twins, [i.Unique("u", ("c",))], "id")[1].count() == 2


def test_relations_of_many_tables_share_one_pass(spark, monkeypatch):
    """Each table is read once, whatever the number of its rules; hot keys, NULLs and swapped columns included."""
    path = work_path(spark, "test-relations")
    parent = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (None, None)], "pid int, code string")
    child = spark.range(300).select(
        F.col("id").alias("cid"), F.when(F.col("id") % 3 > 0, F.col("id") % 4).alias("pid"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") == 7, F.lit("q")).alias("b"), F.when(F.col("id") == 8, F.lit("q")).alias("c"),
    )
    tables = {}
    for name, df in {"parent": parent, "child": child}.items():
        df.write.parquet(f"{path}/{name}")
        tables[name] = spark.read.parquet(f"{path}/{name}")
    rules = {
        "parent": [i.Unique("p.code", ("code",)), i.Unique("p.pid", ("pid",))],
        "child": [
            i.Unique("c.a", ("a",)), i.Unique("c.bc", ("b", "c")), i.Unique("c.cid", ("cid",)),
            i.ForeignKey("c.pid", "pid", "parent", "pid"), i.ForeignKey("c.self", "pid", "child", "cid"),
        ],
    }
    plans = []
    plain = i.stage
    monkeypatch.setattr(i, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, name))
    found = i.relation_violations(tables, rules, {"parent": "pid", "child": "cid"}).collect()
    assert [plan.count("FileScan") for plan in plans] == [2]
    got = {}
    for r in found:
        got.setdefault((r["rule"], r["reason"]), []).append(r["key"])
    rows = child.collect()
    assert sorted(got["p.code", "Unique"], key=str) == ["1", "2", "3", None]
    assert ("p.pid", "Unique") not in got and ("c.cid", "Unique") not in got and ("c.self", "ForeignKey") not in got
    assert sorted(got["c.a", "Unique"]) == sorted(str(k) for k in range(0, 300, 3))
    assert len(got["c.bc", "Unique"]) == 298
    assert sorted(got["c.pid", "ForeignKey"]) == sorted(str(r["cid"]) for r in rows if r["pid"] == 0)


def test_cross_table_reject_modes(spark):
    df = spark.createDataFrame([(1, 1, 9), (2, 1, 11)], "id int, k int, v int")
    limits = spark.createDataFrame([(1, 10)], "k int, top int")
    for mode, want in [("row", {2}), ("batch", {1, 2})]:
        rule = i.CrossTable("x", "limits", "k", "v", "top", mode)
        assert {r["id"] for r in rule.violations(df, {"limits": limits}).collect()} == want
    rule = i.CrossTable("x", "limits", "k", "v", "top", "batch")
    assert rule.violations(df.filter("id = 1"), {"limits": limits}).count() == 0


def test_audit_images(spark):
    cols = "id int, s string, n decimal(5,2)"
    before = spark.createDataFrame([(1, "A", None), (2, "A", D(1)), (3, None, D(2))], cols)
    after = spark.createDataFrame([(1, "A", D("3.50")), (2, "A", D(1)), (3, None, D(2)), (4, "N", D(0))], cols)
    rows = au.audit_update_diff(before, after, "id", {"S": "s", "N": "n"}, "core", "T").collect()
    assert [(r["ChaveRegistro"], r["DadosAntes"], r["DadosDepois"]) for r in rows] == [("1", "S=A; N=NULL", "S=A; N=3.50")]
    ops = {r["ChaveRegistro"]: (r["Operacao"], r["DadosAntes"]) for r in
           au.audit_upsert(before, after, "id", {"S": "s"}, "core", "T").collect()}
    assert ops["4"] == ("INSERT", None) and ops["3"] == ("UPDATE", "S=")


def test_foreign_keys_of_any_length_take_their_own_text(spark, monkeypatch):
    """Values are written as they are, unless they are long; none is taken for another one, and NULL has no parent to find."""
    long = "ã" * 20
    parent = spark.createDataFrame([("a",), (long + "x",), ("0" * 32,), (None,), ("b",), ("b",)], "k string")
    child = spark.createDataFrame(
        [(1, "a"), (2, long + "x"), (3, long + "y"), (4, None), (5, "0" * 32), (6, "0" * 31), (7, ""), (8, "b"), (9, "a ")],
        "id int, p string",
    )
    rules = {"child": [i.ForeignKey("c.p", "p", "parent", "k")]}
    out = i.relation_violations({"child": child, "parent": parent}, rules, {"child": "id"}).collect()
    assert sorted(tuple(r) for r in out) == [("c.p", k, "ForeignKey") for k in "3679"]
    # A hash as text is as long as the texts that are hashed, so it is no key of its own.
    named = parent.limit(0).unionByName(parent.select(i._short(F.lit(long)).alias("k")).limit(1))
    out = i.relation_violations({"child": child.filter("id = 3").withColumn("p", F.lit(long)), "parent": named}, rules, {"child": "id"})
    assert [r["key"] for r in out.collect()] == ["3"]
    written, plain = [], i.stage
    monkeypatch.setattr(i, "stage", lambda df, name: written.append(plain(df, name)) or written[-1])
    many = {"child": spark.range(40_000).selectExpr("id", "id AS p"), "parent": spark.range(1, 40_000).selectExpr("id AS k")}
    assert [r["key"] for r in i.relation_violations(many, rules, {"child": "id"}).collect()] == ["0"]
    size = sum(os.path.getsize(f.removeprefix("file://")) for f in written[0].inputFiles())
    assert size < 10 * 79_999  # a hash alone takes 16 bytes
