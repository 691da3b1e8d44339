"""Report operators on small tables."""

import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import dedup, entity, planning, reports, status, verify


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*(by or df.columns)).collect()]


def test_newest_batch_keeps_duplicates_within_it(spark):
    df = spark.createDataFrame([("a", "20260801", 1), ("a", "20260801", 1), ("a", "20260731", 1), ("b", "20260730", 2)], "k string, batch string, v int")
    assert rows(dedup.newest_batch(df, ["k"], "batch")) == [("a", "20260801", 1), ("a", "20260801", 1), ("b", "20260730", 2)]
    tags = spark.createDataFrame([("20260801",), ("2026-08-01-month",), ("x",), ("20260802",), ("2026-12-01",), ("2026-8-1",)], "t string")
    assert [r[0] for r in tags.orderBy(dedup.batch_order(F.col("t"))).collect()][2:] == ["20260801", "2026-08-01-month", "20260802", "2026-12-01"]
    none = spark.createDataFrame([("a", None, 1), ("b", None, 2), ("b", "x", 3)], "k string, batch string, v int")
    assert rows(dedup.newest_batch(none, ["k"], "batch").select("v")) == [(1,), (3,)]


def test_coalescing_merge_and_folds(spark):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "y"), ("k", 3, " ", "")], "k string, seq int, a string, b string")
    assert rows(dedup.coalesce_merge(df, ["k"], ["a", "b"], F.col("seq"))) == [("k", "a", "y")]
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "v string, seq int")
    assert rows(dedup.exact_fold(df, ["v"], ["seq"])) == [("x", 1), ("y", 3)]
    assert rows(dedup.keep_last(df, ["v"], "seq").select("v", "seq", "_first")) == [("x", 2, 1), ("y", 3, 3)]
    assert rows(dedup.running_number(df.withColumn("k", F.lit(1)), ["k"], ["seq"]).select("seq")) == [(1,), (2,), (3,)]
    kinds = spark.createDataFrame([("",), ("2026-08-01",), ("2026-08-31-month",), ("20260801",), (None,)], "c string")
    assert rows(dedup.kind_counts(kinds, "c")) == [("aligned", 1), ("batch_marker", 1), ("misplaced", 1), ("unknown", 2)]
    a, b = spark.createDataFrame([("1", "2")], "a string, b string"), spark.createDataFrame([("3", "4")], "b string, c string")
    assert rows(dedup.union_columns(a, b)) == [("", "3", "4"), ("1", "2", "")] and dedup.align(a, ["b", "z"]).first() == ("2", "")
    assert rows(dedup.replace_batch(a.withColumn("tag", F.lit("x")), b, "tag", "x").select("b", "tag")) == [("3", "x")]


def test_matching_never_falls_from_id_to_name(spark):
    master = spark.createDataFrame([("S1", ["1"], "店A", ["老A"], 1), ("S2", ["2"], "店B", ["店A"], 2)], "id string, ids array<string>, name string, aliases array<string>, seq int")
    ids = entity.id_map(master, "id", "ids", "seq")
    flat = master.select("id", F.explode(F.array_append("aliases", F.col("name"))).alias("n"))
    names = entity.name_index(flat, "id", [F.col("n")])
    assert rows(names) == [("店B", "S2"), ("老A", "S1")]
    assert rows(entity.name_conflicts(flat, "id", [F.col("n")])) == [("店A", 2, ["S1", "S2"])]
    given = spark.createDataFrame([(1, "1", "店B"), (2, "9", "店B"), (3, None, "店B"), (4, None, "店A")], "i int, ext string, nm string")
    assert rows(entity.cascade_match(given, ids, names, F.col("ext"), F.col("nm")).select("i", "sid")) == [(1, "S1"), (2, None), (3, "S2"), (4, None)]


def test_versions(spark):
    before = spark.createDataFrame([("1", "甲（一）", ["x"], "active", "d0", "d0"), ("2", "乙", [], "active", "d0", "d0")], "id string, name string, aliases array<string>, status string, first_seen string, last_seen string")
    after = spark.createDataFrame([("1", "甲(二)"), ("3", "丙")], "id string, name string")
    assert rows(entity.apply_versions(before, after, F.lit("d1"))) == [("1", "甲(二)", ["x", "甲（一）"], "active", "d0", "d1"), ("2", "乙", [], "inactive", "d0", "d0"), ("3", "丙", [], "active", "d1", "d1")]
    same = spark.createDataFrame([("1", "甲(一)")], "id string, name string")
    assert rows(entity.four_state_diff(before.select("id", "name"), same, "id", "name")) == [("1", "unchanged"), ("2", "inactive")]
    lists = spark.createDataFrame([("a, b,c", "100,200,100")], "ids string, ch string")
    assert [x["c0"] for x in lists.select(entity.aligned_lists([F.col("ids")], F.col("ch"), "100")).first()[0]] == ["a", "c"]


def test_gaps_plans_and_gates(spark):
    days = spark.createDataFrame([("a", "2026-01-01"), ("a", "2026-01-04"), ("b", "2026-01-02")], "g string, d string")
    assert [(g, str(d)) for g, d in rows(planning.gap_days(days, "g", F.col("d").cast("date")))] == [("a", "2026-01-02"), ("a", "2026-01-03")]
    got = planning.recent_gaps(days.select(F.col("d").cast("date").alias("d")), "d", F.lit("2026-01-05").cast("date"), 4, 1).first()
    assert got[0] == 1 and str(got[1][0]) == "2026-01-03"
    tasks = spark.createDataFrame([("t1", 1), ("t2", 2), ("t3", 3)], "task_key string, v int")
    ledger = spark.createDataFrame([("t1", "validated"), ("t2", "failed")], "task_key string, status string")
    assert rows(planning.plan_gaps(tasks, ledger, spark.createDataFrame([("t1", 9), ("t3", 9)], "task_key string, v int"))) == [("t1", 9), ("t2", 2), ("t3", 3)]
    assert rows(planning.gap_status(tasks, ledger)) == [("failed", 1), ("not_collected", 1), ("validated", 1)]
    faults = planning.one_to_one(tasks, spark.createDataFrame([("t1", 1), ("t1", 1), ("t2", 7), ("t9", 0)], "task_key string, v int"), ["v"])
    assert rows(faults) == [("t1", "repeated"), ("t2", "identity"), ("t3", "no result"), ("t9", "no task")]
    old = spark.createDataFrame([("x", "d")], "t string, d string")
    assert rows(planning.insert_if_absent(spark.createDataFrame([("x", "d"), ("y", "d"), ("y", "d")], "t string, d string"), old, ["t", "d"])) == [("y", "d"), ("y", "d")]


def test_streaks(spark):
    df = spark.createDataFrame([("u", i, k) for i, k in enumerate("ssxfssns")] + [("v", 0, "f")], "u string, i int, k string")
    ok, bad = F.col("k") == "s", F.col("k") == "f"
    assert rows(status.best_streak(df, "u", "i", ok, bad)) == [("u", 3), ("v", 0)]
    assert rows(status.current_streak(df, "u", "i", ok, bad)) == [("u", 3, True), ("v", 0, False)]
    health = spark.createDataFrame([("a", 500, "2026-01-02 00:00:00"), ("b", 5, "2026-01-02 00:00:00"), ("c", 500, "2025-12-01 00:00:00"), ("d", None, None)], "path string, length bigint, m string")
    got = status.file_health(health.withColumn("modificationTime", F.to_timestamp("m")), F.to_timestamp(F.lit("2026-01-03 00:00:00")))
    assert [r["state"] for r in got.orderBy("path").collect()] == ["ok", "too_small", "stale", "missing"]


def test_reports(spark):
    e = spark.createDataFrame([("2026-01-01", 10.0), ("2026-01-02", 0.0), ("2026-01-03", 5.0), ("2026-01-05", 1.0)], "d string, v double")
    got = rows(reports.day_over_day(e, F.col("d").cast("date"), F.col("v")))
    assert [r[3] for r in got] == [None, -1.0, None, None]
    assert reports.scores(spark.createDataFrame([(0,), (1,), (None,), (4,)], "s int"), "s").first()[1:] == (3, 1)
    assert rows(reports.top_categories(spark.createDataFrame([("b", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5)], "c string, i int"), "c", "i", 2), "n", "c") == [("a", 2), ("b", 2)]
    assert reports.top_categories(spark.createDataFrame([("b", 1), ("a", 2)], "c string, i int"), "c", "i", 1).first()[0] == "b"
    assert reports.totals(spark.createDataFrame([(1, "x"), (None, None)], "v int, s string"), ["v"], "s").first() == (1, 2)
    hist = rows(reports.hour_histogram(spark.createDataFrame([(3,), (3,)], "h int"), F.col("h")))
    assert len(hist) == 24 and hist[3] == (3, 2, 100.0, 0.0) and sum(h[1] for h in hist) == 2
    assert [r[1] for r in rows(reports.with_total(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), "k", "total", ["n"]))] == [1, 2, 3]
    flags = spark.range(1).select(reports.flags([("x", F.lit(True)), ("y", F.lit(False)), ("z", F.lit(True))], 1)).first()[0]
    assert flags == ["x"]


def test_reconcile_finds_what_was_changed(spark):
    source = spark.createDataFrame([("d", "1", 1.0, "x"), ("d", "1", 1.0, "x"), ("d", "2", 2.0, "y"), ("d", "3", 3.0, None)], "g string, k string, v double, s string")
    count = lambda stored: {r["code"]: r["n"] for r in verify.reconcile(source, stored, ["g"], ["k"], ["v"], ["s"]).collect()}
    assert count(source.repartition(3)) == {"MATCHED": 4}
    assert count(source.where("k <> '2'")) == {"MATCHED": 3, "MISSING": 1}
    assert count(source.union(source.where("k = '2'"))) == {"MATCHED": 4, "FABRICATED": 1}
    assert count(source.withColumn("s", F.when(F.col("k") == "2", F.lit("")).otherwise(F.col("s")))) == {"MATCHED": 3, "LEGACY_BLANKED": 1}
    assert count(source.withColumn("v", F.col("v") + F.when(F.col("k") == "3", 1).otherwise(1e-12))) == {"MATCHED": 3, "MISSING": 1, "FABRICATED": 1}
    one = spark.createDataFrame([("d", "1", 1234567.1234565, 0.0, "x", None), ("d", "2", 5.0, 1.0, "y", "z")], "g string, k string, v double, w double, s string, t string")
    near = one.withColumn("v", F.col("v") * (1 + 4e-10)).withColumn("w", F.col("w") + 1e-12)
    codes = lambda stored: {r["code"]: r["n"] for r in verify.reconcile(one, stored, ["g"], ["k"], ["v", "w"], ["s", "t"]).collect()}
    assert codes(near) == {"MATCHED": 2}
    assert codes(near.withColumn("s", F.lit(""))) == {"LEGACY_BLANKED": 2}
    assert codes(near.withColumn("w", F.when(F.col("k") == "1", F.col("w")))) == {"MATCHED": 1, "LEGACY_BLANKED": 1}
    assert codes(near.withColumn("v", F.col("v") * (1 + 4e-9))) == {"MISSING": 2, "FABRICATED": 2}


def test_reconcile_of_days_assigned_anew(spark):
    source = spark.createDataFrame([("t", "d1", "1", 1.0), ("t", "d1", "2", 2.0), ("u", "d1", "3", 3.0)], "g string, d string, k string, v double")
    stored = source.withColumn("d", F.when(F.col("k") == "2", "d2").otherwise(F.col("d")))
    got = rows(verify.reconcile_windows(source, stored, ["g"], "d", ["k"], ["v"]).select("g", F.coalesce("d", F.lit("-")).alias("d"), "code", "n"))
    assert got == [("t", "-", "MATCHED", 2), ("u", "d1", "MATCHED", 1)]
    near = verify.closest(spark.createDataFrame([("g", "r1", "a", "b"), ("h", "r2", "a", "b")], "g string, id string, x string, y string"), spark.createDataFrame([("g", "s1", "a", "z"), ("g", "s2", "a", "b")], "g string, id string, x string, y string"), ["g"], "id", ["x", "y"])
    assert rows(near) == [("g", "r1", "s2", 2), ("h", "r2", None, 0)]
    codes = spark.range(1).select(*[verify.issue_code(c, ["i"], F.lit(b)) for c, b in ((F.array(F.lit("i")), False), (F.array(F.lit("i"), F.lit("v")), False), (F.array(F.lit("v")), True), (F.lit(None).cast("array<string>"), False), (F.array().cast("array<string>"), False))]).first()
    assert tuple(codes) == ("LONG_ID_LOSS", "VALUE_MISMATCH", "LEGACY_BLANKED", "VALUE_MISMATCH", None)


@pytest.mark.parametrize("hot", [3, 40, 1000])
def test_closest_rows_equal_all_pairs(spark, hot):
    r = random.Random(hot)
    row = lambda: (r.choice("gh"), r.choice(["a", "b", None]), r.randint(0, 40), r.choice(["x", None]), r.randint(0, 3) / 2, r.randint(0, 3000))
    a, b = [(i, *row()) for i in range(60)] + [(99, "k", "a", 1, "x", 0.5, 1)], [(i, *row()) for i in range(1000, 1400)]
    schema = "id int, g string, c1 string, c2 int, c3 string, c4 double, c5 int"
    want = {}
    for x in a:
        near = [(sum(p == q for p, q in zip(x[2:], y[2:])), y[0]) for y in b if y[1] == x[1]]
        want[x[0]] = max(near) if near else (0, None)
    got = verify.closest(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["g"], "id", ["c1", "c2", "c3", "c4", "c5"], hot)
    assert {x["id"]: (x["equal"], x["source_id"]) for x in got.collect()} == want


def test_closest_in_a_group_of_20000(spark):
    source = spark.range(20000).select(F.lit("g").alias("g"), "id", (F.col("id") % 3).alias("x"), F.lit("same").alias("y"), (F.col("id") * 7).alias("z"))
    left = spark.createDataFrame([("g", 5, 1, "same", 700), ("g", 6, 2, "same", -1), ("g", 7, -1, "other", -1)], "g string, id long, x long, y string, z long")
    got = {r["id"]: (r["source_id"], r["equal"]) for r in verify.closest(left, source, ["g"], "id", ["x", "y", "z"]).collect()}
    assert got == {5: (100, 3), 6: (19997, 2), 7: (19999, 0)}


def test_closest_makes_no_pairs_of_frequent_values(spark):
    """A thousand asked rows and 9,000 source rows in one group, with as many combinations of frequent values: by pairs these are nine million comparisons."""
    row = lambda k: [F.lit("g").alias("g"), "id", (k % 100).alias("x"), (k / 100).cast("int").alias("y")]
    source, left = spark.range(9000).select(*row(F.col("id"))), spark.range(0, 9000, 9).select(*row(F.col("id") + 9000))
    got = verify.closest(left, source, ["g"], "id", ["x", "y"], 10)
    assert "zip_with" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["source_id"] - 8900 - r["id"] % 100, r["equal"]) for r in got.collect()} == {(0, 1)}


@pytest.mark.parametrize("hot", [3, 40, 1000])
def test_closest_rows_of_many_columns_equal_all_pairs(spark, hot):
    r = random.Random(hot)
    row = lambda: (r.choice("gh"), *(r.choice([0, 1, 2, None]) for _ in range(6)), r.randint(0, 200))
    a, b = [(i, *row()) for i in range(60)] + [(99, "k", *range(7))], [(i, *row()) for i in range(1000, 1400)]
    names = [f"c{k}" for k in range(7)]
    schema = "id int, g string, " + ", ".join(f"{n} int" for n in names)
    want = {}
    for x in a:
        near = [(sum(p == q for p, q in zip(x[2:], y[2:])), y[0]) for y in b if y[1] == x[1]]
        want[x[0]] = max(near) if near else (0, None)
    got = verify.closest(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["g"], "id", names, hot)
    assert {x["id"]: (x["equal"], x["source_id"]) for x in got.collect()} == want


def plain_most(source, store, fits):
    """The largest number of stored rows that can have a source row of their own, by augmenting paths over single rows."""
    left, right = [j for j, n in store.items() for _ in range(n)], [i for i, n in source.items() for _ in range(n)]
    partner = {}

    def seek(p, seen):
        for q, i in enumerate(right):
            if q not in seen and fits(i, left[p]):
                seen.add(q)
                if q not in partner or seek(partner[q], seen):
                    partner[q] = p
                    return True
        return False

    return sum(seek(p, set()) for p in range(len(left)))


def test_residues_are_matched_as_fully_as_can_be():
    # first-fit would give the source row of 1 + 1e-9 to the first stored row, and leave the second one without
    t = 1e-9
    assert verify.residue([1, 1, -1, -1], [[1.0], [1 + 1.6e-9], [1 + 0.8e-9], [1 + 2.4e-9]], [[]] * 4, t) == {"MATCHED": 2, "LEGACY_BLANKED": 0, "MISSING": 0, "FABRICATED": 0}
    assert verify.residue([1, 1, -1, -1], [[1.0, 2.0], [1.0, 3.0], [1.0, None], [1.0, 2.0 * (1 + 2e-9)]], [[]] * 4, t) == {"MATCHED": 0, "LEGACY_BLANKED": 1, "MISSING": 1, "FABRICATED": 1}
    r = random.Random(3)
    for _ in range(150):
        n = r.randint(2, 12)
        numbers = [[r.choice([None, 0.0, 1.0, 1 + 0.7e-9, 1 + 1.4e-9, 1 + 2.1e-9]), r.choice([None, 5.0, 5.0, 6.0])] for _ in range(n)]
        texts, over = [[r.choice([None, "", "x", "x"])] for _ in range(n)], [r.choice([-2, -1, 1, 2]) for _ in range(n)]
        close = lambda x, y: x == y or (x is not None and y is not None and abs(x - y) <= t * (1 if x == 0 or y == 0 else max(abs(x), abs(y))))
        blank = lambda x: not x
        equal = lambda i, j: all(map(close, numbers[i], numbers[j])) and all(x == y or (blank(x) and blank(y)) for x, y in zip(texts[i], texts[j]))  # noqa: B023, E731
        source, store = {i: k for i, k in enumerate(over) if k > 0}, {i: -k for i, k in enumerate(over) if k < 0}
        got = verify.residue(over, numbers, texts, t)
        assert got["MATCHED"] == plain_most(source, store, equal)
        assert got["MATCHED"] + got["LEGACY_BLANKED"] + got["FABRICATED"] == sum(store.values()) and got["MATCHED"] + got["LEGACY_BLANKED"] + got["MISSING"] == sum(source.values())


def test_large_residues_take_no_quadratic_time():
    n = 10_000
    numbers = [[float(i), 1.0] for i in range(n)] + [[i * (1 + 4e-10), 1.0] for i in range(n)]
    start = time.time()
    assert verify.residue([1] * n + [-1] * n, numbers, [["x"]] * 2 * n, 1e-9)["MATCHED"] == n
    # no number is given in the store: all go through one hub
    assert verify.residue([1] * n + [-1] * n, numbers[:n] + [[None, None]] * n, [["x"]] * n + [[""]] * n, 1e-9) == {"MATCHED": 0, "LEGACY_BLANKED": n, "MISSING": 0, "FABRICATED": 0}
    assert time.time() - start < 20


def test_totals_and_distinct_ids_over_spans(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4), (None, "x", 8)], "k string, s string, n int")
    got = {tuple(r) for r in reports.subtotals(df, [["k", "s"], ["k"], []], {"n": F.sum("n")}, {"k": "all", "s": "sum"}).collect()}
    assert got == {("a", "x", 1), ("a", "y", 2), ("b", "x", 4), (None, "x", 8), ("a", "sum", 3), ("b", "sum", 4), (None, "sum", 8), ("all", "sum", 15)}
    plan = reports.with_total(df.groupBy("k").agg(F.sum("n").alias("n")), "k", "total", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    r = random.Random(1)
    visits = [(f"2026-01-{1 + r.randint(0, 20):02d}", r.choice([None, *range(0, 200_000, 900), 5, 6, 7])) for _ in range(3000)]
    sets = reports.daily_sets(spark.createDataFrame(visits, "day string, id long"), "day", "id")
    spans = [("a", "2026-01-01", "2026-01-31"), ("b", "2026-01-03", "2026-01-04"), ("c", "2026-01-09", "2026-01-09")]
    got = {x["span"]: x["n"] for x in reports.distinct_over(sets, spark.createDataFrame(spans, "span string, first string, last string"), "day", ["span"]).collect()}
    assert got == {s: len({i for d, i in visits if i is not None and a <= d <= b}) for s, a, b in spans}


def test_blank_columns_keep_their_first_and_rows_without_a_place_come_first(spark):
    df = spark.createDataFrame([("k", 1, " ", "a"), ("k", 2, "", "\u00a0"), ("k", 3, None, "b")], "k string, at int, x string, y string")
    assert rows(dedup.coalesce_merge(df, ["k"], ["x", "y"], F.col("at"))) == [("k", " ", "b")]
    last = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 1, "z")], "k string, at int, v string")
    assert rows(dedup.keep_last(last, ["k"], "at").select("k", "v")) == [("a", "x"), ("b", "z")]
    assert rows(dedup.exact_fold(last, ["k"], ["at"]).select("k", "v")) == [("a", "x"), ("b", "y")]


def test_matching_by_a_records_own_id(spark):
    ids = spark.createDataFrame([("27184856", "1157860")], "ext_id string, id string")
    names = spark.createDataFrame([("店A", "1157861")], "name string, id string")
    given = spark.createDataFrame([(1, "27184856", None, "店A"), (2, "1157861", None, None), (3, "-999", None, "店A"), (4, " ", None, "店A"), (5, None, "27184856", "x")], "i int, own string, ext string, nm string")
    got = entity.cascade_match(given, ids, names, F.col("ext"), F.col("nm"), own_id=F.col("own"))
    assert rows(got.select("i", "sid")) == [(1, "1157860"), (2, "1157861"), (3, None), (4, "1157861"), (5, "1157860")]
    # the outer id goes before the own one, whatever that says
    both = spark.createDataFrame([(1, "1157861", "27184856", "x"), (2, "1157861", "-5", "x")], "i int, own string, ext string, nm string")
    assert rows(entity.cascade_match(both, ids, names, F.col("ext"), F.col("nm"), own_id=F.col("own")).select("i", "sid")) == [(1, "1157860"), (2, None)]

def test_samples_and_fingerprints_do_not_depend_on_order(spark):
    df = spark.range(500).select("id", (F.col("id") * 2).alias("v"))
    pick = lambda d: sorted(r[0] for r in verify.hash_sample(d, "7", [F.col("id")], 20).collect())
    assert pick(df) == pick(df.orderBy(F.desc("id")).repartition(7)) and pick(df) != sorted(r[0] for r in verify.hash_sample(df, "8", [F.col("id")], 20).collect())
    assert verify.fingerprint(df).first() == verify.fingerprint(df.repartition(5)).first() != verify.fingerprint(df.where("id > 0")).first()
    headers = spark.createDataFrame([("t", ["a", "c", "b"]), ("u", ["a", "b", "c", "d"]), ("v", ["a", "b", "c"])], "f string, h array<string>")
    assert rows(verify.faults_of_headers(headers, "h", ["a", "b", "c"]).drop("h")) == [("t", 1, "c", "b"), ("t", 2, "b", "c"), ("u", 3, "d", None)]
    blanks = spark.createDataFrame([("-", ""), ("a", ""), ("a", "b")], "a string, b string")
    assert verify.blank_keys(blanks, ["a", "b"], ["b"]).first() == (1, 1)
    assert verify.all_on_day(blanks.select(F.lit("2026-08-01 09:00").alias("c")), F.col("c"), "20260801").first()[0]


@pytest.mark.parametrize("n", [4, 11])
def test_topk_share_is_the_same_for_any_partitioning(spark, n):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), F.lit(1).cast("decimal(18,2)").alias("v")).repartition(n)
    assert rows(reports.topk_share(df, "k", F.col("v"), 2), "rn") == [(0, Decimal("10.00"), 1, 0.1), (1, Decimal("10.00"), 2, 0.1)]


def test_resuming_and_sources(spark):
    tasks = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "task_key string")
    results = spark.createDataFrame([("a", "failed"), ("a", "validated"), ("b", "failed"), ("c", "failed"), ("c", "failed"), ("c", "failed")], "task_key string, status string")
    assert rows(planning.resume(tasks, results)) == [("b",), ("d",)]
    steps = spark.createDataFrame([("validated", None, 1, False), ("failed", "login_required", 1, False), ("failed", "timeout", 1, False), ("failed", None, 3, False), ("failed", None, 3, True)], "s string, c string, n int, k boolean")
    got = steps.select(planning.next_step(F.col("s"), F.col("c"), F.col("n"), F.col("k"))).collect()
    assert [r[0] for r in got] == ["skip", "stop", "retry", "give_up", "skip"]
    there = spark.createDataFrame([("d1", "api", "p1", 5), ("d1", "export", "p2", 0), ("d2", "export", "p3", 1), ("d2", "api", "p4", 9), ("d3", "api", "p5", 0)], "day string, kind string, path string, n_rows int")
    assert rows(planning.source_of(there, ["export", "api"])) == [("d1", "api", "p1"), ("d2", "export", "p3")]
    days = spark.createDataFrame([(1, ["20260101"]), (2, ["20260101", "20260109"])], "i int, d array<string>")
    assert [r["i"] for r in planning.outside_window(days, F.col("d"), "20260101", "20260105").collect()] == [2]
    assert days.select(planning.merged_options(F.array(F.lit("z")), F.array(F.lit("b"), F.lit("a"), F.lit("z")))).first()[0] == ["z", "a", "b"]
