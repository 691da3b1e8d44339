"""The versioned store, its catalog, readers and streams."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyforge.plans.catalog import Catalog
from tallyforge.sources import readers, workbooks
from tallyforge.sources.store import DAY, SCOPE, Conflict, Store, classify_column, group_replace, retained, snapshot_replace
from tallyforge.streaming import events


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), f"`{DAY}` string, `{SCOPE}` string, v int")


def test_group_replace_clears_groups_without_data_and_leaves_other_scopes(spark):
    old = facts(spark, ("2026-01-01", "a", 1), ("2026-01-01", "b", 2), ("2026-01-02", "a", 3))
    new = facts(spark, ("2026-01-01", "a", 9), ("2026-01-01", "a", 9))
    gone = facts(spark, ("2026-01-02", "a", 0)).drop("v")
    got = sorted(map(tuple, group_replace(old, new, gone).collect()))
    assert got == [("2026-01-01", "a", 9), ("2026-01-01", "a", 9), ("2026-01-01", "b", 2)]


def test_batches_are_atomic_and_replays_change_nothing(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    assert s.read("f") is None
    assert s.apply("b1", {"f": facts(spark, ("2026-01-01", "a", 1)), "_coverage": facts(spark, ("2026-01-01", "a", 0))})
    assert not s.apply("b1", {"f": facts(spark, ("2026-01-01", "a", 7))})
    with pytest.raises(Conflict):
        s.apply("b2", {"_coverage": facts(spark, ("2026-01-01", "a", 5)), "f": facts(spark, ("2026-01-01", "a", 7)).withColumn("new", F.lit(1))})
    with pytest.raises(Exception, match="boom|raise_error|USER_RAISED"):
        s.apply("b3", {"_coverage": facts(spark, ("2026-01-01", "a", 5)), "f": facts(spark, ("2026-01-01", "a", 7)).withColumn("v", F.raise_error(F.lit("boom")).cast("int"))})
    assert [r["v"] for r in s.read("f").collect()] == [1] and [r["v"] for r in s.read("_coverage").collect()] == [0]
    assert s.apply("b4", {"f": group_replace(s.read("f").withColumn(DAY, F.col(DAY).cast("string")), facts(spark, ("2026-01-02", "a", 2)), facts(spark).drop("v"))})
    c = Catalog(s)
    assert c.tables() == ["_coverage", "f"] and c.status("f").first()["n_rows"] == 2
    assert [r["v"] for r in c.get("f", {"v": [1, 2]}, first="2026-01-02").collect()] == [2]
    assert c.get("f", pending=("v",)).first()["v"] is None and SCOPE not in c.get("f").columns
    assert {r["table"]: (r["n_rows"], r["no_scope"]) for r in c.audit().collect()} == {"f": (2, 0), "_coverage": (1, 0)}


def test_retention_boundary(spark, tmp_path):
    df = facts(spark, ("2025-01-01", "a", 1), ("2025-01-02", "a", 2), ("2030-01-01", "a", 3), (None, "a", 4))
    today = F.lit("2026-01-02").cast("date")
    assert sorted(r["v"] for r in retained(df, DAY, today).collect()) == [2, 3, 4]
    s = Store(spark, f"file://{tmp_path}/store")
    s.apply("b1", {"f": df.where(F.col(DAY).isNotNull())})
    assert s.purge("p", ["f"], today, dry_run=True) == {"f": 1} and s.read("f").count() == 3
    assert s.purge("p", ["f"], today) == {"f": 1} and s.read("f").count() == 2


def test_snapshot_guard(spark):
    old = spark.createDataFrame([("2026-01-10", 1)], "e string, v int")
    assert snapshot_replace(old, spark.createDataFrame([("2026-01-11", 2)], "e string, v int"), "e").first()["v"] == 2
    with pytest.raises(Conflict):
        snapshot_replace(old, spark.createDataFrame([("2026-01-09", 2)], "e string, v int"), "e")
    assert snapshot_replace(old, old.where("v > 1"), "e").count() == 0
    with pytest.raises(Conflict):
        snapshot_replace(old.union(spark.createDataFrame([("2026-01-11", 1)], "e string, v int")), old, "e")
    assert classify_column("下单转化率") == ("比率", "formal", "原件直取") and classify_column("有效订单金额")[0] == "元" and classify_column("人数_pp")[0] == "百分点"
    assert classify_column("退款率_未决") == ("元", "pending", None) and classify_column("门店") == (None, "formal", "原件直取")


def test_only_touched_partitions_are_rewritten_and_writers_do_not_meet(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    first = facts(spark, ("2026-01-01", "a", 1), ("2026-01-01", "b", 2), ("2026-01-02", "a", 3), ("2026-01-03", "甲 /", 4))
    s.replace("b1", {"f": (first, first.drop("v"))})
    new = facts(spark, ("2026-01-01", "a", 9), ("2026-01-01", "a", 9))
    s.replace("b2", {"f": (new, facts(spark, ("2026-01-01", "a", 0), ("2026-01-02", "a", 0)).drop("v"))})
    assert sorted(map(tuple, s.read("f").select(DAY, SCOPE, "v").collect())) == [("2026-01-01", "a", 9), ("2026-01-01", "a", 9), ("2026-01-01", "b", 2), ("2026-01-03", "甲 /", 4)]
    held = s.current()["tables"]["f"]
    assert {x.split(".")[0] for x in held.values()} == {"b1", "b2"} and len(list((tmp_path / "store/f").glob(f"b=b2.*/{DAY}=*/*"))) == 1
    assert [r["v"] for r in s.read("f", facts(spark, ("2026-01-03", "甲 /", 0)).drop("v")).collect()] == [4]
    s.replace("b3", {"f": (facts(spark), facts(spark, ("2026-01-03", "甲 /", 0)).drop("v"))})
    assert s.read("f").count() == 3


def group(spark, *rows):
    return spark.createDataFrame(list(rows), f"`{DAY}` string, `{SCOPE}` string")


def contents(s, table="f"):
    return sorted(map(tuple, s.read(table).select(DAY, SCOPE, "v").collect()))


def test_a_writer_that_lost_is_refused_and_leaves_the_winners_rows(spark, tmp_path):
    """Both hold the state of before; one publishes; the other wrote the same batch or the same group, and is refused or changes nothing."""
    a, b = (Store(spark, f"file://{tmp_path}/store") for _ in range(2))
    a.replace("b0", {"f": (facts(spark, ("2026-01-01", "a", 0), ("2026-01-02", "a", 0)), None)})
    same = b.prepare("b1", {"f": (facts(spark, ("2026-01-01", "a", 7)), group(spark, ("2026-01-01", "a")))})
    other = b.prepare("b2", {"f": (facts(spark, ("2026-01-01", "a", 8)), group(spark, ("2026-01-01", "a")))})
    whole = b.prepare("b3", {"f": (facts(spark, ("2026-01-09", "a", 9)), None)})
    assert a.replace("b1", {"f": (facts(spark, ("2026-01-01", "a", 1)), group(spark, ("2026-01-01", "a")))})
    want = [("2026-01-01", "a", 1), ("2026-01-02", "a", 0)]
    assert b.publish(same) is False and contents(a) == want
    for change in (other, whole):
        with pytest.raises(Conflict):
            b.publish(change)
        assert contents(a) == want and contents(b) == want
    assert a.current()["batches"] == ["b0", "b1"]


def test_a_writer_that_lost_publishes_on_top_where_nobody_met(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    s.replace("b0", {"f": (facts(spark, ("2026-01-01", "a", 0), ("2026-01-02", "a", 0), ("2026-01-03", "a", 0)), None), "g": (spark.range(2), None)})
    late = s.prepare("late", {"f": (facts(spark, ("2026-01-02", "a", 5)), group(spark, ("2026-01-02", "a")))})
    s.replace("b1", {"f": (facts(spark, ("2026-01-01", "a", 1)), group(spark, ("2026-01-01", "a"), ("2026-01-03", "a"))), "g": (spark.range(5), None)})
    assert s.publish(late) and s.publish(late) is False
    assert contents(s) == [("2026-01-01", "a", 1), ("2026-01-02", "a", 5)] and s.read("g").count() == 5


def test_two_that_take_the_same_number_and_one_that_stalls(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    s.apply("b0", {"g": spark.range(1)})
    number, state = s._newest()
    assert s._create(number + 1, state | {"batches": ["b0", "x"]}) and not s._create(number + 1, state)
    assert s.current()["batches"] == ["b0", "x"] and len(list((tmp_path / "store/state").glob("[!.]*.json"))) == 2
    # a writer that died or waits before the rename has published nothing, and nobody waits for it
    (tmp_path / "store/state/.stalled").write_text('{"batches": [')
    stalled = s.prepare("slow", {"h": (spark.range(3), None)})
    assert s.apply("b1", {"g": spark.range(2)}) and s.read("g").count() == 2 and s.read("h") is None
    assert s.publish(stalled) and s.read("h").count() == 3 and s.current()["batches"] == ["b0", "x", "b1", "slow"]


def test_keys_are_checked_before_a_batch_is_seen(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([("2026-01-01", "a", "x"), ("2026-01-01", "a", " ")], f"`{DAY}` string, `{SCOPE}` string, id string")
    with pytest.raises(Conflict, match="id"):
        s.apply("b1", {"f": rows, "g": spark.range(1)}, keys={"f": [DAY, "id"]})
    assert s.read("f") is None and s.read("g") is None
    assert s.apply("b1", {"f": rows.where("id = 'x'")}, keys={"f": [DAY, "id"]}) and s.read("f").count() == 1


def test_many_writers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    s = Store(spark, f"file://{tmp_path}/store")
    s.apply("b0", {"f": facts(spark, *[(f"2026-01-{i:02d}", "a", 0) for i in range(1, 9)])})
    days = [f"2026-01-{i:02d}" for i in range(1, 9)]
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda d: Store(spark, s.root).replace(f"b-{d}", {"f": (facts(spark, (d, "a", 1)), group(spark, (d, "a")))}), days))
    assert all(done) and contents(s) == [(d, "a", 1) for d in days]


def test_compaction_and_sweep(spark, tmp_path):
    from tallyforge.operators.verify import fingerprint

    s = Store(spark, f"file://{tmp_path}/store")
    first = facts(spark, *[(f"2026-01-0{1 + i % 3}", "甲 /" if i % 2 else "b", i) for i in range(300)]).repartition(6)
    s.apply("b1", {"f": first, "g": spark.range(100).repartition(5)})
    s.replace("b2", {"f": (facts(spark, ("2026-01-01", "b", -1)), group(spark, ("2026-01-01", "b")))})
    before, files = fingerprint(s.read("f")).first(), s.files("f")
    kept = s.prepare("held", {"h": (spark.range(1), None)})
    assert s.compact("c", ["f", "g"]) == {"f": 5, "g": 1} and s.compact("c2", ["f", "g"]) == {}
    assert fingerprint(s.read("f")).first() == before and sum(map(len, s.files("f").values())) == 6 < sum(map(len, files.values()))
    assert s.read("g").count() == 100 and len(s.files("g")[""]) == 1
    # a partition of more bytes than a file may have is dealt out to several
    many = s.compact("c3", ["f"], file_bytes=max(x[0] for x in s.files("f").values()) // 3)
    assert many == {} and s.compact("c4", ["g"], 1 << 40) == {}
    # nothing young goes; later, what no state names goes: the first batch but for nothing, the group that was rewritten
    assert s.sweep() == 0
    assert s.sweep(grace=0) > 0 and s.publish(kept) is True
    assert fingerprint(s.read("f")).first() == before and s.read("g").count() == 100
    assert {x.name.split(".")[0] for x in (tmp_path / "store/f").iterdir()} == {"b=b2", "b=c"} and len(list((tmp_path / "store/state").glob("[!.]*.json"))) == 2


def test_partitions_of_many_bytes_become_several_files(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    rows = spark.range(20000).select(F.lit("2026-01-01").alias(DAY), F.when(F.col("id") < 50, "a").otherwise("b=1").alias(SCOPE), F.xxhash64("id").alias("v"))
    s.apply("b1", {"f": rows.repartition(40)})
    sizes = {k: sum(x) for k, x in s.files("f").items()}
    assert s.compact("c", ["f"], file_bytes=max(sizes.values()) // 4) == {k: 2 for k in ["f"]}
    found = sorted(len(x) for x in s.files("f").values())
    assert found[0] == 1 and 3 <= found[1] <= 6 and s.read("f").count() == 20000 and s.read("f").agg(F.bit_xor("v")).first() == rows.agg(F.bit_xor("v")).first()


def test_purged_rows_leave_the_disk(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    s.apply("b1", {"f": facts(spark, ("2024-01-01", "a", 1), ("2026-01-01", "a", 2))})
    s.maintain("m", f"file://{tmp_path}/to", ["f"], F.lit("2026-01-02").cast("date"), grace=0)
    assert contents(s) == [("2026-01-01", "a", 2)] and not list((tmp_path / "store/f").glob(f"b=*/{DAY}=2024*/*/*.parquet"))


def test_maintenance_and_legacy(spark, tmp_path):
    from tallyforge.sources import store

    s = Store(spark, f"file://{tmp_path}/store")
    s.apply("b1", {"f": facts(spark, ("2024-01-01", "a", 1), ("2026-01-01", "a", 2))})
    today = F.lit("2026-01-02").cast("date")
    assert s.maintain("m", f"file://{tmp_path}/to", ["f"], today, dry_run=True) ["expired"] == {"f": 1} and s.read("f").count() == 2
    done = s.maintain("m", f"file://{tmp_path}/to", ["f"], today)
    assert done["backup"]["f"]["rows"] == 2 and s.read("f").count() == 1
    old = spark.createDataFrame([("a", "A" * 64), ("b", "见附件"), ("c", None)], "path string, sha256 string")
    files = spark.createDataFrame([("b", bytearray(b"x"))], "path string, content binary")
    got = {r["path"]: (r["sha256"], r["noted"]) for r in store.legacy_hashes(old, files).collect()}
    assert got["a"] == ("a" * 64, None) and got["b"][0].startswith("2d711642") and got["b"][1] == "见附件" and got["c"] == (None, None)
    rows = store.legacy_prepared(spark.createDataFrame([("20260801", "x", 1), (None, "y", 1)], "d string, v string, _own int"), ["_own"], "t", "p", "d")
    assert sorted((r["v"], r[DAY], r["数据表"]) for r in rows.collect()) == [("x", "2026-08-01", "t"), ("y", None, "t")] and "_own" not in rows.columns
    groups = spark.createDataFrame([("t", "2026-01-01", "a", "no_data", [("p", "h")])], f"`table` string, `{DAY}` string, `{SCOPE}` string, status string, files array<struct<path:string,sha256:string>>")
    assert store.coverage_rows(groups, "b", facts(spark).withColumn("table", F.lit("t"))).first()["rows"] == 0 and store.lineage_rows(groups, "b").first()["path"] == "p"


def test_text_tables_of_both_encodings(spark, tmp_path):
    (tmp_path / "门店_20260801.csv").write_bytes("门店名称,金额\n示例店,1.5\n,\n短\n".encode("gbk"))
    (tmp_path / "门店_20260802.csv").write_bytes("门店名称,金额\n示例店,2.5,多\n".encode("utf-8-sig"))
    df = readers.csv_table(spark, [f"file://{p}" for p in sorted(map(str, tmp_path.glob("*.csv")))], ["name", "amount"])
    df = readers.table_name(readers.business_day(df, "d"), "t")
    assert sorted((r["name"], r["amount"], r["d"]) for r in df.collect()) == [("短", "", "2026-08-01"), ("示例店", "1.5", "2026-08-01"), ("示例店", "2.5", "2026-08-02")]


def flat(spark, layers, merged):
    kind = workbooks.ROWS
    rows = spark.createDataFrame([("p", i, r, merged if i == 0 else None) for i, r in enumerate(layers)], kind)
    return [r["name"] for r in workbooks.header_names(rows, len(layers)).orderBy("place").collect()]


def test_headers_of_several_layers(spark):
    assert flat(spark, [["店", "销售", "", "x"], ["店", "金额", "单数", "x"]], [(0, 0, 1, 0), (0, 1, 0, 2), (0, 3, 1, 3)]) == ["店", "销售_金额", "销售_单数", "x"]
    # a layer that says one thing is dropped; a group with fewer names below it is its first column's own name; unnamed columns count from 0
    assert flat(spark, [["品类", "金额"], ["", "本期"]], [(0, 0, 1, 0)]) == ["品类", "金额"]
    assert flat(spark, [["商品信息", "", "", ""], ["", "编码", "条码", ""]], [(0, 0, 0, 2)]) == ["商品信息", "编码", "条码", "col3"]
    assert flat(spark, [["a", "", "", "b"], ["x", "", "y", "z"]], [(0, 0, 0, 2)]) == ["a", "x", "y", "b_z"]
    assert flat(spark, [["店（一）", "甲", ""], ["", "", "乙"]], []) == ["店(一)", "甲", "col2"]  # 乙 alone in its layer tells nothing apart
    assert flat(spark, [["g", "", "k"], ["m", "n", "k"], ["1", "2", ""]], [(0, 0, 0, 1), (0, 2, 2, 2)]) == ["g_m", "g_n", "k"]
    assert flat(spark, [["only"]], []) == ["only"] and flat(spark, [["", " b "]], []) == ["col0", "b"]


def test_sheets(spark, tmp_path):
    from tallyforge.sources import writers

    cell = lambda ref, text: f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'
    body = f'<row r="1">{cell("A1", "店（一）")}{cell("B1", "金额")}</row><row r="3">{cell("A3", "甲")}<c r="B3"><v>2</v></c></row><row r="4"><c r="C4"/></row>'
    main = workbooks.MAIN.strip("{}")
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/a.xlsx")
    got = workbooks.sheet_table(workbooks.sheet_rows(files), ["金额", "店(一)", "没有"]).collect()
    assert [tuple(r)[1:] for r in got] == [("2", "甲", "")] and readers.file_kind(files).first()["kind"] == "xlsx"
    with zipfile.ZipFile(tmp_path / "s.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>名</t></si><si><r><t>a</t></r><r><t>b</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row><c t="s"><v>0</v></c></row><row><c t="s"><v>1</v></c></row></sheetData></worksheet>')
    assert [(n, c) for n, c in workbooks.pulled((tmp_path / "s.xlsx").read_bytes())] == [(0, ["名"]), (1, ["ab"])]
    own = workbooks.sheets(spark, [f"file://{tmp_path}/a.xlsx", f"{tmp_path}/s.xlsx"])
    assert sorted((r["_path"][-6:], r["row"]) for r in own.collect()) == [("a.xlsx", 0), ("a.xlsx", 2), ("a.xlsx", 3), ("s.xlsx", 0), ("s.xlsx", 1)]
    assert sorted(r["row"] for r in own.where("row >= 1 and row < 3").collect()) == [1, 2]
    writers.workbook(spark.range(3000).selectExpr("id", "concat('<', id, '>') as name"), f"file://{tmp_path}/w/b.xlsx", ["A1:B1"], [["一", ""], ["id", "name"]])
    rows = workbooks.sheet_rows(spark.read.format("binaryFile").load(f"file://{tmp_path}/w/b.xlsx"))
    table = workbooks.sheet_table(rows, ["一_id", "一_name"], 2)
    assert table.count() == 3000 and table.where("`一_name` = concat('<', `一_id`, '>')").count() == 3000


def test_raw_tables_report_what_they_cannot_read(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("名,b\n1,2\n,\n".encode("gbk"))
    (tmp_path / "b.csv").write_bytes(b"\xff\xfe\xff\xff\x81")
    (tmp_path / "c.csv").write_bytes(b"\n")
    got = {r["path"][-5:]: (r["header"], r["rows"]) for r in readers.raw_tables(spark.read.format("binaryFile").load(f"file://{tmp_path}")).collect()}
    assert got == {"a.csv": (["名", "b"], [["1", "2"]]), "b.csv": (None, None), "c.csv": (None, None)}


def test_orders_and_messages(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"orders": [{"orderId": "1", "storeName": "s", "createTime": 0, "productList": [{"skuId": "a", "count": 2}, {"skuId": "b", "count": 1}]}, {"orderId": "2"}]}))
    assert sorted((r["orderId"], r["skuId"]) for r in readers.orders(spark, f"file://{tmp_path}/o.json").fillna("").collect()) == [("1", "a"), ("1", "b"), ("2", "")]
    (tmp_path / "m.jsonl").write_text('{"timestamp":"t","payload":{"role":"user","content":"x"}}\nbroken\n{"type":"assistant","message":{"content":[{"text":"y"}]}}\n')
    assert sorted(tuple(r) for r in readers.message_log(spark, f"file://{tmp_path}/m.jsonl").fillna("").collect()) == [("", "assistant", '[{"text":"y"}]'), ("t", "user", "x")]


def test_large_text_tables_are_split_among_tasks(spark, tmp_path):
    lines = [f"{i},店{i % 7},\"a,{i}\"" for i in range(30000)]
    (tmp_path / "x_20260801.csv").write_bytes("编号,名称,备注\n".encode("gbk") + "\r\n".join(lines).encode("gbk"))
    (tmp_path / "x_20260802.csv").write_bytes("编号,名称,备注\n1,二,\n,,\n2\n".encode("utf-8-sig"))
    (tmp_path / "x_20260803.csv").write_bytes("编号,名称,备注\n7,\"两\n行\",z\n".encode("gbk"))
    paths = [f"file:{tmp_path}/x_2026080{i}.csv" for i in (1, 2, 3)]
    told = {r["path"][-5:]: (r["encoding"], r["quoted"]) for r in readers.encodings_of(spark, paths).collect()}
    assert told == {"1.csv": ("gbk", False), "2.csv": ("utf-8-sig", False), "3.csv": ("gbk", True)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = readers.text_table(spark, paths, ["id", "name", "note"])
        assert df.rdd.getNumPartitions() > 8
        got = {(r["_path"][-5], r["id"], r["name"], r["note"]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert df.count() == len(got) == 30003
    assert got == {("1", str(i), f"店{i % 7}", f"a,{i}") for i in range(30000)} | {("2", "1", "二", ""), ("2", "2", "", ""), ("3", "7", "两\n行", "z")}
    listed = ["/a/x_20260801.csv", "/a/x_2026-08-01.csv", "/a/x_20260801_ch1.csv", "/a/xy_20260801.csv", "/a/x_other.csv"]
    assert readers.daily_files(listed, "x") == listed[:2]


def test_accepted_files(spark):
    from tallyforge.operators import verify

    files = spark.createDataFrame([("z", bytearray()), ("h", bytearray("a,b\n".encode())), ("p", bytearray("a,b\n".encode())), ("w", bytearray("b,a\n1,2,3\n".encode())), ("g", bytearray("a,b\n1\n".encode()))], "path string, content binary")
    got = {r["path"]: r for r in verify.acceptance(files, ["a", "b"], spark.createDataFrame([("p",)], "path string")).collect()}
    assert {k: r["faults"] for k, r in got.items()} == {"z": ["zero_bytes"], "h": ["no_evidence"], "p": [], "w": ["header_order", "width"], "g": []}
    assert (got["g"]["bytes"], got["g"]["width"], got["g"]["n_rows"]) == (6, 2, 1) and len(got["g"]["sha256"]) == 64


def test_dialects(spark):
    lines = ['{"type":"response_item","payload":{"type":"message","role":"user","content":[{"type":"text","text":"x"}]},"timestamp":"t"}', '{"type":"event_msg","payload":{"type":"user_message","content":"y"}}', '{"type":"event_msg","payload":{"type":"token_count","content":"n"}}', '{"type":"assistant","message":{"content":"z"}}', '{"role":"user","content":"w","created_at":"c"}', "broken", "3", '{"role":"user"}']
    got = sorted(tuple(r) for r in readers.dialect_rows(spark.createDataFrame([(x,) for x in lines], "value string")).fillna("").collect())
    assert got == [("event", "", "user", "y"), ("item", "t", "user", '[{"text":"x","type":"text"}]'), ("plain", "c", "user", "w"), ("wrapped", "", "assistant", "z")]


def test_streams_give_all_micro_batches(spark, tmp_path):
    """150 files, some a trigger: windows, sessions and runs are those of the whole table."""
    rows = [(i, f"2026-01-{1 + i // 40:02d} {i % 24:02d}:00:00", i % 7, "error" if i % 11 == 0 else "ok", 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id bigint, t string, user_id bigint, event_type string, value double").select("event_id", F.to_timestamp("t").alias("ts"), "user_id", "event_type", "value")
    import os

    for i in range(0, 600, 4):
        df.where(F.col("event_id").between(i, i + 3)).toPandas().to_parquet(tmp_path / f"{i:04d}.parquet", coerce_timestamps="us") if not (tmp_path / f"{i:04d}.parquet").exists() else None
        os.utime(tmp_path / f"{i:04d}.parquet", (i + 1, i + 1))
    for n, per in (("a", 25), ("b", 100)):
        stream = events.event_stream(spark, f"{tmp_path}/*.parquet", df.schema, per)
        got = events.gathered(events.windowed_counts(stream), "complete", f"{tmp_path}/{n}1")
        assert got.agg(F.sum("n"), F.sum("value")).first() == (600, 600.0) and got.count() == df.groupBy(F.to_date("ts"), "event_type").count().count()
        want = {}
        for r in rows:
            run, best = want.get(r[2], (0, 0))
            run = 0 if r[3] == "error" else run + 1
            want[r[2]] = (run, max(best, run))
        got = events.gathered(events.streaks(stream, ["error"], ["ok"]), "update", f"{tmp_path}/{n}2", ["user_id"]).collect()
        assert {r["user_id"]: (r["streak"], r["best"]) for r in got} == want and len(got) == 7


def test_events_out_of_order_late_twice_and_users_who_stay_away(spark, tmp_path):
    own = events.with_rocks(spark)
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string"
    day = lambda n: f"2026-{1 + n // 28:02d}-{1 + n % 28:02d} 00:00:00"
    batches = [
        [(1, 10, 1, "ok"), (3, 12, 1, "ok"), (10, 10, 2, "ok")],
        [(2, 11, 1, "error"), (1, 10, 1, "ok"), (11, 9, 2, "error"), (4, 14, 1, "ok")],  # earlier ones come later, one comes twice
        [(90, 40, 3, "ok")],  # the watermark passes day 14
        [(5, 13, 1, "error"), (6, 60, 1, "ok")],  # too late, and after the ttl: user 1 begins anew
        [(91, 300, 3, "ok")],
        [(92, 330, 3, "ok")],
    ]
    out = []
    for i, rows in enumerate(batches):
        spark.createDataFrame([(e, day(d), u, k) for e, d, u, k in rows], "event_id bigint, t string, user_id bigint, event_type string").select("event_id", F.to_timestamp("t").alias("ts"), "user_id", "event_type").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = own.readStream.schema(schema).parquet(f"{tmp_path}/in")
        # each run begins again from the checkpoint of the one before
        out = [tuple(r) for r in events.gathered(events.ordered_streaks(stream, ["error"], ["ok"], ttl="30 days", late="20 days"), "append", f"{tmp_path}/q").collect()]
    got = {}
    for user, at, *rest in sorted(out, key=lambda r: (r[0], r[1], r[5])):
        got.setdefault(user, []).append(tuple(rest))
    assert got[1] == [(2, 2, 4, False), (2, 2, 4, True), (1, 1, 1, True)] or got[1] == [(2, 2, 4, False), (1, 1, 1, True)] or got[1] == [(2, 2, 4, True), (1, 1, 1, True)], got
    assert got[2][-1] == (1, 1, 2, True)


class CountedState:
    """A handle, its states and its times, which count the calls; what a test of Held needs of them."""

    def __init__(self):
        self.calls, self.list, self.value = 0, [], None

    def getListState(self, name, schema):  # noqa: N802
        return self

    getMapState = getListState  # noqa: N815

    def getValueState(self, name, schema):  # noqa: N802
        return type("Value", (), {"get": lambda s: self.value, "exists": lambda s: self.value is not None, "update": lambda s, v: setattr(self, "value", v), "clear": lambda s: setattr(self, "value", None)})()

    def counted(self, *of):
        self.calls += 1

    registerTimer = deleteTimer = containsKey = counted  # noqa: N815

    def updateValue(self, key, value):  # noqa: N802
        self.counted()

    def appendValue(self, value):  # noqa: N802
        self.counted()
        self.list.append(value)

    def get(self):
        return iter(self.list)

    def put(self, values):
        self.list = list(values)

    def clear(self):
        self.list = []

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return 250


def test_events_are_held_by_one_call_a_user_and_trigger(spark):
    import pandas as pd

    state, held = CountedState(), events.Held(["error"], ["ok"], None)
    held.init(state)
    list(held.handleInputRows((1,), iter([pd.DataFrame({"event_id": range(500), "ms": range(500), "event_type": ["error"] + ["ok"] * 499})]), None))
    assert state.calls <= 3
    list(held.handleInputRows((1,), iter([pd.DataFrame({"event_id": [7, 600], "ms": [7, 3], "event_type": ["ok", "error"]})]), None))
    got = pd.concat(held.handleExpiredTimer((1,), state, None))
    # of events 0 to 250 and 600 (at 3, after event 3) those after the failure
    assert got[["streak", "best", "n"]].values.tolist() == [[247, 247, 252]]
    assert sum(len(ids) for ids, _, _ in state.list) == 249


def test_rows_of_a_raw_file_are_given_in_parts(spark):
    body = "a, b\n" + "".join(f"{i},x\n,\n" for i in range(25))
    files = spark.createDataFrame([("p", body.encode()), ("q", b"\xff\xff"), ("r", b"a\n")], "path string, content binary")
    got = readers.raw_rows(files, ("utf-8",), 10)
    assert sorted((r["path"], tuple(r["header"]), int(r["row"][0])) for r in got.collect()) == [("p", ("a", "b"), i) for i in range(25)]


def test_a_plan_meets_its_results_over_a_restart(spark, tmp_path):
    def add(name, rows):
        spark.createDataFrame(rows, "task bigint, t string").select("task", F.to_timestamp("t").alias("t")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    def run():
        p = spark.readStream.schema("task bigint, t timestamp").parquet(f"{tmp_path}/plan").withColumnRenamed("t", "due")
        r = spark.readStream.schema("task bigint, t timestamp").parquet(f"{tmp_path}/results").withColumnRenamed("t", "at")
        return sorted((x["task"], x["status"]) for x in events.gathered(events.collected_or_not(p, r), "append", f"{tmp_path}/q").where("task > 0").collect())

    add("plan", [(1, "2026-01-01"), (2, "2026-01-01"), (3, "2026-01-01"), (4, "2026-01-03")])
    add("results", [(1, "2026-01-01 05:00:00"), (2, "2026-01-02 01:00:00")])
    assert run() == [(1, "collected")]
    add("plan", [(-1, "2026-01-05")])
    add("results", [(4, "2026-01-03 02:00:00"), (-1, "2026-01-05")])
    assert run() == [(1, "collected"), (2, "not_collected"), (3, "not_collected"), (4, "collected")]
    add("plan", [(-2, "2026-03-01"), (5, "2026-02-28")])
    add("results", [(3, "2026-01-01 03:00:00"), (-2, "2026-03-01"), (5, "2026-02-28 23:00:00")])  # that of 3 is too late
    assert run() == [(1, "collected"), (2, "not_collected"), (3, "not_collected"), (4, "collected"), (5, "collected")]


def test_streams(spark, tmp_path):
    from pyspark.sql import SparkSession  # noqa: F401

    rows = [(i, f"2026-01-0{1 + i % 3} 00:00:0{i % 10}", i % 4, "ok" if i % 5 else "error", 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id bigint, t string, user_id bigint, event_type string, value double").select("event_id", F.to_timestamp("t").alias("ts"), "user_id", "event_type", "value")
    df.write.parquet(f"{tmp_path}/in")
    stream = events.event_stream(spark, f"{tmp_path}/in", df.schema)
    q = events.windowed_counts(stream).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("w").agg(F.sum("n")).first()[0] == 40
    q = events.streaks(stream, ["error"], ["ok"]).writeStream.format("memory").queryName("s").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r[3])
    want = {}
    for u, kinds in by.items():
        run = best = 0
        for k in kinds:
            run = 0 if k == "error" else run + 1
            best = max(best, run)
        want[u] = (run, best)
    assert {r["user_id"]: (r["streak"], r["best"]) for r in spark.table("s").collect()} == want
    s = Store(spark, f"file://{tmp_path}/store")
    q = events.streaks(stream, ["error"], ["ok"], ttl="1 day").writeStream.format("memory").queryName("ttl").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r["user_id"]: (r["streak"], r["best"]) for r in spark.table("ttl").collect()} == want
    q = events.into_store(stream.select("event_id", "value"), s, "e", lambda old, new: new if old is None else old.union(new), f"{tmp_path}/cp")
    q.awaitTermination(120)
    assert s.read("e").count() == 40


def test_writers(spark, tmp_path):
    from tallyforge.sources import writers

    df = spark.createDataFrame([("甲", 1, None), ("乙|", 2, "x")], "`店` string, n int, t string").orderBy("n")
    writers.text_table(df, f"file://{tmp_path}/csv")
    raw = next(tmp_path.glob("csv/part-*.csv")).read_bytes()
    assert raw.startswith("﻿店,n,t".encode()) and readers.decoded(raw).splitlines()[1].startswith("甲,1")
    assert writers.markdown(df).splitlines()[2:] == ["| 甲 | 1 | -- |", "| 乙\\| | 2 | x |"]
    assert writers.written(df, f"file://{tmp_path}/p", "t", "x") == 2
    with pytest.raises(writers.NotWritten):
        writers.written(df, f"file://{tmp_path}/p", "t", "y")
    s = Store(spark, f"file://{tmp_path}/store")
    s.apply("b", {"f": df.drop("t")})
    assert writers.backup(s, f"file://{tmp_path}/backup")["f"]["rows"] == 2
    assert writers.raw_path("/r/", "b1", "t", "20260801", "s") == "/r/raw/b1/t_20260801_s"
