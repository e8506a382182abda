"""Text files into typed tables, landed tables and catalog tables."""

import gc
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import golden
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from plateful import schemas
from plateful.functions import cleansing
from plateful.operators import audit, facts, keys
from plateful.plans import batch, customers, extensions, sales
from plateful.plans.staging import checkpointed, shared_folder
from plateful.sinks import tables as sinks
from plateful.sources import jdbc, tables as sources, text

ITEM_HEADER = ",".join(schemas.ORDER_ITEMS.names)


def item_line(line="l1", time="2024-03-01T12:34:56.789Z", user="u1", loyal="True", name="Soup",
              price="9.99", quantity="2"):
    return f"app,r1,{time},o1,{user},,{loyal},USD,{line},Food,{name},{price},{quantity}"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_date_dim(spark, tmp_path):
    path = write(tmp_path / "date_dim.csv", ",".join(schemas.DATE_DIM.names),
                 "01-01-2024,2024,1,1,Monday,False,True,New Year",
                 '06-01-2024,2024,1,,Saturday,TRUE,0,"  "',
                 "06-01-2024,,1,2,Dup,yes,no,Dup",
                 "07-01-2024,2024,,1,Sunday,1,x,",
                 "2024-01-08,2024,1,2,Monday,,,")
    loaded = text.load_text(spark, path, "date_dim_raw")
    assert loaded.schema.simpleString() == schemas.DATE_DIM.simpleString()
    assert golden.rows_of(loaded) == {
        (date(2024, 1, 1), 2024, 1, 1, "Monday", False, True, "New Year"),
        (date(2024, 1, 6), 2024, 1, None, "Saturday", True, False, None),
        (date(2024, 1, 7), 2024, 0, 1, "Sunday", True, False, None)}


def test_order_items(spark, tmp_path):
    path = write(tmp_path / "items.csv", ITEM_HEADER,
                 item_line(name='"Soup, ""hot"""'),
                 item_line(line="l2", time="bad", user="", loyal="x", price="", quantity="2.6"),
                 item_line(line="l1", name="again"),
                 item_line(line="l3", loyal="", price="abc", quantity=""))
    loaded = text.load_text(spark, path, "order_items_raw")
    assert loaded.schema.simpleString() == schemas.ORDER_ITEMS.simpleString()
    rows = {r.lineitem_id: r for r in loaded.collect()}
    assert set(rows) == {"l1", "l2", "l3"}
    assert rows["l1"].item_name == 'Soup, "hot"'
    assert rows["l1"].creation_time_utc == datetime(2024, 3, 1, 12, 34, 56)
    assert rows["l1"].item_price == Decimal("9.99") and rows["l1"].is_loyalty
    assert (rows["l2"].creation_time_utc, rows["l2"].user_id, rows["l2"].is_loyalty) == (None, "", False)
    assert (rows["l2"].item_price, rows["l2"].item_quantity) == (Decimal("0.00"), 3)
    assert (rows["l3"].item_price, rows["l3"].item_quantity, rows["l3"].is_loyalty) == (Decimal("0.00"), 0, False)
    assert rows["l1"].printed_card_number == ""

    strict = {r.lineitem_id: r for r in text.load_text(spark, path, "order_items_raw", strict=True).collect()}
    assert strict["l2"].item_price is None and strict["l3"].item_quantity is None

    report = audit.audit_text("order_items_raw", text.read_text(spark, path, "order_items_raw")).first()
    assert tuple(report) == ("order_items_raw", 4, 3, 0, 4)


def test_options_follow_the_column_order_and_get_an_id(spark, tmp_path):
    path = write(tmp_path / "options.csv", "a,b,c,d,e,f", "o1,l1,Size,Large,1.50,1", "o1,l1,Promo,Ten off,-10.00,1")
    rows = text.load_text(spark, path, "order_item_options_raw").orderBy("id").collect()
    assert [(r.order_id, r.option_name, r.option_price) for r in rows] == [
        ("o1", "Large", Decimal("1.50")), ("o1", "Ten off", Decimal("-10.00"))]
    assert [r.id for r in rows] == [1, 2]


def test_first_row_wins_over_many_splits_and_files(spark, tmp_path):
    """Small splits are packed by size, so only the file position gives the file order."""
    for part in ("a", "b"):
        write(tmp_path / f"{part}.csv", ITEM_HEADER,
              *[item_line(line=f"l{i % 50}", name=f"{part}{i}") for i in range(400)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = text.load_text(spark, str(tmp_path / "*.csv"), "order_items_raw").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.lineitem_id: r.item_name for r in rows} == {f"l{i}": f"a{i}" for i in range(50)}


def test_hot_key_is_trimmed_before_the_shuffle(spark, tmp_path):
    path = write(tmp_path / "items.csv", ITEM_HEADER, item_line())
    plan = text.load_text(spark, path, "order_items_raw")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


@pytest.mark.parametrize("given, want", [
    ("True", True), ("YES", True), ("1", True), ("TRUE ", False), ("0", False), ("", False), (None, False), ("on", False)])
def test_parse_boolean(spark, given, want):
    assert spark.range(1).select(cleansing.parse_boolean(F.lit(given).cast("string"))).first()[0] is want


@pytest.mark.parametrize("given, want", [
    ("2024-03-01T12:34:56.789Z", datetime(2024, 3, 1, 12, 34, 56)),
    ("2024-03-10T02:30:00Z", datetime(2024, 3, 10, 2, 30)),
    ("2024-02-30T00:00:00", None), ("2024-03-01", None), ("2024-03-01T25:00:00", None), ("", None), (None, None)])
def test_parse_timestamp_does_not_depend_on_the_session_zone(spark, given, want):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert spark.range(1).select(cleansing.parse_timestamp(F.lit(given).cast("string"))).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_ids_are_dense_in_row_order(spark):
    rows = keys.with_dense_id(spark.range(1000).withColumnRenamed("id", "x").repartition(7), "id", 51)
    assert sorted(r.id for r in rows.collect()) == list(range(51, 1051))


def test_positions_in_groups_are_dense_and_ordered(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 7 < 4, 0).when(F.col("id") % 7 < 6, F.col("id") % 5).alias("g"),
                                    (F.col("id") % 97).alias("v")).repartition(5)
    groups = {}
    for r in keys.with_positions(rows, ["g"], ["v"]).collect():
        groups.setdefault(r.g, []).append((r.position, r.v))
    for group in groups.values():
        group.sort()
        assert [p for p, _ in group] == list(range(len(group)))
        assert [v for _, v in group] == sorted(v for _, v in group)


def test_numbering_holds_for_very_many_tasks(spark):
    """The place of a row has its task above bit 33; task 70,000 of one batch must not meet another batch."""
    places = [(task << 33) + row for task in (0, 1, 65_535, 65_536, 70_000, 800_000) for row in range(3)]
    rows = keys.numbered(spark.createDataFrame([(p,) for p in places], "_id long").repartition(3), [], "n")
    assert {r["_id"]: r["n"] for r in rows.collect()} == {p: i for i, p in enumerate(places)}


def test_text_to_metrics_end_to_end_twice(spark, tmp_path):
    paths = {
        "order_items_raw": write(tmp_path / "items.csv", ITEM_HEADER, *[
            f"app,{r},{t.isoformat() + '.000Z'},{o},{u or ''},,{loyal},USD,{line},{c or ''},item,{p or ''},{q}"
            for u, o, t, line, p, q, loyal, c, r in golden.ITEMS]),
        "order_item_options_raw": write(tmp_path / "options.csv", "order_id,lineitem_id,group,name,price,quantity", *[
            f"{o},{line},group,option,{p},{q}" for o, line, p, q in golden.OPTIONS]),
        "date_dim_raw": write(tmp_path / "dates.csv", ",".join(schemas.DATE_DIM.names),
                              "01-01-2024,2024,1,1,Monday,False,True,New Year"),
    }
    raw, out = str(tmp_path / "raw"), str(tmp_path / "metrics")
    results = []
    for _ in range(2):
        landed = batch.land_text(spark, paths, raw)
        assert {t: x[1:] for t, x in landed.items()} == {
            "order_items_raw": (8, 8, 0, 1, 0), "order_item_options_raw": (5, 5, 0, 0, 0), "date_dim_raw": (1, 1, 0, 0, 0)}
        assert sources.read_raw(spark, raw, "date_dim_raw").count() == 1
        written = batch.run_metrics(spark, raw, out)
        assert set(written) == set(schemas.METRICS)
        results.append({name: golden.rows_of(sources.read_metric(spark, out, name)) for name in written})
        for name in written:
            want = T._parse_datatype_string(schemas.METRICS[name])
            assert [(f.name, f.dataType) for f in sources.read_metric(spark, out, name).schema] == \
                [(f.name, f.dataType) for f in want]
    assert results[0] == results[1]
    shown = batch.run_views(spark, out, str(tmp_path / "views"))
    assert set(shown) == set(batch.VIEWS)
    assert golden.rows_of(spark.read.parquet(shown["segment_counts"])) == {("Regular Customer", 4), ("VIP", 1)}
    d = golden.d
    # Blank and missing users are both blank in text, a blank price is 0. Five customers
    # rank at 0, 1/4, 2/4, 3/4 and 1, so the second is beyond the top fifth.
    assert results[0]["customer_lifetime_value"] == {
        ("u1", d("36.00"), "High CLV"), ("u2", d("25.00"), "Medium CLV"), ("", d("14.50"), "Medium CLV"),
        ("u3", d("7.00"), "Medium CLV"), ("u4", d("0.00"), "Low CLV")}
    assert results[0]["location_performance"] == {("r1", d("55.00"), 2, d("18.33")), ("r2", d("20.00"), 5, d("4.00"))}


def test_sales_trends_are_split_into_folders_that_filters_prune(spark, tmp_path):
    items = golden.items(spark)
    base = str(tmp_path)
    sinks.land_tables({"sales_trends": batch.metric_tables(items, golden.options(spark))["sales_trends"]}, base)
    folders = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.glob("sales_trends/*/*"))
    assert folders == ["sales_trends/sales_year=2023/sales_month=11", "sales_trends/sales_year=2024/sales_month=1"]
    november = sources.read_metric(spark, base, "sales_trends").filter("sales_month = 11")
    assert november.count() == 2
    assert "PartitionFilters: [isnotnull(sales_month" in november._jdf.queryExecution().toString()


def test_daily_values_replace_only_their_day(spark, tmp_path):
    items, options = golden.items(spark), golden.options(spark)
    for day in ("2023-11-18", "2024-01-02", "2024-01-02"):
        path = sinks.write_snapshot(extensions.clv_as_of(items, options, day), str(tmp_path), "clv_by_day")
    rows = {(str(r.as_of_date), r.user_id, r.customer_lifetime_value) for r in spark.read.parquet(path).collect()}
    d = golden.d
    assert rows == {("2023-11-18", "u2", d("25.00")), ("2023-11-18", "u3", d("7.00")),
                    *{("2024-01-02", user, value) for user, value, _ in golden.CLV}}


def test_scans_read_only_what_they_need(spark, tmp_path, capsys):
    base = str(tmp_path)
    sinks.land_tables({"order_item_options_raw": golden.options(spark), "order_items_raw": golden.items(spark)}, base)
    options = sources.read_raw(spark, base, "order_item_options_raw")
    items = sources.read_raw(spark, base, "order_items_raw")

    def plan(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    discounted = plan(facts.discounted_orders(options))
    assert "LessThan(option_price,0.00)" in discounted
    assert "ReadSchema: struct<order_id:string,option_price:decimal(10,2)>" in discounted
    assert ("ReadSchema: struct<restaurant_id:string,order_id:string,item_price:decimal(10,2),item_quantity:int>"
            in plan(sales.location_performance(items)))
    as_of = plan(customers.customer_values(items.filter("creation_time_utc < timestamp_ntz'2024-01-02'"), options))
    assert "LessThan(creation_time_utc,2024-01-02T00:00)" in as_of


def test_a_metrics_run_reads_the_items_twice(spark, tmp_path):
    base = str(tmp_path)
    sinks.land_tables({"order_item_options_raw": golden.options(spark), "order_items_raw": golden.items(spark)}, base)
    tables = batch.metric_tables(sources.read_raw(spark, base, "order_items_raw"),
                                 sources.read_raw(spark, base, "order_item_options_raw"), stage=checkpointed)
    for name, table in tables.items():      # lifetime value and the facts were computed when they were written
        assert "order_items_raw" not in table._jdf.queryExecution().executedPlan().toString(), name


def test_items_land_in_day_folders_that_a_day_prunes(spark, tmp_path):
    base = str(tmp_path)
    sinks.land_tables({"order_items_raw": golden.items(spark)}, base)
    day = sources.read_raw(spark, base, "order_items_raw", day="2024-01-01")
    assert {r.lineitem_id for r in day.collect()} == {"l1", "l2", "l7", "l8"}
    assert "PartitionFilters: [isnotnull(creation_day" in day._jdf.queryExecution().toString()
    assert sources.read_raw(spark, base, "order_items_raw").columns == schemas.ORDER_ITEMS.names


def test_audit_counts_unreadable_but_not_blank_years_and_weeks(spark, tmp_path):
    header = ",".join(schemas.DATE_DIM.names)
    path = write(tmp_path / "dates.csv", header, "01-01-2024,20x4,1,wk,Monday,False,True,",
                 "02-01-2024,,1,,Tuesday,False,False,", "03-01-2024,2024,x,1,Wednesday,False,False,", "bad,2024,1,1,,,,")
    row = audit.audit_text("date_dim_raw", text.read_text(spark, path, "date_dim_raw")).first()
    assert tuple(row) == ("date_dim_raw", 4, 3, 1, 4)


def test_missing_tables_raise(spark, tmp_path):
    with pytest.raises(KeyError):
        sources.read_metric(spark, str(tmp_path), "nothing")
    with pytest.raises(AnalysisException):
        sources.read_metric(spark, str(tmp_path), "sales_trends")


def test_catalog_tables_reload_and_bucketed_joins_do_not_shuffle(spark):
    sinks.create_database(spark, "plateful_raw")
    for name, frame in (("order_items_raw", golden.items(spark)), ("order_item_options_raw", golden.options(spark))):
        for _ in range(2):
            sinks.create_raw_table(spark, "plateful_raw", name, bucket_by="lineitem_id", buckets=4)
            sinks.reload_raw_table(frame, "plateful_raw", name)
    items, options = spark.table("plateful_raw.order_items_raw"), spark.table("plateful_raw.order_item_options_raw")
    assert (items.count(), options.count()) == (8, 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = facts.customer_spend(items, options)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1  # only the final sum per user
    assert golden.rows_of(customers.customer_lifetime_value(items, options)) == golden.CLV


def test_written_tables_live_in_the_session_checkpoint_folder(spark):
    kept = checkpointed(spark.range(5))
    assert kept.count() == 5 and shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) in spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("master, works", [("local", True), ("local[4]", True), ("local-cluster[2,1,512]", False), ("yarn", False)])
def test_a_cluster_needs_a_shared_folder(master, works):
    class Session:
        conf = {"spark.sql.warehouse.dir": "/w/"}
        sparkContext = type("Context", (), {"master": master})

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    Session.conf = Conf(Session.conf)
    if works:
        assert shared_folder(Session) == "/w/_checkpoints"
    else:
        with pytest.raises(ValueError):
            shared_folder(Session)


def test_written_tables_go_when_they_are_no_longer_referenced(spark):
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    segments = customers.customer_segments(golden.items(spark))
    assert segments.count() > 0 and {p.name for p in folder.iterdir()} - before
    del segments
    for _ in range(40):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.25)
        if not {p.name for p in folder.iterdir()} - before:
            return
    raise AssertionError("the checkpoint folder still has the table")


def test_copied_tables_get_the_declared_types(spark):
    narrow = golden.options(spark).withColumn("id", F.col("id").cast("int")).select(
        *reversed(schemas.ORDER_ITEM_OPTIONS.names))
    assert batch.declared(narrow, "order_item_options_raw").schema.simpleString() == \
        schemas.ORDER_ITEM_OPTIONS.simpleString()


def test_jdbc_reads_are_split():
    assert jdbc.jdbc_options("jdbc:mysql://h/d", "t", {})["useCursorFetch"] == "true"
    assert "useCursorFetch" not in jdbc.jdbc_options("jdbc:postgresql://h/d", "t", {})
    options = jdbc.jdbc_options("jdbc:x", "order_items_raw", {"user": "u"}, column="creation_time_utc",
                                lower=datetime(2024, 1, 1), upper=datetime(2024, 2, 1), partitions=8)
    assert options["partitionColumn"] == "creation_time_utc" and options["numPartitions"] == "8"
    assert options["lowerBound"] == "2024-01-01 00:00:00" and options["preferTimestampNTZ"] == "true"
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:x", "date_dim_raw", {})
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", {}, column="id", lower=1, upper=2)


@pytest.mark.parametrize("partitions", [1, 2, 5, 40])
def test_text_keys_are_split_evenly(partitions):
    """Every row in exactly one range: quotes, backslashes, NULL, and a value with very many rows."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (lineitem_id VARCHAR)")
    values = [f"l{i:03}" for i in range(60)] + ["it's", "a\\b", "", "Ä"] + ["hot"] * 40 + [None] * 5
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    rows = con.execute(f"SELECT tile, cut FROM {jdbc.cut_query('t', 'lineitem_id', partitions)} ORDER BY tile").fetchall()
    predicates = jdbc.key_predicates("lineitem_id", [c for _, c in rows])
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(counts) == len(values) and len(predicates) <= partitions
    together = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
    assert con.execute(f"SELECT DISTINCT {together} FROM t").fetchall() == [(1,)]
    assert max(counts) <= -(-104 // partitions) + 40 + 5


def test_text_keys_that_escape_and_tables_without_keys():
    assert jdbc.key_predicates("k", []) == jdbc.key_predicates("k", ["a"]) == jdbc.key_predicates("k", ["a", "a"]) == ["1 = 1"]
    assert jdbc.key_predicates("k", ["a", "b\\'c"], True) == ["k < 'b\\\\''c' or k is null", "k >= 'b\\\\''c'"]


def test_items_are_read_by_key_ranges(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(jdbc, "key_ranges", lambda session, url, table, properties, column, n: asked.setdefault((table, column, n), ["1 = 1"]))

    class Reader:
        def jdbc(self, url, table, **how):
            return (url, table, how["predicates"])

    class Session:
        read = Reader()

    found = jdbc.read_jdbc(Session(), "jdbc:x", "order_items_raw", {}, partitions=8)
    assert found == ("jdbc:x", "order_items_raw", ["1 = 1"]) and [*asked] == [("order_items_raw", "lineitem_id", 8)]


def test_jdbc_reads_take_predicates_or_ranges(spark, monkeypatch):
    seen = {}

    def read(session, url, table, properties, *, partitions, predicates):
        seen[table] = (partitions, predicates)
        return {"order_items_raw": golden.items, "order_item_options_raw": golden.options}[table](session)

    monkeypatch.setattr(batch, "read_jdbc", read)
    monkeypatch.setattr(batch, "land_tables", lambda tables, base: dict.fromkeys(tables, base))
    monkeypatch.setattr(batch, "read_raw", lambda session, base, table: read(session, "", table, {}, partitions=8, predicates=seen[table][1]))
    tables = ("order_items_raw", "order_item_options_raw")
    landed = batch.land_jdbc(spark, "jdbc:x", {}, "raw", partitions=8, tables=tables, predicates={"order_items_raw": ["a", "b"]})
    assert seen == {"order_items_raw": (8, ["a", "b"]), "order_item_options_raw": (8, None)}
    assert landed["order_items_raw"] == ("raw", 8, 8, 0, 0, 0)
    with pytest.raises(TypeError):
        batch.land_jdbc(spark, "jdbc:x", {}, "raw")


BAD_LINES = ["app,r1,2024-03-01T12:00:00,o1,u1", item_line("l7") + ",more,fields", item_line("l1", name="again") + ",x"]


def test_malformed_lines_are_counted_and_kept(spark, tmp_path):
    """Landed as before, padded or cut, and kept as they came; also those that a first row or a missing key hides."""
    path = write(tmp_path / "items.csv", ITEM_HEADER, item_line("l1"), *BAD_LINES, item_line("l2", price="x"))
    dates = write(tmp_path / "dates.csv", ",".join(schemas.DATE_DIM.names), "bad", "01-01-2024,2024,1,1,Monday,False,True,x,y")
    options = write(tmp_path / "options.csv", "a,b,c,d,e,f", "o1,l1", "o1,l1,Size,Large,1.50,1")
    raw = str(tmp_path / "raw")
    paths = {"order_items_raw": path, "date_dim_raw": dates, "order_item_options_raw": options}
    for _ in range(2):
        landed = batch.land_text(spark, paths, raw)
        for table, (place, *counts) in landed.items():
            text_rows = text.read_text(spark, paths[table], table)
            assert tuple(counts[:-1]) == tuple(audit.audit_text(table, text_rows).first()[1:])
            assert golden.rows_of(sources.read_raw(spark, raw, table)) == golden.rows_of(text.load_text(spark, paths[table], table))
        assert {t: x.malformed_rows for t, x in landed.items()} == {"order_items_raw": 3, "date_dim_raw": 2, "order_item_options_raw": 1}
        assert sorted(r.line for r in batch.read_rejects(spark, raw, "order_items_raw").collect()) == sorted(BAD_LINES)
        assert batch.read_rejects(spark, raw, "date_dim_raw").count() == 2
        assert [r.line for r in batch.read_rejects(spark, raw, "order_item_options_raw").collect()] == ["o1,l1"]
    write(tmp_path / "items.csv", ITEM_HEADER, item_line("l1"))
    assert batch.land_text(spark, {"order_items_raw": path}, raw)["order_items_raw"].malformed_rows == 0
    assert batch.read_rejects(spark, raw, "order_items_raw").count() == 0
    assert not [p for p in (tmp_path / "raw").rglob("_staged/*")] + [p for p in (tmp_path / "raw").rglob("_replaced/*")]


def test_a_load_reads_the_text_once(spark, tmp_path):
    path = write(tmp_path / "items.csv", ITEM_HEADER, item_line("l1"), BAD_LINES[0])
    rows = batch.with_rejects(audit.with_checks("order_items_raw", text.read_text(spark, path, "order_items_raw", malformed=True)),
                              "order_items_raw", False)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan


def test_an_empty_file_gives_an_empty_table(spark, tmp_path):
    path, raw = write(tmp_path / "items.csv", ITEM_HEADER), str(tmp_path / "raw")
    assert batch.land_text(spark, {"order_items_raw": path}, raw)["order_items_raw"][1:] == (0, 0, 0, 0, 0)
    assert sources.read_raw(spark, raw, "order_items_raw").count() == 0


def failing(df):
    """``df`` with a row that cannot be computed."""
    broken = F.udf(lambda x: 1 // 0, "string")
    return df.withColumn(df.columns[0], F.when(F.rand() >= 0, broken(F.lit(1))).cast(df.schema[0].dataType))


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path):
    base, items = str(tmp_path), golden.items(spark)
    sinks.write_table(items, base, "order_items_raw")
    with pytest.raises(Exception):
        sinks.write_table(failing(items), base, "order_items_raw")
    assert golden.rows_of(sources.read_raw(spark, base, "order_items_raw")) == golden.rows_of(items)
    assert not list((tmp_path / "_staged").iterdir())
    half = sources.read_raw(spark, base, "order_items_raw").filter("item_quantity = 1")
    sinks.write_table(half, base, "order_items_raw")                 # reads what it replaces
    assert sources.read_raw(spark, base, "order_items_raw").count() == len([r for r in golden.ITEMS if r[5] == 1])


def test_a_failed_move_puts_the_old_folder_back(spark, tmp_path):
    base = str(tmp_path)
    sinks.write_table(spark.range(3), base, "t")
    with pytest.raises(Exception):
        sinks.publish_folder(spark, f"{base}/nowhere", base, "t")
    assert spark.read.parquet(f"{base}/t").count() == 3


@pytest.mark.parametrize("bucket_by", [None, "lineitem_id"])
def test_a_reload_that_fails_leaves_the_catalog_table(spark, bucket_by):
    database, name = f"plateful_reload_{bucket_by}".lower(), "order_items_raw"
    sinks.create_database(spark, database)
    sinks.create_raw_table(spark, database, name, bucket_by=bucket_by, buckets=4)
    items, table = golden.items(spark), f"{database}.{name}"
    places = [sinks.table_place(spark, database, name)]
    for rows in (items, items.filter("item_quantity = 1"), items):
        sinks.reload_raw_table(rows, database, name)
        places.append(sinks.table_place(spark, database, name))
        assert golden.rows_of(spark.table(table)) == golden.rows_of(rows)
    with pytest.raises(Exception):
        sinks.reload_raw_table(failing(items), database, name)
    assert golden.rows_of(spark.table(table)) == golden.rows_of(items)
    assert [t.tableName for t in spark.sql(f"SHOW TABLES IN {database}").collect()] == [name]
    exists = [Path(p.removeprefix("file:")).exists() for p in places]
    assert len(set(places)) == 4 and exists == [False, False, True, True]
    if bucket_by:
        assert "Bucketed: true" in spark.table(table).groupBy("lineitem_id").count()._jdf.queryExecution().executedPlan().toString()
