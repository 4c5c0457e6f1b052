"""Row numbers, seek paging, chunked threads, keyed state, replays, co-located extract, variants."""

import datetime as dt
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from casebook.operators import classify, ordering, paging, reports, silver, threads, variants, writeback
from casebook.plans.common import CFG, Fixture
from casebook.streaming import jobs, state
from casebook.streaming.mergeonread import MergeOnReadTable
from casebook.streaming.snapshot import BucketedSnapshot

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbered_is_gapless_in_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["x", "y", None, "z" * 3]), k) for k in range(5000)]
    df = spark.createDataFrame(rows, "a string, b long").repartition(7)
    got = {(r.a, r.b): r.row_no for r in ordering.numbered(df, [F.col("a").desc_nulls_last(), F.col("b")], partitions=13).collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, [-ord(c) for c in r[0] or ""] + [0] * 4, r[1]))
    want.sort(key=lambda r: (r[0] is None, r[0] and tuple(-ord(c) for c in r[0]), r[1]) if r[0] is not None else (True, (), r[1]))
    assert [got[r] for r in want] == list(range(5000))
    assert ordering.numbered(df.where("false"), [F.col("b")]).count() == 0


def test_dense_batches_use_no_global_window(spark):
    n, size = 1003, 10
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("id"), F.col("id").cast("string").alias("t"))
    cases = classify.case_batches(df, "id", "t", size, mode="dense")
    assert "Window" not in plan_of(cases)
    rows = cases.orderBy("batch_id", "pos").collect()
    assert [r.id for r in rows] == sorted(r.id for r in rows) and {r.batch_id for r in rows} == set(range(-(-n // size)))
    assert [r.pos for r in rows] == [k % size + 1 for k in range(n)]


def test_seek_pages_read_their_files_only(spark, tmp_path):
    df = spark.range(2345).select((F.col("id") * 7919 % 2345).alias("k"), (F.col("id") % 10).alias("g"))
    pages = paging.write_pages(df.repartition(5), [F.col("g").desc(), F.col("k")], 50, f"file:{tmp_path}/p", slice_rows=500)
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (-r[1], r[0]))
    reads = set()
    for k in (0, 1, 20, 46):
        page = pages.page(spark, k)
        assert [tuple(r) for r in page.collect()] == want[50 * k : 50 * k + 50]
        files = [x for x in page.sparkSession.read.parquet(f"{pages.path}/rows/_slice={50 * k // 500}").inputFiles()]
        assert re.search(r"PartitionFilters: \[[^\]]*_slice", plan_of(page))
        reads.add(len(files))
    assert reads == {1}  # the same for the first page and the last
    assert pages.page(spark, 47).count() == 0
    index = pages.index(spark)
    assert index.agg(F.sum("rows"), F.count("*"), F.min("rows")).first()[:] == (2345, 47, 45)
    g, k = want[1234][1], want[1234][0]
    assert pages.page_of(spark, (F.col("first.g") > g) | ((F.col("first.g") == g) & (F.col("first.k") <= k))) == 1234 // 50


def test_seek_pages_in_a_bounded_number_of_slices(spark, tmp_path):
    df = spark.range(2345).select((F.col("id") * 7919 % 2345).alias("k"))
    pages = paging.write_pages(df.repartition(5), [F.col("k")], 10, f"file:{tmp_path}/p", slice_rows=20, most_slices=6)
    assert len([x for x in (tmp_path / "p" / "rows").iterdir() if x.name.startswith("_slice=")]) == 6
    for k in (0, 1, 39, 40, 100, 234):
        assert [r.k for r in pages.page(spark, k).collect()] == list(range(2345))[10 * k : 10 * k + 10]
    assert pages.page(spark, 235).count() == 0
    assert pages.index(spark).agg(F.sum("rows"), F.count("*"), F.min("rows")).first()[:] == (2345, 235, 5)


def test_hot_conversation_is_spread_and_in_order(spark):
    rng = random.Random(4)
    rows = [("hot", f"{k:06d}", f"m{k}", f"t{k}") for k in range(900)] + [(f"c{k % 60}", f"{k // 60:06d}", f"n{k}", f"u{k}") for k in range(600)]
    rows += [("hot", "000900", "z", " "), ("blank", "000000", "y", ""), ("hot", "000000", "m", "first")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conversationId string, timestamp string, id string, text string")
    chunks = threads.thread_chunks(df, "|", partitions=12).cache()
    hot = chunks.where("conversationId = 'hot'")
    assert hot.count() >= 4 and hot.agg(F.max("n_messages")).first()[0] < 400
    plain = df.where("trim(text) <> ''").groupBy("conversationId").agg(F.expr("listagg(text, '|') WITHIN GROUP (ORDER BY timestamp, id)").alias("t"))
    want = {tuple(r) for r in plain.collect()}
    assert {tuple(r) for r in threads.thread_texts(chunks, "|").collect()} == want
    assert [r.conversationId for r in threads.long_threads(chunks, 2000).collect()] == ["hot"]
    assert {r.conversationId for r in threads.thread_texts(chunks, "|", 2000).collect()} == {f"c{k}" for k in range(60)}


ARRIVALS = "k string, updated string, v long"


def fed(spark, path, runs, start, read):
    """Each run's rows as new files of one stream, which stops after each run and goes on from its checkpoint."""
    schema = spark.createDataFrame([], ARRIVALS).schema
    out = []
    for rows in runs:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        start(spark.readStream.schema(schema).parquet(f"{path}/in")).awaitTermination()
        out.append(sorted(tuple(r) for r in read().collect()))
    return out


RUNS = [
    [("a", "2024", 1), ("b", None, 2), ("c", "2024", 3), ("c", "2024", 4), ("d", "2020", 5), ("d", None, 6)],
    [("a", None, 7), ("b", "2019", 8), ("c", "2024", 0)],
    [("a", "1999", 9), ("e", None, 10)],
]
STATES = [
    [("a", "2024", 1), ("b", None, 2), ("c", "2024", 4), ("d", "2020", 5)],
    [("a", None, 7), ("b", "2019", 8), ("c", "2024", 0), ("d", "2020", 5)],
    [("a", "1999", 9), ("b", "2019", 8), ("c", "2024", 0), ("d", "2020", 5), ("e", None, 10)],
]


def test_keyed_state_is_last_write_wins(spark, tmp_path):
    path = f"file:{tmp_path}"
    got = fed(spark, path, RUNS, lambda s: state.start_last_write(s, "k", ["updated"], f"{path}/out", f"{path}/checkpoint"),
              lambda: state.read_last_write(spark, f"{path}/checkpoint"))
    assert got == STATES
    log = spark.read.parquet(f"{path}/out")
    assert log.count() == 4 + 3 + 2 and log.where("k = 'a'").count() == 3  # one row for each key and batch that changed it


def test_idle_keys_leave_the_state(spark, tmp_path):
    path = f"file:{tmp_path}"
    schema = spark.createDataFrame([], ARRIVALS).schema
    spark.createDataFrame(RUNS[0], schema).coalesce(1).write.parquet(f"{path}/in")
    src = spark.readStream.schema(schema).parquet(f"{path}/in")
    with pytest.raises(ValueError):
        state.start_last_write(src, "k", ["updated"], f"{path}/out", f"{path}/checkpoint", idle_ms=1)
    q = state.start_last_write(src, "k", ["updated"], f"{path}/out", f"{path}/checkpoint", idle_ms=1, every="1 second")
    try:
        deadline, left = time.monotonic() + 60, None
        while left != 0 and time.monotonic() < deadline:
            time.sleep(1)
            done = [p for p in q.recentProgress if p["stateOperators"] and p["batchId"] > 0]
            left = done[-1]["stateOperators"][0]["numRowsTotal"] if done else None
    finally:
        q.stop()
    assert state.read_last_write(spark, f"{path}/checkpoint").count() == 0
    assert sorted(tuple(r) for r in spark.read.parquet(f"{path}/out").collect()) == STATES[0]


@pytest.mark.parametrize("kind", [BucketedSnapshot, MergeOnReadTable])
def test_upsert_stream_is_last_write_wins(spark, tmp_path, kind):
    path = f"file:{tmp_path}"
    table = kind(f"{path}/table", "k", spark.createDataFrame([], ARRIVALS).schema, 4)
    got = fed(spark, path, RUNS, lambda s: jobs.start_upsert_stream(s, table, "updated", f"{path}/checkpoint"), lambda: table.read(spark))
    assert got == STATES


def test_replays_are_dropped_within_the_window(spark, tmp_path):
    path, base = f"file:{tmp_path}", dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], "id long, ts timestamp").schema

    def run(rows):
        spark.createDataFrame([(k, base + dt.timedelta(minutes=m)) for k, m in rows], schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        src = spark.readStream.schema(schema).parquet(f"{path}/in")
        once = state.replay_filter(src, "ts", ["id"], "10 minutes")
        q = once.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
        return state.late_rows(q)

    assert run([(1, 0), (2, 1), (1, 0), (3, 30)]) == 0
    assert run([(3, 30), (4, 31), (4, 31)]) == 0  # replays and a new record
    assert run([(5, 1), (2, 1), (6, 40)]) == 2  # both are older than the watermark allows: counted
    assert sorted(r.id for r in spark.read.schema(schema).parquet(f"{path}/out").collect()) == [1, 2, 3, 4, 6]


def test_extract_of_bucketed_tables_has_no_exchange(spark, tmp_path):
    f = Fixture(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [threads.write_bucketed(df, f"colocated_{n}", f"file:{tmp_path}/{n}", key, 4) for n, df, key in (
            ("t", silver.tickets_silver(f.tickets_raw(), CFG), "id"),
            ("m", silver.messages_silver(f.messages_raw(), CFG, drop_empty=False), "conversationId"),
            ("c", threads.classifications_view(f.classes()), "conversationId"))]
        out = threads.assemble_extract(*tables, CFG)
        assert plan_of(out).count("SortMergeJoin") == 2 and "Exchange" not in plan_of(out)
        want = threads.ticket_extract(f.tickets_raw(), f.messages_raw(), f.classes(), CFG)
        assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty() and out.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in "tmc":
            spark.sql(f"DROP TABLE IF EXISTS colocated_{n}")


def test_limited_extract_parses_its_own_tickets_only(spark):
    f = Fixture(spark, SF)
    whole = threads.ticket_extract(f.tickets_raw(), f.messages_raw(), f.classes(), CFG).orderBy("id").limit(17)
    some = threads.ticket_extract(f.tickets_raw(), f.messages_raw(), f.classes(), CFG, limit=17)
    assert [tuple(r) for r in some.collect()] == [tuple(r) for r in whole.collect()]
    every = threads.ticket_extract(f.tickets_raw(), f.messages_raw(), f.classes(), CFG, limit=5, unresolved_only=False)
    assert [r.id for r in every.collect()] == sorted(r.id for r in f.tickets_raw().collect())[:5]


def test_variants_and_dead_letters(spark, tmp_path):
    rows = [("1", '{"a":1,"b":[{"c":"x"},{"c":null}],"status":"open"}'), ("2", "{"), ("3", "[]"), ("4", None), ("5", "17"), ("6", "{}"), ("7", '{"a":"t"}'), ("8", '{"a":1} x'), ("9", "null"), ("10", '{"a":1}] ['), ("11", '{"a":1}} {'), ("12", '{"a":1}, {"b":2}'), ("13", "")]
    variants.store_documents(spark.createDataFrame(rows, "id string, data string"), f"file:{tmp_path}/d")
    docs = variants.documents(spark, f"file:{tmp_path}/d")
    assert sorted(r.id for r in docs.select("id").collect()) == ["1", "6", "7"]
    dead = {r.id: (r.data, r.reason) for r in variants.dead_letters(spark, f"file:{tmp_path}/d").collect()}
    assert dead == {"2": ("{", "not JSON"), "3": ("[]", "JSON array"), "5": ("17", "JSON bigint"), "8": ('{"a":1} x', "not JSON"), "9": ("null", "JSON void"),
                    "10": ('{"a":1}] [', "not JSON"), "11": ('{"a":1}} {', "not JSON"), "12": ('{"a":1}, {"b":2}', "not JSON"), "13": ("", "not JSON")}
    counts = {(r.path, r.type): r.n for r in variants.path_counts(docs).collect()}
    assert counts == {("$.a", "BIGINT"): 1, ("$.a", "STRING"): 1, ("$.b", "ARRAY"): 1, ("$.b[*]", "OBJECT"): 2, ("$.b[*].c", "STRING"): 1, ("$.b[*].c", "VOID"): 1, ("$.status", "STRING"): 1}
    schema = variants.common_schema(docs).first().schema
    assert "status: STRING" in schema and schema.startswith("OBJECT")
    got = {r.id: r.status for r in variants.document_fields(docs, spark.createDataFrame([], "id string, status string").schema).collect()}
    assert got == {"1": "open", "6": None, "7": None}


def test_drift(spark):
    def counts(*docs):
        return variants.path_counts(variants.with_variant(spark.createDataFrame([(str(k), json.dumps(d)) for k, d in enumerate(docs)], "id string, data string")))

    before = counts({"a": 1, "b": {"c": "x"}, "d": None}, {"a": 2})
    after = counts({"a": "one", "b": {"c": None, "e": True}}, {"a": 3, "f": None})
    got = {tuple(r) for r in variants.schema_drift(before, after).collect()}
    assert got == {("$.a", "retyped", "STRING", 1), ("$.b.e", "new", "BOOLEAN", 1), ("$.f", "new", "VOID", 1), ("$.d", "gone", "VOID", 1)}


def test_counts_of_the_written_pass(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3 == 0).alias("ok"))
    counts = {"processed": F.count(F.lit(1)), "successful": F.count_if(F.col("ok")), "failed": F.count_if(~F.col("ok"))}
    seen = silver.write_silver_counted(df, f"file:{tmp_path}/x", counts, buckets_by="id", n_files=3)
    assert seen == writeback.outcome_stats(spark.read.parquet(f"file:{tmp_path}/x")).first().asDict()


def test_add_counts_drops_empty_groups(spark):
    now = spark.createDataFrame([("a", 2), ("b", 1)], "g string, n long")
    delta = spark.createDataFrame([("b", -1), (None, 3)], "g string, n long")
    assert {tuple(r) for r in reports.add_counts(now, delta, ["g"]).collect()} == {("a", 2), (None, 3)}


def test_path_counts_in_one_pass(spark):
    texts = ['{"a":{},"b":[],"c":[1,{"d":null}],"e":{"f":{"g":{"h":{"i":1}}}},"":{"x":2.5}}', '{"a":{"z":[[]]},"b":"t","c":true}', "{}"]
    docs = spark.range(3).select(F.parse_json(F.element_at(F.array(*map(F.lit, texts)), (F.col("id") + 1).cast("int"))).alias("doc"))
    counts = variants.path_counts(docs)
    want = {("$.a", "OBJECT", 2), ("$.b", "ARRAY", 1), ("$.c", "ARRAY", 1), ("$.e", "OBJECT", 1), ("$.", "OBJECT", 1), ("$.b", "STRING", 1),
            ("$.c", "BOOLEAN", 1), ("$.c[*]", "BIGINT", 1), ("$.c[*]", "OBJECT", 1), ("$.c[*].d", "VOID", 1), ("$.e.f", "OBJECT", 1),
            ("$.e.f.g", "OBJECT", 1), ("$.e.f.g.h", "OBJECT", 1), ("$..x", "DECIMAL", 1), ("$.a.z", "ARRAY", 1), ("$.a.z[*]", "ARRAY", 1)}
    assert {tuple(r) for r in counts.collect()} == want
    assert plan_of(counts.where("n > 0")).count("Range (0, 3") == 1  # the documents are read once
    assert {tuple(r) for r in variants.path_counts(docs, 1).collect()} == {w for w in want if "." not in w[0][2:] and "[" not in w[0]} - {("$..x", "DECIMAL", 1)}
