"""Reply alignment within a batch: junk, short, lone object, error and non-object items."""

import json

from casebook.plans import doubles
from casebook.operators import classify


def test_align_replies(spark):
    cases = spark.createDataFrame([(b, p, f"{b}-{p}") for b in range(5) for p in (1, 2)],
                                  "batch_id long, pos int, id string")
    good = {"category": "C", "sub_category": "S", "reasoning": "R", "resolution": "X"}
    replies = spark.createDataFrame([
        (0, json.dumps([good, good, good]), None),          # one extra item: dropped
        (1, "not json at all", None),                      # junk: every case errors
        (2, json.dumps([good]), None),                     # short: position 2 errors
        (3, json.dumps(good), None),                       # lone object answers position 1
        (4, json.dumps([{"error": "boom"}, "text"]), None),  # error item / non-object item
    ], classify.REPLY)
    out = {r.id: r for r in classify.align_replies(cases, replies, "id").collect()}
    assert not out["0-1"].failed and out["0-2"].category == "C"
    assert out["1-1"].failed and out["1-2"].reasoning == "{'error': 'Failed to parse response'}"
    assert not out["2-1"].failed and out["2-2"].failed
    assert not out["3-1"].failed and out["3-2"].failed
    assert out["4-1"].failed and out["4-1"].category == "Error" and out["4-1"].reasoning == "{'error': 'boom'}"
    assert out["4-2"].failed and out["4-2"].reasoning == "text"


def test_keyword_model_faults():
    m = doubles.KeywordModel("chat.example")
    p = "Case 1:\n<Conversation>the data?</Conversation>\n\nCase 2:\n<Conversation>x</Conversation>\n\n"
    assert m(7, p).startswith("Sorry")
    assert isinstance(json.loads(m(11, p)), dict)
    assert len(json.loads(m(5, p))) == 1
    r = json.loads(m(1, p))
    assert r[0] == {"category": "General", "sub_category": "Data", "reasoning": "keyword",
                    "resolution": "Customer Education"}


def test_prompt_batches_order(spark):
    df = spark.createDataFrame([("3", "c"), ("1", "a"), ("2", None), ("7", "z")], "id string, t string")
    cases = classify.case_batches(df, "id", "t", 5)
    p = {r.batch_id: r for r in classify.prompt_batches(cases).collect()}
    assert p[0].n_cases == 3 and p[1].n_cases == 1
    body = p[0].prompt
    assert body.index("<Conversation>a<") < body.index("<Conversation>None<") < body.index("<Conversation>c<")
    assert body.startswith("Please classify each") and "Case 3:" in body


def test_hash_batches_for_string_keys(spark):
    import uuid

    from pyspark.sql import functions as F

    ids = [(str(uuid.UUID(int=i * 7919 + 13)), f"t{i}") for i in range(203)]
    df = spark.createDataFrame(ids, "id string, t string")
    cases = classify.case_batches(df, "id", "t", 5, mode="hash")
    rows = cases.collect()
    assert len(rows) == 203 and len({r.id for r in rows}) == 203
    sizes = cases.groupBy("batch_id").agg(F.count("*").alias("n"), F.max("pos").alias("m"),
                                          F.countDistinct("pos").alias("d")).collect()
    assert all(r.n <= 5 and r.m == r.n == r.d for r in sizes)


def test_strict_replies_and_hex_ids(spark):
    from pyspark.sql import functions as F

    replies = [("b-0a", '[{"category": "A"}, {"category": "B"}]', 2), ("b-0b", '[{"category": "A"}] thanks', 1),
               ("b-0c", "{'category': 'A'}", 1), ("b-0d", '{"category": "A"} trailing', 1), ("b-0e", '{"error": null}', 1),
               ("b-0f", '[{"category": "A"}, {"category": "B"}, 7]', 2), ("b-10", '{"error": "x", "category": "A"}', 1)]
    cases = spark.createDataFrame([(f"{b}-{p}", b, p) for b, _, n in replies for p in range(1, n + 1)], "id string, batch_id string, pos int")
    got_replies = spark.createDataFrame([(b, r, None) for b, r, _ in replies], classify.REPLY)
    got = {r.id: r for r in classify.align_replies(cases, got_replies, "id").collect()}
    assert {i for i, r in got.items() if not r.failed} == {"b-0a-1", "b-0a-2", "b-0f-1", "b-0f-2"}
    assert got["b-0e-1"].reasoning == "{'error': None}" and got["b-0b-1"].reasoning == "{'error': 'Failed to parse response'}"
    assert [(r.batch_id, r.surplus) for r in classify.surplus_items(cases, got_replies).collect()] == [("b-0f", 1)]
    ids = spark.range(23).select(F.concat(F.substring(F.md5(F.col("id").cast("string")), 1, 8), F.lit("-"), F.col("id")).alias("id"), F.lit("x").alias("text"))
    batches = classify.case_batches(ids, "id", "text", 4, mode="hash").groupBy("batch_id").count()
    assert batches.agg(F.sum("count"), F.max("count")).first()[0] == 23 and batches.agg(F.max("count")).first()[0] <= 4
