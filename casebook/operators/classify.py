"""Batch classification through an injected model.

Shape of the job:

1. ``case_batches``: number the cases in bounded batches (``batch_id`` from
   the key range, ``pos`` inside the batch) - no global window.
2. ``prompt_batches``: one prompt text per batch (ordered ``listagg``; each
   group holds at most ``size`` cases, so no group is unbounded).
3. ``classify``: ``mapInPandas`` calls the model once per batch and keeps the
   raw reply. Persist that output before parsing so a recomputed stage does
   not call the model again (``checkpoint`` to the shared folder).
4. ``align_replies``: parse the reply natively and align results to cases by
   ``(batch_id, pos)``; a junk or short reply yields error rows for exactly
   the cases it did not answer, never a shift of later cases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from casebook import schemas
from casebook.config import ERROR_LABEL, NONE_TEXT, PROMPT_FOOTER, PROMPT_HEADER, SINGLE_PROMPT
from casebook.operators import ordering
from casebook.session import checkpoint_dir

Model = Callable[[str, str], str]  # (batch_id as text, prompt) -> reply text; may raise

REPLY = StructType([StructField("batch_id", StringType()), StructField("reply", StringType()),
                    StructField("call_error", StringType())])


def case_batches(df: DataFrame, key: str, text: str, size: int, mode: str = "range") -> DataFrame:
    """``(key, text, batch_id, pos)``: cases in batches of at most ``size``.

    ``mode="range"`` (keys that are integers): ``batch_id = key div size`` and 1-based
    positions by key; the window is partitioned by ``batch_id``, so a window
    group holds at most ``size`` rows.

    ``mode="hash"`` (any key, e.g. UUID strings): one count sizes
    ``ceil(n / size)`` hash buckets of about ``size`` keys each; inside a
    bucket keys are numbered in order and cut into batches of ``size``. The
    window is partitioned by bucket, so its groups stay small whatever the
    table size, and no global ordering is needed.

    ``mode="dense"`` (any key): the cases in key order, cut into exactly
    ``ceil(n / size)`` batches, all full but the last. Row numbers come from
    ``ordering.numbered``; no window is used. The keys should be unique
    (equal keys are ordered by their texts)."""
    from pyspark.sql import Window

    if mode == "dense":
        b = ordering.numbered(df.select(F.col(key), F.col(text).alias("text")), [F.col(key), F.col("text")])
        return b.select(key, "text", F.floor(F.col("row_no") / size).alias("batch_id"),
                        (F.col("row_no") % size + 1).cast("int").alias("pos"))
    if mode == "range":
        k = F.col(key).cast("long")
        b = df.select(F.col(key), F.col(text).alias("text"), F.floor(k / size).alias("batch_id"))
        return b.withColumn("pos", F.row_number().over(Window.partitionBy("batch_id").orderBy(k)))
    n = df.count()
    buckets = max(1, -(-n // size))
    stride = 1 << 24  # batches per bucket never reach this (a bucket holds ~size keys)
    h = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))
    b = df.select(F.col(key), F.col(text).alias("text"), h.alias("_bucket"))
    pos0 = F.row_number().over(Window.partitionBy("_bucket").orderBy(F.col(key))) - 1
    b = b.withColumn("_p", pos0)
    return b.select(key, "text", (F.col("_bucket") * stride + F.floor(F.col("_p") / size)).alias("batch_id"),
                    (F.col("_p") % size + 1).cast("int").alias("pos"))


def case_text(pos: Column, text: Column) -> Column:
    """One numbered case of the batch prompt (a missing text prints as 'None')."""
    return F.concat(F.lit("Case "), pos.cast("string"), F.lit(":\n<Conversation>"),
                    F.coalesce(text, F.lit(NONE_TEXT)), F.lit("</Conversation>\n\n"))


def prompt_batches(cases: DataFrame) -> DataFrame:
    """``(batch_id, n_cases, prompt)``: header, the cases in position order, footer."""
    body = F.expr("listagg(_case, '') WITHIN GROUP (ORDER BY pos)")
    g = cases.withColumn("_case", case_text(F.col("pos"), F.col("text"))).groupBy("batch_id") \
        .agg(F.count(F.lit(1)).alias("n_cases"), body.alias("_body"))
    return g.select("batch_id", "n_cases",
                    F.concat(F.lit(PROMPT_HEADER), F.col("_body"), F.lit(PROMPT_FOOTER)).alias("prompt"))


def single_prompt(text: Column) -> Column:
    pre, post = SINGLE_PROMPT.split("{text}")
    return F.concat(F.lit(pre), F.coalesce(text, F.lit(NONE_TEXT)), F.lit(post))


def call_model(model: Model) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies, errors = [], []
            for b, p in zip(pdf["batch_id"], pdf["prompt"]):
                try:
                    replies.append(model(str(b), p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    replies.append(None)
                    errors.append(str(e) or type(e).__name__)
            yield pd.DataFrame({"batch_id": pdf["batch_id"].astype(str), "reply": replies,
                                "call_error": errors})

    return run


def classify(prompts: DataFrame, model: Model, partitions: int | None = None, persist: bool = True) -> DataFrame:
    """Raw model reply per batch: ``(batch_id, reply, call_error)``.

    ``partitions`` caps concurrent model calls. With ``persist`` (default) the
    replies are checkpointed to the shared ``spark.checkpoint.dir`` right after
    the calls: the model runs once per batch, later reads (parsing, error
    detection) see the same replies, and a lost executor does not trigger new
    (possibly different, paid) model calls."""
    src = prompts.select(F.col("batch_id").cast("string").alias("batch_id"), "prompt")
    if partitions:
        src = src.repartition(partitions, "batch_id")
    out = src.mapInPandas(call_model(model), REPLY)
    if persist:
        checkpoint_dir(out.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def _error_text(msg: Column) -> Column:
    """The stored reasoning of a failed case: the failure record as printed by Python."""
    return F.concat(F.lit("{'error': '"), msg, F.lit("'}"))


def _items(reply: str) -> Column:
    """Items of a reply: the elements of a JSON array; a lone JSON object or
    scalar counts as one item (the answer to position 1); NULL when the reply
    as a whole is not strict JSON (trailing text, single quotes)."""
    strict = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_c"}
    wrapped = F.from_json(F.concat(F.lit('{"v":'), F.col(reply), F.lit("}")), "v string, _c string", strict)
    valid = F.try_parse_json(F.col(reply)).isNotNull() & wrapped["_c"].isNull()
    first = F.substring(F.trim(F.regexp_replace(reply, r"^\s+", "")), 1, 1)
    items = (F.when(first == "[", F.from_json(reply, ArrayType(StringType()), strict))
             .when(first == "{", F.array(F.col(reply))).otherwise(F.array(wrapped["v"])))
    return F.when(valid, items)


def align_replies(cases: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """One result per case: ``(key, category, sub_category, reasoning, resolution, failed)``.

    A case is an error row (category/sub-category/resolution 'Error' and the
    failure as reasoning) when the call raised, the reply was not strict JSON, no
    item answers its position, the item is not an object, or the item carries
    an ``error`` key, whatever its value. The reasoning is the failure record as Python prints it
    (``{'error': 'msg'}``); other error objects keep their JSON text. Extra
    items are dropped; ``surplus_items`` counts them."""
    # One row a batch meets the cases; a case takes its item by position. Each reply is parsed once.
    r = replies.select("batch_id", "call_error", F.col("reply").isNotNull().alias("answered"), _items("reply").alias("items"))
    cases = cases.withColumn("batch_id", F.col("batch_id").cast("string"))
    j = cases.join(r, "batch_id", "left").withColumn("item", F.get("items", F.col("pos") - 1))
    j = j.withColumn("junk", F.col("answered") & F.col("items").isNull()).drop("items") \
        .withColumn("obj", F.from_json("item", schemas.REPLY_ITEM)).withColumn("keys", F.json_object_keys("item"))
    has_error = F.array_contains("keys", "error")
    alone = F.size("keys") == 1
    reason = (F.when(F.col("call_error").isNotNull(), _error_text(F.col("call_error")))
              .when(F.col("junk"), _error_text(F.lit("Failed to parse response")))
              .when(F.col("item").isNull(), _error_text(F.lit("No result for case")))
              .when(F.col("keys").isNull(), F.col("item"))
              .when(has_error & alone & F.col("obj.error").isNull(), F.lit("{'error': None}"))
              .when(has_error & alone & ~F.col("obj.error").contains("'"), _error_text(F.col("obj.error")))
              .when(has_error, F.col("item")))
    failed = reason.isNotNull()
    err = F.lit(ERROR_LABEL)
    return j.select(
        F.col(key),
        F.when(failed, err).otherwise(F.col("obj.category")).alias("category"),
        F.when(failed, err).otherwise(F.col("obj.sub_category")).alias("sub_category"),
        F.when(failed, reason).otherwise(F.col("obj.reasoning")).alias("reasoning"),
        F.when(failed, err).otherwise(F.col("obj.resolution")).alias("resolution"),
        failed.alias("failed"),
    )


def surplus_items(cases: DataFrame, replies: DataFrame) -> DataFrame:
    """``(batch_id, surplus)`` of the batches whose reply has more items than cases."""
    n = cases.groupBy(F.col("batch_id").cast("string").alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))
    got = replies.where(F.col("reply").isNotNull()).select("batch_id", F.size(_items("reply")).alias("got"))
    return got.join(n, "batch_id").where("got > n").select("batch_id", (F.col("got") - F.col("n")).alias("surplus"))


def single_results(cases: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """Batch-size-1 variant: the parsed object, or nothing when the call
    failed or the reply is not a JSON object (the case stays unclassified)."""
    obj = F.from_json("reply", schemas.REPLY_ITEM)
    ok = replies.where(_items("reply").isNotNull() & F.json_object_keys("reply").isNotNull()) \
        .select("batch_id", obj.alias("obj"))
    cases = cases.withColumn("batch_id", F.col("batch_id").cast("string"))
    return cases.join(ok, "batch_id", "inner").select(F.col(key), "obj.category", "obj.sub_category",
                                                      "obj.reasoning", "obj.resolution")


def taxonomy_table(spark, taxonomy: dict[str, list[str]]) -> DataFrame:
    rows = [(c, s) for c, subs in taxonomy.items() for s in subs]
    return spark.createDataFrame(rows, "category string, sub_category string")


def resolution_violations(classes: DataFrame, tags: list[str] | tuple[str, ...]) -> DataFrame:
    """Classifications whose resolution is set and not one of the allowed tags."""
    return classes.where(F.col("resolution").isNotNull() & ~F.col("resolution").isin(list(tags)))


def taxonomy_violations(classes: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Classifications whose (category, sub-category) pair is not allowed.
    The taxonomy is a fixed configuration list, so broadcasting it is bounded."""
    return classes.join(F.broadcast(taxonomy), ["category", "sub_category"], "left_anti")
