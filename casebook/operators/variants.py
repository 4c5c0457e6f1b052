"""Documents as VARIANT: parsed once when stored, malformed ones kept apart (S8, C1), and schema drift.

``store_documents`` parses every document when it is stored and writes it as a VARIANT column, so later jobs take fields
from the binary form instead of parsing text. A text that isn't one JSON object goes to a dead-letter table with its reason.

``path_counts`` counts which paths and types the documents hold, all depths in one pass over them; partial counts combine
before the shuffle.
``schema_drift`` compares two such counts: fields that are new, have another type, or are gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casebook import schemas
from casebook.config import Settings
from casebook.operators import silver
from casebook.operators.ordering import written


def _type(doc: Column) -> Column:
    """Type of one value: OBJECT, ARRAY, or the scalar's type; VOID for a JSON null. Types of numbers by their form
    (``1`` BIGINT, ``1.5`` DECIMAL, ``1e3`` DOUBLE)."""
    schema = F.schema_of_variant(doc)
    for end in "<(_":
        schema = F.substring_index(schema, end, 1)
    return schema


def with_variant(raw: DataFrame) -> DataFrame:
    """Bronze ``(id, data)`` -> ``(id, data, doc VARIANT, reason)``: ``reason`` is set, and ``doc`` is not, for texts that
    aren't JSON objects. Rows with NULL data are dropped."""
    # The parser stops after one value and overlooks what follows. Text after the value breaks one of these two wrappings,
    # or makes the array longer.
    array = F.try_parse_json(F.concat(F.lit("["), F.col("data"), F.lit("]")))
    object_ = F.try_parse_json(F.concat(F.lit('{"v":'), F.col("data"), F.lit("}")))
    parsed = raw.where(F.col("data").isNotNull()).select("id", "data", array.alias("_a"), object_.isNotNull().alias("_o"))
    one = F.col("_o") & (F.size(F.try_variant_get("_a", "$", "array<variant>")) == 1)
    parsed = parsed.select("id", "data", F.when(one, F.try_variant_get("_a", "$[0]", "variant")).alias("doc"))
    kind = _type(F.col("doc"))
    reason = F.when(F.col("doc").isNull(), F.lit("not JSON")).when(kind != "OBJECT", F.concat(F.lit("JSON "), F.lower(kind)))
    return parsed.withColumn("reason", reason).withColumn("doc", F.when(F.col("reason").isNull(), F.col("doc")))


def store_documents(raw: DataFrame, path: str) -> None:
    """Parse the documents and write them under ``path``; malformed ones keep their text instead of a value."""
    rows = with_variant(raw)
    rows = rows.select("id", "doc", F.when(F.col("reason").isNotNull(), F.col("data")).alias("data"), "reason", F.col("reason").isNotNull().alias("malformed"))
    rows.write.partitionBy("malformed").parquet(path.rstrip("/"))


STORED = "id string, doc variant, data string, reason string, malformed boolean"


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``(id, doc)`` of the stored documents that are JSON objects."""
    return spark.read.schema(STORED).parquet(path).where("NOT malformed").select("id", "doc")


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """``(id, data, reason)`` of the stored documents that aren't."""
    return spark.read.schema(STORED).parquet(path).where("malformed").select("id", "data", "reason")


def document_fields(docs: DataFrame, schema: StructType) -> DataFrame:
    """``id`` and every field of ``schema`` as a column, taken from the VARIANT; a value of another shape is NULL."""
    fields = [F.try_variant_get("doc", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields if f.name != "id"]
    return docs.select("id", *fields)


def tickets_silver(docs: DataFrame, cfg: Settings) -> DataFrame:
    """``silver.tickets_silver`` from stored VARIANT documents."""
    return silver.ticket_view(document_fields(docs, schemas.TICKET_DOC), cfg)


def common_schema(docs: DataFrame) -> DataFrame:
    """One row ``schema``: the least type that holds every document."""
    return docs.agg(F.schema_of_variant_agg("doc").alias("schema"))


def path_counts(docs: DataFrame, depth: int = 4) -> DataFrame:
    """``(path, type, n)``: how many values stand at each path with each type; ``[*]`` is an array's element."""
    level = _children(docs.select(F.lit("$").alias("path"), F.col("doc").alias("value")))
    for _ in range(depth - 1):
        # Every value stays as it is, and one that holds others comes again with them.
        both = F.array(F.struct(F.lit(False).alias("inside"), F.lit(None).cast("variant").alias("value")), F.struct(F.lit(True).alias("inside"), F.col("value")))
        level = level.select("path", "type", F.explode(F.when(F.col("value").isNotNull(), both).otherwise(F.slice(both, 1, 1))).alias("x")).select("path", "type", "x.*")
        level = _children(level)
    return level.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"))


def _children(level: DataFrame) -> DataFrame:
    """``(path, type, value)`` of the values inside each ``value``, and of the rows not marked ``inside``; ``value`` is kept
    where it holds others."""
    outer = "inside" in level.columns
    path = "CASE WHEN x.key IS NULL THEN concat(path, '[*]') ELSE concat(path, '.', x.key) END"
    path, old = (f"CASE WHEN inside THEN {path} ELSE path END", "CASE WHEN NOT inside THEN type END") if outer else (path, "CAST(NULL AS STRING)")
    inner = level.sparkSession.sql(
        f"SELECT {path} AS path, {old} AS old, x.value AS value FROM {{level}}, LATERAL variant_explode{'_outer' * outer}(value) AS x"
        f"{' WHERE NOT inside OR x.pos IS NOT NULL' * outer}", level=level)
    inner = inner.select("path", "value", F.coalesce("old", _type(F.col("value"))).alias("type"))
    return inner.select("path", "type", F.when(F.col("type").isin("OBJECT", "ARRAY"), F.col("value")).alias("value"))


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(path, status, type, n)`` of what ``after`` holds and ``before`` doesn't (``new`` paths, ``retyped`` values of known
    ones; JSON nulls retype nothing) and of the paths that are ``gone``, with their counts. Both counts, a row for each path
    and type, are stored first: they are made once, however often they are compared."""
    before, after = written(before, "paths"), written(after, "paths")
    known = before.groupBy("path").agg(F.sum("n").alias("seen"))
    there = before.select("path", "type").distinct()
    fresh = after.join(there, ["path", "type"], "left_anti").join(known, "path", "left")
    fresh = fresh.where(F.col("seen").isNull() | (F.col("type") != "VOID"))
    status = F.when(F.col("seen").isNull(), "new").otherwise("retyped")
    gone = before.join(after.select("path").distinct(), "path", "left_anti")
    return fresh.select("path", status.alias("status"), "type", "n").unionByName(gone.select("path", F.lit("gone").alias("status"), "type", "n"))
