"""Line deduplication by a suffix array over line-ID sequences, in DataFrame operations only.

A document is the sequence of its lines (split at line feeds); equal lines have equal IDs. Suffixes are ranked by
prefix doubling: rank ``j`` orders suffixes by their first ``2 ** j`` lines, and follows from the pairs of rank
``j - 1`` at a suffix and ``2 ** (j - 1)`` lines on. Pairs are counted first (copies collapse before the shuffle),
then range-sorted; row numbers that grow along the sorted partitions are the ranks, so no task sees all of them.
Suffixes whose prefix is unique leave the array at once: only repeated prefixes are ranked on.

The suffixes that share their first ``w`` lines are one longest-common-prefix interval. A run of lines counts as
repeated if it has at least ``min_words`` words (blanks plus one; none in a blank line) and also starts earlier:
at a smaller doc_id, or earlier in the same document. Every line in a repeated run is deleted. Each such run is the
union of its shortest parts of ``min_words`` words, taken forward from a line and backward from a line, so it is
enough to look up the interval of those: its length ``w`` lies between two powers of two, and the two ranks that
cover it name the interval. Doubling therefore ends at the longest such part, or when no prefix repeats.

Edge cases: null text counts as empty (one blank line, nothing to delete); a null doc_id is smaller than all others;
rows that repeat a doc_id with other text are documents ordered by a hash of their text, rows that repeat both
share one decision; an empty table gives no rows; columns of the input are carried along, and ``n_lines`` and
``n_removed`` are replaced if the input has them. Blank lines go only within a repeated run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.frames import stored, text_column

KEY = ["_id", "_h"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text", text_column()).withColumn("_id", F.col("doc_id").cast("long")).withColumn("_h", F.xxhash64("_text"))


def _same(a: str, b: str, *more):
    """Null-safe equality of document keys, and of further column pairs."""
    cond = F.col(f"{a}._id").eqNullSafe(F.col(f"{b}._id")) & (F.col(f"{a}._h") == F.col(f"{b}._h"))
    for x, y in more:
        cond = cond & (x == y)
    return cond


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per line: key, pos, line (a 128-bit ID), and the last / first line of its shortest forward / backward part."""
    line = F.transform(
        F.split("_text", "\n", -1),
        lambda x: F.struct(
            F.unhex(F.md5(x.cast("binary"))).alias("line"),
            F.when(F.trim(x) == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).cast("long").alias("words"),
        ),
    )
    by_doc = _keyed(docs).select(*KEY, line.alias("lines")).groupBy(*KEY).agg(F.first("lines").alias("lines"))
    doc = Window.partitionBy(*KEY)
    so_far = doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = by_doc.select(*KEY, F.posexplode("lines").alias("pos", "x")).select(*KEY, "pos", "x.line", "x.words").withColumn("ends", F.sum("words").over(so_far))
    begins = F.col("ends") - F.col("words")
    return (
        lines.withColumn("begins", begins)
        .withColumn("all", F.max("ends").over(doc))
        .withColumn("to", F.max("pos").over(doc.orderBy("begins").rangeBetween(0, min_words - 1)))
        .withColumn("since", F.min("pos").over(doc.orderBy("ends").rangeBetween(-(min_words - 1), 0)))
        .select(
            *KEY,
            "pos",
            "line",
            F.when(F.col("all") - F.col("begins") >= min_words, F.col("to")).alias("to"),
            F.when(F.col("ends") >= min_words, F.col("since")).alias("since"),
        )
    )


def _ranked(suffixes: DataFrame, by: list[str], level: int) -> DataFrame:
    """Suffixes whose ``by`` repeats, with rank: an order-keeping number of ``by``."""
    repeated = suffixes.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    order = repeated.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_rank", F.monotonically_increasing_id())
    order = stored(order, f"line-ranks-{level}")  # range bounds are drawn anew in each run: fix the numbers
    return stored(suffixes.join(order, by).select(*KEY, "pos", F.col("_rank").alias("rank")), f"line-suffixes-{level}")


def repeated_runs(lines: DataFrame) -> DataFrame:
    """(key, start, w): the parts of at least ``min_words`` words that also start earlier."""
    parts = lines.select(*KEY, F.explode(F.array(F.struct(F.col("pos").alias("start"), F.col("to").alias("last")), F.struct(F.col("since").alias("start"), F.col("pos").alias("last")))).alias("p"))
    parts = (
        parts.select(*KEY, "p.start", (F.col("p.last") - F.col("p.start") + 1).alias("w")).where(F.col("w").isNotNull())
    )
    longest = parts.agg(F.max("w")).first()[0]
    ranks, found, level = _ranked(lines.select(*KEY, "pos", "line"), ["line"], 0), None, 0
    while longest is not None:
        size = 1 << level
        wanted = parts.where(F.col("w").between(size, 2 * size - 1)).dropDuplicates([*KEY, "start", "w"])
        a = wanted.alias("p").join(ranks.alias("r"), _same("p", "r", (F.col("p.start"), F.col("r.pos")))).select("p.*", F.col("r.rank").alias("r1"))
        if level:
            at_end = F.col("p.start") + F.col("p.w") - size
            a = a.alias("p").join(ranks.alias("r"), _same("p", "r", (at_end, F.col("r.pos")))).select("p.*", F.col("r.rank").alias("r2"))
        else:
            a = a.withColumn("r2", F.col("r1"))
        interval = ["w", "r1", "r2"]
        first = a.groupBy(*interval).agg(F.min(F.struct(*KEY, "start")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        here = F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("_h") == F.col("first._h")) & (F.col("start") == F.col("first.start"))
        later = a.join(first, interval).where(~here)
        later = later.select(*KEY, "start", "w")
        found = later if found is None else found.unionByName(later)
        if 2 * size > longest:
            break
        step = Window.partitionBy(*KEY).orderBy("pos").rangeBetween(size, size)
        pairs = ranks.withColumn("next", F.max("rank").over(step)).where("next is not null")  # a shorter suffix can't be a longer part's start
        ranks = _ranked(pairs, ["rank", "next"], level + 1)
        level += 1
        if ranks.isEmpty():
            break
    return found if found is not None else parts.where("false")


def dedup_lines(docs: DataFrame, *, min_words: int = 8) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``; adds n_lines and n_removed."""
    lines = stored(line_table(docs, min_words), "lines")
    gone = (
        repeated_runs(lines)
        .select(*KEY, F.explode(F.sequence("start", F.col("start") + F.col("w") - 1)).alias("pos"))
        .groupBy(*KEY)
        .agg(F.collect_set("pos").alias("_gone"))
    )
    columns = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in columns]).alias("_row"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    return (
        _keyed(rows)
        .select("_row", *KEY, "_text")
        .alias("d")
        .join(gone.alias("g"), _same("d", "g"), "left")
        .select("_row", "_text", "_gone", F.split("_text", "\n", -1).alias("_lines"))
        .withColumn("_kept", F.when(F.col("_gone").isNotNull(), kept))
        .select(
            *[F.col("_row")[c].alias(c) for c in columns],
            F.when(F.col("_kept").isNull(), F.col("_text")).otherwise(F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")).alias("text"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("_gone").cast("long"), F.lit(0).cast("long")).alias("n_removed"),
        )
    )


def digest(docs: DataFrame, *, min_words: int = 8) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, kept_sha256 (of the remaining lines joined by line feeds)."""
    out = dedup_lines(docs.select("doc_id", "text"), min_words=min_words)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
