"""Mixing sources to target weights, with DataFrame functions only.

Rows get hash-random keys and are ranged by key within their source. Sums of sizes over ranges, then within
ranges, give every row the number of words before it; each source is cut where its budget is used up.
A budget above the source's size repeats the source in whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.common import WORD_RE, staged

MOST_EPOCHS = 3
#: Rows of a range on average; ranges of a source are as many as a power of 2.
RANGE_ROWS = 4096


def word_count(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_RE)), F.lit(0)).cast("long")


KEY_BITS = 60


def random_key(*columns: str, seed: int = 0) -> Column:
    """A number of KEY_BITS bits, random by hash of the columns."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *values)), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, n_rows of each source, with `target`.

    Sources go by code point, null last, and weigh 1, 2, 3, repeating; together they are to get the sum of all
    sizes. Where a target would exceed most_epochs times its source, it stops there and the excess is shared by
    weight among the rest. That is one level of words a weight: sources are ordered by how soon they are full,
    and the level is found from running sums. One row a source is all that is ordered here.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double")).withColumn("most", (F.lit(most_epochs) * F.col("source_size")).cast("double"))
    by_full = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_full.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    # The first source that its level does not fill sets the level of all; later ones have lower levels.
    levels = weighed.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("most"))
    first = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)
    return levels.withColumn("target", F.least(F.col("most"), F.coalesce(first * F.col("weight"), F.col("most")))).drop("weight", "most", "level", "full")


def mix(docs: DataFrame, size: Column | None = None, seed: int = 0, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """doc_id, source, row_key, size, source_size, target, taken for every row of docs (doc_id, text, source).

    taken: words the mix takes of the row, repeats counted: whole epochs of its source, and one time more for
    rows before the cut of the last epoch; the row at the cut gives what is missing. Null sources are a source;
    rows without words take nothing. Rows that repeat in all columns have equal keys and are taken in any order,
    which gives the same rows. An empty table gives an empty one.
    """
    size = word_count() if size is None else size
    rows = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.cast("long").alias("size"), random_key("doc_id", "source", "text", seed=seed).alias("row_key")), "mix-rows")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")), most_epochs)
    ranges = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_rows") / RANGE_ROWS))).cast("int")
    goals = sources.withColumn("bits", ranges)
    # One row a source: AQE broadcasts it if it is small.
    ranged = rows.join(goals, rows["source"].eqNullSafe(goals["source"]), "left").select(rows["*"], "source_size", "target", F.expr(f"shiftright(row_key, {KEY_BITS} - bits)").alias("key_range"))
    sums = ranged.groupBy("source", "key_range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("key_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("o_source"), F.col("key_range").alias("o_range"), F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_before"))
    within = Window.partitionBy("source", "key_range").orderBy("row_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("in_range", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = placed.join(offsets, placed["source"].eqNullSafe(offsets["o_source"]) & (placed["key_range"] == offsets["o_range"]), "left")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    last = budget - epochs * F.col("source_size") - F.col("range_before") - F.col("in_range")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), last))
    return joined.select("doc_id", "source", "row_key", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """docs as the mix takes them: each row as often as its taken words make whole copies, rounded.

    Rows of which less than half a copy is taken go. Columns stay as they are; rows without words are kept once,
    as they cost no budget. Copies of one row lie together. Rows are found in the mix by doc_id, source and key.
    """
    keys = {"__mix_key": random_key("doc_id", "source", "text", seed=seed), "__mix_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), "__mix_source": F.coalesce(F.col("source").cast("string"), F.lit("~"))}
    plan = mix(docs, seed=seed).select(F.col("row_key").alias("__mix_key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("~")).alias("__mix_id"), F.coalesce("source", F.lit("~")).alias("__mix_source"), "size", "taken")
    once = plan.groupBy(*keys).agg(F.max("size").alias("__mix_size"), F.max("taken").alias("__mix_taken"))  # rows that repeat
    rows = docs.withColumns(keys).join(once, [*keys])
    copies = F.when(F.col("__mix_size") == 0, F.lit(1)).otherwise(F.round(F.col("__mix_taken") / F.col("__mix_size"))).cast("int")
    return rows.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*docs.columns)
