"""Line dedup: lines that occur in several documents stay only in the smallest one.

Lines are exploded with their positions and hashed; documents are counted per hash, and each
document is put together again from the runs of lines between the dropped positions. The text
itself is shuffled once, when the positions come back to it; the hashes are staged once for the
two steps that read them. A line that a third of all documents share costs one pre-aggregated
row per map task in the count. The shared lines are staged too: where an aggregate on the same key
stood below the join, it would already have the join's partitioning, and adaptive execution could
not split the join's hot partition.

Null or empty text is one empty line. A text of any length is split whole, but its positions must fit
a row. An empty table has no rows. Other columns come out as they are, whatever they are called, unless
their names begin with two underscores. Rows with a null ``doc_id`` have no place in the order of
documents: their lines neither count nor go. Repeated rows count as one document, and each comes
out. Lines are compared by 128 bits of hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, lower_ascii, stage


def line_key(line: Column) -> Column:
    """A line without blanks at its ends and with A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """Every row of ``docs`` with ``text`` replaced by its kept lines.

    Keys of at least ``min_chars`` code points that at least ``min_docs`` documents hold lose all
    their lines except in the smallest ``doc_id``. Two columns are added: ``__n_lines`` before
    dropping and ``__n_dropped``.
    """
    row = F.xxhash64("doc_id", "text")  # tells rows that share a doc_id apart
    hashed = stage(
        docs.select("doc_id", row.alias("row"), F.posexplode(F.split("text", "\n")))
            .where("doc_id IS NOT NULL")
            .select("doc_id", "row", "pos", line_key(F.col("col")).alias("key"))
            .where(F.length("key") >= min_chars)
            .select("doc_id", "row", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit(1), "key").alias("h2")), "lines")
    seen = hashed.groupBy("h1", "h2")
    if min_docs == 2:
        firsts = seen.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")) \
                     .where("first < last")
    else:
        firsts = seen.agg(F.min("doc_id").alias("first"),
                          F.count_distinct("doc_id").alias("n")).where(F.col("n") >= min_docs)
    shared = stage(firsts.select("h1", "h2", "first"), "shared-lines")
    dropped = (hashed.join(shared, ["h1", "h2"])
               .where("doc_id > first").groupBy("doc_id", "row")
               .agg(F.sort_array(F.collect_set("pos")).alias("__cut"))
               .withColumnsRenamed({"doc_id": "__doc", "row": "__of"}))
    both = docs.withColumn("__row", row).join(
        dropped, (F.col("doc_id") == F.col("__doc")) & (F.col("__row") == F.col("__of")), "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    kept = F.when(F.col("__cut").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(_between(lines, F.col("__cut")), "\n"))
    return both.select(
        *[kept.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.size(lines).cast("bigint").alias("__n_lines"),
        F.coalesce(F.size("__cut"), F.lit(0)).cast("bigint").alias("__n_dropped"))


def _between(lines: Column, cut: Column) -> Column:
    """``lines`` without the positions in the sorted array ``cut``, as the runs between them."""
    ends = F.concat(cut, F.array(F.size(lines)))
    return F.flatten(F.transform(ends, lambda end, i: F.slice(
        lines, F.when(i == 0, 1).otherwise(F.get(cut, i - 1) + 2),
        end - F.when(i == 0, 0).otherwise(F.get(cut, i - 1) + 1))))
