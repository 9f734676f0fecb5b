"""Exact deduplication by progressive refinement.

Texts are grouped by their length, then by a hash of their first bytes, then
by a hash of their whole content.  One scan gives lengths and prefix hashes;
what remains after the two cheap groupings is known before any content is
hashed.  A second scan hashes the content of the surviving groups only.  No
text is shuffled: all that moves are lengths, hashes and ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import bitmap_of, column, whole_text, with_membership
from evenkeel.sources.workspace import written

#: Characters of a text that its prefix hash covers.
PREFIX = 256


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, prefix: int = PREFIX, every_digest: bool = False
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``.

    Of equal texts the row with the largest id stays, ``keep_id`` names it and
    ``group_size`` counts all of them.  ``text_sha256`` is null where two
    texts were told apart without reading them whole, unless ``every_digest``.

    Null text is empty text, and empty texts are equal.  A null id is smaller
    than any other; ``keep_id`` is null only if all ids of the group are.
    Rows with the same id and text are rows of one group like others: one of
    them stays.  An empty table gives no rows; other columns are ignored.
    """
    content = whole_text(text_col)
    seen = docs.select(column(id_col).alias("doc_id"), content.alias("text")).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n"),
        F.xxhash64(F.substring("text", 1, prefix)).alias("p"),
    )
    # Copies fold before the shuffle, so a hot group is a row for each task.
    by_prefix = written(seen.groupBy("n", "p").agg(F.count("*").alias("rows")), "prefixes")
    by_length = by_prefix.groupBy("n").agg(F.sum("rows").alias("same_length")).filter("same_length > 1")
    survivors = by_prefix.join(by_length, "n", "left_semi").filter("rows > 1")

    group = F.xxhash64("n", "p")
    bitmap = bitmap_of(survivors.select(group.alias("k")), "k")
    marked = with_membership(seen, group, bitmap, "survives")
    digest = F.sha2(F.col("text").cast("binary"), 256)
    hashed = written(
        marked.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "survives", "n",
            (digest if every_digest else F.when(F.col("survives"), digest)).alias("text_sha256"),
        ),
        "hashed",
    )
    same = (
        hashed.filter("survives").groupBy("n", "text_sha256")
        .agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
        .select(F.col("n").alias("m"), F.col("text_sha256").alias("h"), "keep", "group_size")
    )
    # Written, so that the join has a shuffle of its own (or none, if the table is small): then adaptive execution can
    # split a hot group, whose other side is one row.
    same = written(same, "same_text")
    found = hashed.join(same, hashed.survives & (F.col("n") == F.col("m")) & (F.col("text_sha256") == F.col("h")), "left")
    return found.select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )
