"""Line dedup by overlapping windows of three lines.

Every three consecutive lines are a window. The first occurrence of a window in the corpus
stays; later ones are removed, as whole runs of lines: positions that any later occurrence
covers are merged, so a passage of many lines goes as one, and single common lines stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import packed
from reelstar.session import stored

WINDOW = 3


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id``, ``_hash`` (of the text) and ``_covered``, positions of the lines that go.

    Only documents that lose lines have a row.
    """
    # a column of its own: inside a function of the array the split would be made for every line
    cut = docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("hash"),
        F.transform(F.split(text, "\n"), lambda x: F.xxhash64(x)).alias("lines"),
    ).filter(F.size("lines") >= WINDOW)

    def window(i):
        parts = [F.get("lines", i + k) for k in range(WINDOW)]
        return F.struct(
            i.alias("pos"), F.xxhash64(*parts).alias("h"), F.xxhash64(F.lit(5), *parts).alias("g")
        )

    starts = F.sequence(F.lit(0), F.size("lines") - WINDOW)
    # outer, or Spark would make the windows once more to see that there are any
    rows = cut.select("id", "hash", F.explode_outer(F.transform(starts, window)).alias("w"))
    windows = stored(docs.sparkSession, rows.select("id", "hash", "w.*"), "windows")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "hash", "pos")
    firsts = (
        windows.groupBy("h", "g")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    # few windows repeat, but one of them may hold a third of all rows: by a hash besides, neither
    # side can reuse the aggregate's partitioning, so Spark can split a hot window
    spread = F.xxhash64("h", "g").alias("_spread")
    firsts = firsts.select("*", spread).hint("merge")
    both = windows.select("*", spread).join(firsts, ["h", "g", "_spread"])
    later = both.filter(place > F.col("first"))
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    clear = F.when(same, F.greatest("pos", F.col("first.pos") + WINDOW)).otherwise(F.col("pos"))
    covered = later.filter(clear < F.col("pos") + WINDOW).select(
        "id", "hash", F.explode(F.sequence(clear, F.col("pos") + WINDOW - 1)).alias("at")
    )
    return (
        covered.distinct()
        .groupBy(F.col("id").alias("_id"), F.col("hash").alias("_hash"))
        .agg(F.collect_list("at").alias("_covered"))
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without the later occurrences of repeated windows of lines.

    ``text`` is rebuilt from the lines that stay; ``n_lines`` and ``lines_removed`` are added.
    Occurrences are in the order of document id (NULL last), hash of the text and position.
    Where a window overlaps its own first occurrence, the lines of the first stay. Texts of
    fewer than three lines and NULL texts stay as they are (NULL has 0 lines); a text may become
    empty. Rows equal in id and text are one document and come out alike. Columns of the two
    names are replaced.
    """
    rows = packed(docs, id=doc_id, text=text)
    gone = repeated_lines(rows, "id", "text")
    joined = rows.withColumn("h", F.xxhash64("text")).join(
        gone, F.expr("id <=> _id AND h = _hash"), "left"
    )
    joined = joined.withColumn("lines", F.split("text", "\n"))
    positions = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.array_except(positions, F.col("_covered"))
    rebuilt = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    changed = F.col("_covered").isNotNull() & F.col("text").isNotNull()
    left_text = F.when(changed, rebuilt).otherwise(F.col("text")).alias(text)
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "lines_removed")]
    return joined.select(
        *[left_text if c == text else F.col(f"_row.`{c}`") for c in names],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"),
        F.coalesce(F.size(F.col("_covered")), F.lit(0)).alias("lines_removed"),
    )
