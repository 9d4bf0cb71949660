"""Exact de-duplication with the frequent digests split off (DataFrame functions only).

A compact table of digests is written once. A mergeable frequent-items summary of the Misra-Gries kind
(``approx_top_k_accumulate`` / ``_combine``, a bounded number of counters) names every digest that holds a
large share of the rows. Their exact sizes and winners are then counted; this table of at most ``MOST`` rows
is broadcast, so rows of frequent digests are decided where they are read. All other digests are aggregated
and joined back through ordinary shuffles, in which none of them can be large.

Defined results: a null text counts as empty; a null doc_id ranks behind every other; of rows equal in
length, text and doc_id exactly one stays; an empty table gives an empty one; columns of the input beyond
doc_id and text are not looked at and pass through ``deduplicate`` unchanged, whatever their names.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_checked, stored, whole_text

#: Characters that do not count for equality.
BLANKS = " \t\n\x0b\x0c\r"
#: Counters of a summary, the most digests taken from it (the function's own bound), summaries merged at a time.
TRACKED, MOST, MERGED_IN = 4096, 1000, 64
#: Keys of rows that go, up to which they are broadcast (about 100 MB).
KEYS = 1_000_000


def normal_text():
    return reduce(lambda text, blank: F.replace(text, F.lit(blank), F.lit("")), BLANKS, whole_text())


def _keyed(docs: DataFrame, prefix: str = "") -> list:
    return [
        F.unhex(F.sha2(normal_text(), 256)).alias(f"{prefix}digest"),
        F.char_length(whole_text()).cast("long").alias(f"{prefix}n_points"),
    ]


def frequent_digests(digests: DataFrame) -> DataFrame:
    """Every digest with at least one row in 500, and possibly some with fewer; at most ``MOST``."""
    first = digests.groupBy((F.spark_partition_id() % MERGED_IN).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(hex(digest), {TRACKED})").alias("summary")
    )
    # one task for these few summaries: merging fails where a task has none
    top = first.coalesce(1).agg(F.expr(f"approx_top_k_combine(summary, {TRACKED})").alias("summary"))
    items = top.where("summary IS NOT NULL").select(
        F.explode(F.expr(f"approx_top_k_estimate(summary, {MOST})")).alias("found")
    )
    return items.where("found.item IS NOT NULL AND found.count > 1").select(F.unhex("found.item").alias("digest"))


def _winners(digests: DataFrame) -> DataFrame:
    rank = F.struct("n_points", F.col("doc_id").isNotNull(), F.bitwise_not("doc_id"), F.bitwise_not("row_id"))
    best = F.struct("doc_id", "row_id", "n_points")
    return digests.groupBy("digest").agg(
        F.count("*").alias("group_size"), F.max(F.struct(rank.alias("rank"), best.alias("best"))).alias("top")
    ).select("digest", "group_size", *[F.col(f"top.best.{c}").alias(f"best_{c}") for c in ("doc_id", "row_id", "n_points")])


def decisions(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_points, digest, group_size, keep_id, kept, repeated.

    ``repeated`` marks a row that goes although doc_id, length and text are those of the row that stays.
    """
    digests = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_keyed(docs)).withColumn(
        "row_id", F.monotonically_increasing_id()), "digests")
    if digests.isEmpty():
        heavy = digests.select("digest").limit(0)
    else:
        heavy = frequent_digests(digests)
    verified = stored(_winners(digests.join(F.broadcast(heavy), "digest", "left_semi")), "winners")
    frequent = digests.join(F.broadcast(verified), "digest")
    rest = digests.join(F.broadcast(verified.select("digest")), "digest", "left_anti")
    decided = frequent.unionByName(rest.join(_winners(rest), "digest"))
    kept = F.col("row_id") == F.col("best_row_id")
    same = F.col("doc_id").eqNullSafe(F.col("best_doc_id")) & (F.col("n_points") == F.col("best_n_points"))
    return decided.select(
        "doc_id", "n_points", "digest", "group_size", F.col("best_doc_id").alias("keep_id"),
        kept.alias("kept"), (~kept & same).alias("repeated"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    decided = stored(decisions(docs).where(~F.col("kept")), "dropped")
    key = [F.col("doc_id").cast("long").alias("__doc"), *_keyed(docs, "__")]
    rows = docs.select("*", *key)

    def on(other: DataFrame):
        return (rows["__digest"] == other["digest"]) & (rows["__n_points"] == other["n_points"]) & rows[
            "__doc"].eqNullSafe(other["doc_id"])

    # keys only, and broadcast only after they were counted; beyond that the rows are shuffled to them
    gone = broadcast_checked(decided.where(~F.col("repeated")).select("doc_id", "n_points", "digest"), KEYS)
    stays = rows.join(gone, on(gone), "left_anti")
    again = decided.where("repeated").select("doc_id", "n_points", "digest").distinct()
    if not again.isEmpty():
        once = rows.join(again, on(again), "left_semi").dropDuplicates(["__digest"])
        stays = stays.join(again, on(again), "left_anti").unionByName(once)
    return stays.drop("__doc", "__digest", "__n_points")
