"""Exact dedup by progressive refinement, in DataFrame functions only.

Rows are grouped by the length of their normalised text, then by a hash of its prefix, then by a hash of all of it. A row
whose (length, prefix hash) nobody shares is settled by the first two levels: it is a group of its own and takes no further part. Only the
surviving rows are grouped by the hash of their whole content. That hash is made for them alone, unless the caller asks for the digest of every row,
which is then a column of the result and decides nothing.

Sizes: every table after the first projection is narrow (ids and hashes). Groups are reduced with partial aggregation, so a
group that holds a third of all rows reaches its reducer as one row per task. The way back from groups to rows is a join
with one row per group: groups with over 1/1000 of the rows (at most 1000 of them, hence a proven bound) are
broadcast, the rest are shuffled and none is larger than that share. The survivors' (length, prefix hash) pairs are broadcast up to ``FEW``; beyond that
narrow rows are joined with them by a shuffle, and every row is hashed before it, as whole texts are not shuffled.

Defined cases: a null text is an empty text; all empty texts are one group. Text that differs only in ASCII white
space is equal. The row with the most code points stays, then the smallest id, a null id counting as the largest. Rows
repeated with the same id are told apart by their place in the written key table, and exactly one row of a group stays. An
empty table gives an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import ASCII_SPACE, broadcast_below, cut, free_name

#: Code points of the normalised text that the second level hashes.
PREFIX = 64
#: A group with over this share of the rows is joined by broadcast; there are at most 1 / share of them.
HOT_SHARE = 1e-3
#: Narrow rows (two numbers each) that are broadcast at most.
FEW = 1_000_000


def normalised(text: Column) -> Column:
    """The text without any ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


def _levels(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    first = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("points"), normalised(F.col(text_col)).alias("norm"))
    return first.withColumns({"n_norm": F.length("norm"), "prefix": F.xxhash64(F.substring("norm", 1, PREFIX))})


def _keys(docs: DataFrame, id_col: str, text_col: str, digest_all: bool) -> DataFrame:
    """One narrow row for each row of docs: ``survives`` (someone shares length and prefix) and, for survivors or all, text_sha256."""
    read = _levels(docs, id_col, text_col)
    shared = cut(read.groupBy("n_norm", "prefix").agg(F.count("*").alias("n")).filter("n > 1").select("n_norm", "prefix", F.lit(True).alias("survives")))
    digest = F.sha2(F.col("norm").cast("binary"), 256)
    cols = ["doc_id", "points", "n_norm", "prefix", F.coalesce("survives", F.lit(False)).alias("survives")]
    if shared.limit(FEW + 1).count() <= FEW:
        found = read.join(F.broadcast(shared), ["n_norm", "prefix"], "left")
        return found.select(*cols, (digest if digest_all else F.when(F.col("survives"), digest)).alias("text_sha256"))
    narrow = read.select("doc_id", "points", "n_norm", "prefix", digest.alias("text_sha256")).join(shared, ["n_norm", "prefix"], "left")
    return narrow.select(*cols, "text_sha256")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """For each row of docs: doc_id, keep_id, group_size, kept, text_sha256 (of every row only if ``digest_all``)."""
    keys = cut(_keys(docs, id_col, text_col, digest_all).withColumn("row_id", F.monotonically_increasing_id()))
    limit = int(keys.count() * HOT_SHARE) + 1
    keyed = keys.withColumn("g", F.when(F.col("survives"), F.concat_ws(":", "n_norm", "prefix", "text_sha256")))
    better = F.struct("points", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not(F.col("doc_id").cast("long")).alias("by_id"), F.bitwise_not("row_id").alias("by_row"))
    groups = cut(
        keyed.filter("survives").groupBy("g").agg(F.count("*").alias("n"), F.max_by(F.struct("doc_id", "row_id"), better).alias("best")).filter("n > 1").select("g", "n", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"))
    )
    hot = groups.filter(F.col("n") > limit).select("g", *(F.col(c).alias(f"h_{c}") for c in ("n", "keep_id", "keep_row")))
    marked = keyed.join(F.broadcast(hot), "g", "left")
    # settled rows and those of hot groups get a key of their own, so that the shuffle of the cold join deals them evenly
    cold_key = F.when(F.col("h_n").isNull() & F.col("survives"), F.col("g")).otherwise(F.concat(F.lit("row"), F.col("row_id")))
    out = marked.withColumn("g", cold_key).join(groups.filter(F.col("n") <= limit), "g", "left")
    size, stay = F.coalesce("h_n", "n"), F.coalesce("h_keep_row", "keep_row")
    return out.select(
        "doc_id",
        F.when(size.isNull(), F.col("doc_id")).when(F.col("h_n").isNotNull(), F.col("h_keep_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce(size, F.lit(1)).cast("long").alias("group_size"),
        (size.isNull() | (stay == F.col("row_id"))).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that ``exact_groups`` drops, all columns kept.

    Rows go by their id. Only the rows of ids that are both kept and dropped (repeated or null ids) are told apart by the digest of their text: of
    each digest that no row with a clear id keeps, one row stays, reduced with partial aggregation, so that no group is gathered in a task.
    """
    decided = cut(exact_groups(docs, id_col, text_col))
    gone, twice = free_name(docs, "__gone"), free_name(docs, "__twice")
    dropped = decided.filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    kept = decided.filter("kept").select(F.col("doc_id").alias(twice)).distinct()
    both = cut(kept.join(dropped, F.col(gone).eqNullSafe(F.col(twice)), "left_semi"))
    if both.limit(1).count() == 0:
        return docs.join(broadcast_below(dropped, FEW), F.col(id_col).eqNullSafe(F.col(gone)), "left_anti")
    unclear = broadcast_below(both, FEW)
    same = F.col(id_col).eqNullSafe(F.col(twice))
    clear = docs.join(unclear, same, "left_anti").join(broadcast_below(dropped, FEW), F.col(id_col).eqNullSafe(F.col(gone)), "left_anti")
    # what keeps the unclear rows' texts: the best row of the digest, by exact_groups' order; a clear one rules all unclear ones out
    digest, points = free_name(docs, "__digest"), free_name(docs, "__points")
    norm = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    rest = docs.join(unclear, same, "left_semi").withColumns({digest: norm, points: F.length(F.coalesce(F.col(text_col), F.lit("")))})
    best = F.struct(F.col(points), F.col(id_col).isNotNull().alias("known"), F.bitwise_not(F.col(id_col).cast("long")).alias("by_id"))
    one = rest.groupBy(digest).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), best).alias("row"))
    winners = decided.filter("kept and text_sha256 is not null").select(F.col("text_sha256").alias("w_digest"), F.col("doc_id").alias("w_id"))
    lost = winners.join(both, F.col("w_id").eqNullSafe(F.col(twice)), "left_anti").select("w_digest")
    stay = one.join(lost, F.col(digest) == F.col("w_digest"), "left_anti").select("row.*")
    return clear.unionByName(stay)
