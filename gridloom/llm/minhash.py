"""Near-duplicate detection: one-permutation MinHash with optimal densification, bands, star-shaped candidates, exact confirmation.

A text is the set of its distinct word shingles, as 64-bit hashes. The range of the hash is cut into ``BANDS * ROWS`` bins; the signature
holds the least hash of each bin, an empty bin borrowing from the first non-empty bin of a random order of its own (densification with the least variance). With 30 bands of
5 rows a pair of similarity 0.85 shares no bucket with probability 2e-8, one of 0.8 with 5e-6.

1. Rows with equal sets form a class, reduced with partial aggregation; its smallest id stands for it.
2. Classes that share a bucket are candidates. Their texts are read again for the full sets, and each gets its number of private shingles (that no other
   candidate has) and a histogram of its other shingles over ``PARTS`` parts of the hash range. Both bound the intersection with any
   other set from above, so what they rule out is no link: a class with too many private shingles has none at all.
3. Within a bucket every class is paired with one centre only, the one with the least share of private shingles: pairs are linear in
   the rows. Pairs are confirmed on the full sets and joined to components.
4. A link between two classes that both fail against their centres would be lost to the star shape. So in buckets whose classes are not all in one
   component the other pairs are tested too, but a pair leaves the join only if its components differ, the bounds allow a link, and the
   bucket is the first that the two share. There is no cap on buckets or partners, and no link within a bucket is lost.

Components are found by alternating least neighbours and pointer jumping on tables of links; nothing is collected to the driver. Loops cut their
lineage with checkpoint().

Defined cases: words are runs of characters other than ASCII white space, A-Z lower-cased. With fewer words than a shingle has, the whole sequence is one
shingle. A null text or one without words has an empty set and is linked with nothing, neither is a row with a null id (its component is null, it is kept).
Rows with the same id are one node. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import broadcast_below, cut, free_name, mapped, resident

BANDS, ROWS = 30, 5
BINS = BANDS * ROWS
CACHE = 250_000
#: Ids of candidates are broadcast up to this number (8 bytes each), to read only their texts again; beyond it they are joined by a shuffle.
FEW = 2_000_000
#: Parts of the histogram that bounds an intersection.
PARTS = 128
#: A bucket or class with over this share of the rows is joined by broadcast; there are at most 1 / share of them (by band).
HOT_SHARE = 1e-3
#: Links of one node, and parts of one component, that are looked at together.
HUB, SPREAD = 256, 8


class Shingler:
    """Sorted distinct shingle hashes and signatures of texts."""

    def __init__(self, size: int):
        self.size = size
        self.words: dict[bytes, int] = {}
        rng = np.random.default_rng(7)
        self.edges = np.array([-(-(i << 64) // BINS) for i in range(BINS)], np.uint64)
        self.order = np.argsort(rng.random((BINS, BINS)), axis=1)
        self.mult = rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)

    def hashes(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        try:
            w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for x in words:
                if x not in known:
                    known[x] = xxhash.xxh3_64_intdigest(x)
            w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.size, len(w))
        n = len(w) - k + 1
        h = np.full(n, k, np.uint64)
        for i in range(k):
            h = (h ^ w[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h.sort()
        return h[np.concatenate(([True], h[1:] != h[:-1]))] if n > 1 else h

    def bands(self, h: np.ndarray) -> np.ndarray:
        """One bucket key for each band."""
        at = np.searchsorted(h, self.edges)
        least = h[np.minimum(at, len(h) - 1)]
        full = at < np.concatenate((at[1:], [len(h)]))
        if not full.all():
            from_bin = self.order[np.arange(BINS), np.argmax(full[self.order], axis=1)]
            least = np.where(full, least, least[from_bin])
        rows = least.reshape(BANDS, ROWS) * self.mult[None, :]
        rows ^= rows >> np.uint64(31)
        return ((rows.sum(axis=1, dtype=np.uint64) + self.band) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def shingler(size: int) -> Shingler:
    return resident(("shingler", size), lambda: Shingler(size))


def signatures(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (128 bits of the set), bands (null for an empty set)."""

    def run(batches):
        s = shingler(size)
        for b in batches:
            n, x, y, keys = [], [], [], []
            for t in b.column(1).to_pylist():
                h = s.hashes(t)
                n.append(len(h))
                d = xxhash.xxh3_128_digest(h.tobytes())
                x.append(int.from_bytes(d[:8], "little", signed=True))
                y.append(int.from_bytes(d[8:], "little", signed=True))
                keys.append(s.bands(h) if len(h) else None)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_shingles": pa.array(n, pa.int64()), "set_a": pa.array(x, pa.int64()), "set_b": pa.array(y, pa.int64()), "bands": pa.array(keys, pa.list_(pa.int64()))})

    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    return mapped(rows, run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """rep, set_a, set_b, items (the sorted hashes) of the rows whose id is a ``rep`` of ``wanted``."""

    def run(batches):
        s = shingler(size)
        for b in batches:
            h = [s.hashes(t) for t in b.column(1).to_pylist()]
            d = [xxhash.xxh3_128_digest(x.tobytes()) for x in h]
            yield pa.RecordBatch.from_pydict({"rep": b.column(0), "set_a": pa.array([int.from_bytes(x[:8], "little", signed=True) for x in d], pa.int64()), "items": pa.array([x.view(np.int64) for x in h], pa.list_(pa.int64()))})

    ids = broadcast_below(wanted.select("rep"), FEW)
    rows = docs.selectExpr(f"cast(`{id_col}` as long) rep", f"`{text_col}` text").join(ids, "rep", "left_semi")
    return mapped(rows, run, "rep long, set_a long, items array<long>")


def attach(pairs: DataFrame, side: str, sets: DataFrame) -> DataFrame:
    """pairs with the set of their ``side`` as ``items_<side>``.

    A class can have many partners, so its set is joined under a salt of the partner's id: about 256 pairs of one class meet in a task, and a
    set is copied only as often as its pairs need.
    """
    other = "b" if side == "a" else "a"
    per = cut(pairs.groupBy(side).agg(F.count("*").alias("c")).select(side, F.least(F.ceil(F.col("c") / 256), F.lit(4096)).cast("int").alias("parts")))
    if not per.filter("parts > 1").limit(1).count():
        return pairs.join(sets.select(F.col("rep").alias(side), F.col("items").alias(f"items_{side}")).hint("merge"), side)
    many = broadcast_below(per.filter("parts > 1"), FEW)
    salt = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(other), F.col("parts").cast("long"))).otherwise(F.lit(0).cast("long"))
    salted = pairs.join(many, side, "left").withColumn("salt", salt).drop("parts")
    copies = sets.select(F.col("rep").alias(side), F.col("items").alias(f"items_{side}")).join(per, side)
    copies = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1).cast("array<long>"))).drop("parts")
    return salted.join(copies.hint("merge"), [side, "salt"]).drop("salt")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose full sets have 100 * intersection >= percent * union."""
    near = pairs.filter("100 * least(n_a, n_b) >= {0} * greatest(n_a, n_b)".format(percent))
    both = attach(attach(near, "a", sets), "b", sets)
    same = F.size(F.array_intersect("items_a", "items_b"))
    return both.filter(same * 100 >= (F.col("n_a") + F.col("n_b") - same) * percent).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, comp: the smallest node of each component of the links (a, b). Nodes without a link are not listed.

    No hub and no component is a single task: the links of a hub are dealt by a salt over as many parts as its degree asks for, and its label is
    copied to these; the nodes of a component are dealt over ``SPREAD`` parts, to which the labels of components (not of nodes) are copied.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    degrees = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp"), F.count("*").alias("degree"))
    # both directions are there, so a node's own links say in how many parts its neighbours look for it: the salt goes with the link
    parts = F.ceil(F.col("degree") / HUB).cast("long")
    now = cut(degrees.select("node", "comp", parts.alias("parts")))
    hubs = now.filter("parts > 1").select(F.col("node").alias("b"), "parts")
    salt = F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1).cast("long")))
    both = cut(both.join(broadcast_below(hubs, FEW), "b", "left").select("a", "b", salt.alias("salt")))
    while True:
        # the least label of the neighbours, then the label of that label
        labels = now.select(F.col("node").alias("b"), "comp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"))
        around = both.join(labels, ["b", "salt"]).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("around"))
        low = cut(now.join(around, "node").select("node", F.least("comp", "around").alias("comp"), F.col("comp").alias("was"), "parts"))
        roots = low.select("comp").distinct().join(low.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp")
        jump = roots.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
        after = cut(low.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SPREAD).cast("long"))).join(jump, ["comp", "salt"]).select("node", F.least("comp", "next").alias("comp"), "was", "parts"))
        moved = after.filter("comp <> was").limit(1).count()
        now = after.select("node", "comp", "parts")
        if not moved:
            return now.select("node", "comp")


def bounds(sets: DataFrame) -> DataFrame:
    """rep, n, u (private shingles) and hist (of the others) of each candidate."""
    owners = sets.select("rep", F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("c"), F.min("rep").alias("rep"))
    private = owners.filter("c = 1").groupBy("rep").agg(F.collect_list("item").alias("private"))  # a part of one text's set

    def run(batches):
        for b in batches:
            hist, u = [], []
            items, private = b.column(1), b.column(2)
            for i in range(b.num_rows):
                h = np.asarray(items[i].values).view(np.uint64)
                p = np.asarray(private[i].values).view(np.uint64) if private[i].is_valid else h[:0]
                part = [np.bincount((x >> np.uint64(40)).astype(np.int64) % PARTS, minlength=PARTS) for x in (h, p)]
                hist.append((part[0] - part[1]).astype(np.int32))
                u.append(len(p))
            yield pa.RecordBatch.from_pydict({"rep": b.column(0), "u": pa.array(u, pa.int64()), "hist": pa.array(hist, pa.list_(pa.int32()))})

    return mapped(sets.join(private, "rep", "left").select("rep", "items", "private"), run, "rep long, u long, hist array<int>")


def linkable(n_a: str, u_a: str, n_b: str, u_b: str, percent: int) -> str:
    """Whether sizes and private shingles leave room for a link."""
    most = f"least({n_a} - {u_a}, {n_b} - {u_b})"
    return f"100 * {most} >= {percent} * ({n_a} + {n_b} - {most})"


def residual(buckets: DataFrame, about: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes of different components that share a bucket and that the bounds do not rule out, each once."""
    rows = buckets.select("rep", "band", "key").join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    open_ = rows.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("key")
    rows = cut(rows.join(open_, "key")).join(about, "rep")
    side = lambda x: rows.select("key", "band", *(F.col(c).alias(f"{c}_{x}") for c in ("rep", "n", "u", "comp", "bands", "hist")))
    most = "aggregate(zip_with(hist_a, hist_b, (x, y) -> least(x, y)), 0L, (s, x) -> s + x)"
    on = f"""rep_a < rep_b and comp_a <> comp_b and {linkable("n_a", "u_a", "n_b", "u_b", percent)}
        and array_position(zip_with(bands_a, bands_b, (x, y) -> x = y), true) = band_a + 1
        and 100 * {most} >= {percent} * (n_a + n_b - {most})"""
    a, b = side("a").withColumnsRenamed({"key": "key_a", "band": "band_a"}), side("b").drop("band")
    pairs = a.hint("merge").join(b, F.expr(f"key_a = key and {on}"))  # a hot bucket is split by the adaptive skew join
    return pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), "n_a", "n_b")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs."""
    rows = cut(signatures(docs, size, id_col, text_col))
    some = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = cut(some.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("g_n")))
    keys = classes.select("rep", "n", F.posexplode("bands").alias("band", "k")).select("rep", "band", F.xxhash64("band", "k").alias("key"))
    shared = cut(keys.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key"))
    buckets = cut(keys.join(shared, "key"))
    wanted = cut(buckets.select("rep").distinct())
    sets = cut(shingle_sets(docs, wanted, size, id_col, text_col).join(classes.select("rep", "set_a"), ["rep", "set_a"], "left_semi").select("rep", "items"))
    seen = sets.select(F.count("*").alias("n"), F.count_distinct("rep").alias("d")).first()
    if seen.n != seen.d:  # an id is repeated; only then the sets are dealt by id
        sets = cut(sets.dropDuplicates(["rep"]))
    about = cut(classes.select("rep", "n", "bands").join(bounds(sets), "rep").filter(f"100 * (n - u) >= {percent} * n"))
    buckets = cut(buckets.join(about.select("rep", "n", "u"), "rep"))  # histograms stay apart: a class stands in many buckets
    heads = buckets.groupBy("key").agg(F.min(F.struct(F.expr("u / n").alias("share"), "rep", "n", "u")).alias("h")).select("key", F.col("h.rep").alias("a"), F.col("h.n").alias("n_a"), F.col("h.u").alias("u_a"))
    stars = buckets.select("key", F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("u").alias("u_b")).join(heads, "key")
    pairs = cut(stars.filter("a <> b").filter(linkable("n_a", "u_a", "n_b", "u_b", percent)).select("a", "b", "n_a", "n_b").distinct())
    links = cut(confirmed(pairs, sets, percent))
    comps = components(links)
    found = cut(confirmed(cut(residual(buckets, about, comps, percent)), sets, percent))
    if found.limit(1).count():
        comps = components(links.union(found))
    # back from classes to rows: classes with many rows by broadcast (their number is bounded), the others by a shuffle
    final = cut(classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("set_a", "set_b", F.coalesce("comp", "rep").alias("c"), "g_n"))
    limit = int(rows.count() * HOT_SHARE) + 1
    hot = F.broadcast(final.filter(F.col("g_n") > limit).select("set_a", "set_b", F.col("c").alias("h")))
    marked = rows.drop("bands").withColumn("own", F.monotonically_increasing_id()).join(hot, ["set_a", "set_b"], "left")
    plain = F.col("h").isNull() & (F.col("n_shingles") > 0)
    dealt = marked.withColumn("set_a", F.when(plain, F.col("set_a")).otherwise(F.xxhash64("own"))).withColumn("set_b", F.when(plain, F.col("set_b")).otherwise(F.col("own")))
    joined = dealt.join(final.filter(F.col("g_n") <= limit).select("set_a", "set_b", "c"), ["set_a", "set_b"], "left")
    found = F.when(F.col("n_shingles") > 0, F.coalesce("h", "c")).otherwise(F.col("doc_id"))
    comp = F.when(F.col("doc_id").isNotNull(), found)
    return joined.select("doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without all rows but one of each component, all columns kept; rows that repeat a kept id stay."""
    name = free_name(docs, "__gone")
    gone = cut(near_duplicates(docs, size, percent, id_col, text_col).filter("not kept").select(F.col("doc_id").alias(name)).distinct())
    return docs.join(broadcast_below(gone, FEW), F.col(id_col) == F.col(name), "left_anti")
