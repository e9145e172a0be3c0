"""Near duplicates by SimHash, found with covering masks.

Every document gets a 64-bit fingerprint; documents whose fingerprints differ in at most
``radius`` bits are linked, and the smallest ``doc_id`` reachable over links names the class.

Candidates come from covering locality-sensitive hashing. Bit i carries a nonzero vector m(i) of
``radius + 1`` bits, and for each nonzero vector v the mask a(v) holds the bits whose product
<m(i), v> is odd. Up to ``radius`` differing bits give at most ``radius`` vectors, which leave some
v orthogonal to all of them, so the mask a(v) covers none of the differing bits: every pair within
the radius agrees under one of the 2^(radius+1) - 1 masks. The masks are no random draw; no pair is missed.

The work is on distinct fingerprints, so copies meet before any pair is formed. A bucket of up to
``bucket_limit`` fingerprints compares its members among themselves. The members of a larger one
(a dense family of near copies) are linked exactly in a linear way instead: each emits all values
within ``ceil(radius / 2)`` bits, and is linked to the smallest fingerprint within
``floor(radius / 2)`` bits of the same value. Any two linked this way are within the radius, and any
two within the radius meet through some value in between, so classes come out the same.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.llm.common import cut_lineage, splittable, table

BITS = 64
SHINGLE_WORDS = 3
RADIUS = 3
BUCKET_LIMIT = 128
SEED = 42


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 masks, as unsigned numbers; the vectors are dealt to the bits in turn."""
    vectors = 2 ** (radius + 1) - 1
    return [
        sum(1 << i for i in range(bits) if (((i % vectors) + 1) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def fingerprint_of(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of one UTF-8 text; hashes are summed in blocks, so long texts fit."""
    import numpy as np
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    total = np.zeros(BITS, dtype=np.int64)
    count = len(words) - width + 1
    for begin in range(0, count, 1 << 16):
        block = words[begin : begin + (1 << 16) + width - 1]
        grams = zip(*[block[i:] for i in range(width)])
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams], dtype=">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > count).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row (key, fp) per row of ``docs``; fp is the fingerprint as a signed long."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint_of(t or b"", shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    slim = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {kind}, fp bigint").withColumnRenamed("id", key)


def bucket_links(fps: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b), a < b, that join up the same classes as all pairs within the radius.

    ``fps`` holds distinct fingerprints in a column ``fp``.
    """
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in covering_masks(radius)]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])
    keyed = fps.select("fp", F.posexplode(keys).alias("mask", "key"))
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = keyed.join(splittable(sizes), ["mask", "key"])
    small = (
        members.where(F.col("n") <= bucket_limit)
        .groupBy("mask", "key")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    pairs = F.flatten(
        F.transform(
            "fps",
            lambda a, i: F.transform(
                F.filter(F.slice("fps", i + 2, F.size("fps")), lambda b: F.bit_count(a.bitwiseXOR(b)) <= radius),
                lambda b: F.struct(a.alias("a"), b.alias("b")),
            ),
        )
    )
    near = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    crowded = members.where(F.col("n") > bucket_limit).select("fp").distinct()
    return near.union(dense_links(crowded, radius)).distinct()


def within(radius: int) -> Column:
    """All bit patterns with up to ``radius`` bits set."""
    one = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: _bit(i))
    parts = [F.array(F.lit(0).cast("long"))]
    if radius >= 1:
        parts.append(one)
    if radius >= 2:
        two = F.transform(
            F.sequence(F.lit(0), F.lit(BITS - 2)),
            lambda i: F.transform(F.sequence(i + 1, F.lit(BITS - 1)), lambda j: _bit(i).bitwiseOR(_bit(j))),
        )
        parts.append(F.flatten(two))
    if radius >= 3:
        raise ValueError("a radius of up to 4 bits is covered")
    return F.concat(*parts)


def dense_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links within ``radius`` among crowded fingerprints; rows grow linearly with them."""
    low, high = radius // 2, radius - radius // 2
    ends = lambda reach: fps.select("fp", F.explode(within(reach)).alias("d")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("d")).alias("meet")
    )
    hubs = ends(low).groupBy("meet").agg(F.min("fp").alias("hub"))
    return (
        ends(high)
        .join(splittable(hubs), "meet")
        .where("fp <> hub")
        .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b"))
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node of its class.

    Large and small stars in turn: first each node's larger neighbours move to its smallest one,
    then its smaller ones. Both are an aggregate joined back, so a hub's neighbours are combined
    in the map tasks and a hot hub is split at the join. Rounds grow with the logarithm of the nodes.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _digest(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(splittable(least), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(splittable(least), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``: key, fp (signed), component_id.

    Null and wordless texts have fingerprint 0 and are linked like any other. Rows that repeat a
    key repeat in the result. A row without a key belongs to the class of its fingerprint; the
    class id is null only if no row of the class has a key. An empty table gives no rows.
    """
    fps = cut_lineage(fingerprints(docs, shingle, text, key))
    distinct = fps.groupBy("fp").agg(F.min(key).alias("first_id"))
    roots = components(bucket_links(distinct.select("fp"), radius, bucket_limit))
    named = roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "first_id")
    classes = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = named.join(splittable(classes), "root").select("fp", "component_id")
    ids = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return fps.join(splittable(ids), "fp", "left").select(key, "fp", "component_id")


def one_per_class(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of each class, with all its columns.

    Rows that repeat a kept id leave one row (the smallest text). Rows without an id cannot be
    named as kept or dropped and stay.
    """
    classes = near_duplicates(docs, shingle, radius)
    kept = classes.where("doc_id = component_id").select("doc_id").distinct()
    first = F.struct(*[F.col(c) for c in sorted(docs.columns, key=lambda c: c != "text")])
    chosen = docs.join(splittable(kept), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(first).alias("row"))
    named = chosen.select(*[F.col("row")[c].alias(c) for c in docs.columns])
    return named.unionByName(docs.where(F.col("doc_id").isNull()))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document: 3-word shingles, up to 3 differing bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
