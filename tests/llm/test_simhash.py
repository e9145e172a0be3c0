import random

import pytest
from pyspark.sql import Row, functions as F

from pricewright.llm import simhash

MASK = 2**64 - 1


def brute_classes(fps, radius):
    """id -> smallest id reachable, by comparing all pairs of (id, unsigned fingerprint)."""
    parent = {i: i for i, _ in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(fps):
        for j, b in fps[n + 1 :]:
            if (a ^ b).bit_count() <= radius:
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: find(i) for i, _ in fps}


def brute_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    masks = simhash.covering_masks(3)
    assert len(masks) == 15
    for _ in range(5000):
        differing = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(m & differing == 0 for m in masks)


def test_fingerprint_is_that_of_the_definition(spark, sf_dir):
    texts = ["", "  \n", "One", "one TWO", "a b c d", "É é\x1fb c", "x " * 70000]
    for text in texts:
        assert simhash.fingerprint_of(text.encode()) == brute_fingerprint(text)
    spark_hash = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] & MASK
    assert simhash.fingerprint_of(b"a b c") == spark_hash  # a single shingle is its own fingerprint


@pytest.mark.parametrize("limit", [1, 4, 128])
def test_classes_equal_all_pairs(spark, limit):
    """Dense families and chains; a small limit sends every bucket the linear way."""
    rng = random.Random(limit)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for center in fps[:4]:
        fps += [center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(30)]
    chain = rng.getrandbits(64)
    for step in range(12):
        chain ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
        fps.append(chain)
    distinct = sorted(set(fps))
    signed = [f - 2**64 if f >> 63 else f for f in distinct]
    links = simhash.bucket_links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), 3, limit)
    assert all(((r.a ^ r.b) & MASK).bit_count() <= 3 for r in links.collect())
    got = {r.node: r.root for r in simhash.components(links).collect()}
    want = brute_classes([(f, f & MASK) for f in sorted(signed)], 3)
    assert {f: got.get(f, f) for f in signed} == want


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 200)] + [(500, 501)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(200)) and got[501] == 500


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in docs]
    want = brute_classes(sorted(fps), 3)
    got = simhash.op1_simhash(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{f:016x}", want[i]) for i, f in fps}
    assert len(got) == len(docs)


def test_nulls_repeats_and_extra_columns(spark):
    rows = [
        Row(doc_id=5, text=None, fp=1, component_id="x"), Row(doc_id=2, text="", fp=2, component_id="y"),
        Row(doc_id=9, text="a b c d", fp=3, component_id=None), Row(doc_id=9, text="a b c d", fp=4, component_id="z"),
        Row(doc_id=None, text="a B c d", fp=5, component_id="q"), Row(doc_id=None, text="only here without an id", fp=6, component_id="r"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp bigint, component_id string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 2), (2, 2), (9, 9), (9, 9), (None, 9), (None, None)], key=str)
    kept = simhash.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 9, None, None], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_per_class(docs.limit(0)).count() == 0
