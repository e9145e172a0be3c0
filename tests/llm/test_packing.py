import random
import struct
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import Row

from pricewright.llm import packing


def reference_ids(text):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


def check_sequences(rows, capacity=2048, max_docs=None, max_cost=None):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for placed in by.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
        assert max_docs is None or len(placed) <= max_docs
        assert max_cost is None or sum(n * n for _, n in placed) <= max_cost
    return len(by)


def test_ids_are_those_of_the_reference_reader(spark, sf_dir):
    encode = packing.encoder("byte_bpe_50k.json")
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["", " ", "a<|endoftext|>b", "<|endoftext|>", "\x00 é\U0001f600  \n\n x'll 123", "ab" * 3000, " " * 3000]
    for text in texts:
        assert encode(text) == reference_ids(text)


@pytest.mark.parametrize("tokens", [1, 7, 8, 9, 16, 17, 31])
def test_pieces_are_full_but_the_first(tokens):
    got = packing.cut(tokens, 8)
    assert sum(n for _, n in got) == tokens and all(n == 8 for _, n in got[1:]) and 0 < got[0][1] <= 8
    assert [s for s, _ in got] == [sum(n for _, n in got[:i]) for i in range(len(got))]


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [{}, {"max_docs": 3}, {"max_cost": 900}, {"max_docs": 4, "max_cost": 1500}])
def test_plan_respects_every_capacity(rule, limits):
    rng = random.Random(3)
    histogram = {n: rng.randint(1, 40) for n in range(1, 31)}
    kinds = packing.plan(histogram, 64, rule=rule, weights=(1.0, 0.5, 0.5), **limits)
    placed = defaultdict(int)
    for count, items in kinds:
        assert sum(n * k for n, k in items) <= 64
        assert sum(k for _, k in items) <= limits.get("max_docs", 64)
        assert sum(n * n * k for n, k in items) <= limits.get("max_cost", 64 * 64)
        for n, k in items:
            placed[n] += count * k
    assert placed == histogram
    least = -(-sum(n * c for n, c in histogram.items()) // 64)
    sequences = sum(count for count, _ in kinds)
    assert sequences >= least
    if not limits:
        assert sequences <= least + 1


def test_plan_equals_one_at_a_time_best_fit():
    """The grouped steps use as many sequences as best fit on single pieces."""
    rng = random.Random(5)
    sizes = sorted((rng.randint(1, 100) for _ in range(400)), reverse=True)
    free = []
    for n in sizes:
        fitting = [i for i, f in enumerate(free) if f >= n]
        if fitting:
            free[min(fitting, key=lambda i: free[i])] -= n
        else:
            free.append(100 - n)
    histogram = {n: sizes.count(n) for n in set(sizes)}
    assert sum(c for c, _ in packing.plan(histogram, 100)) == len(free)


def test_a_piece_that_fits_nowhere_is_an_error():
    with pytest.raises(ValueError):
        packing.plan({10: 1}, 16, max_cost=50)


def test_query_round_trip(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = packing.op6_best_fit_packing(spark, sf_dir).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == set(docs)
    total = 0
    for doc_id, own in by.items():
        ids = [*reference_ids(docs[doc_id]), 0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert len(part) == r.length and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        total += len(ids)
    assert check_sequences(rows) <= -(-total // 2048) + 1


def test_nulls_repeats_long_texts_and_extra_columns(spark):
    rows = [
        Row(doc_id=1, text=None, length=7, rank="a"), Row(doc_id=1, text="", length=7, rank="a"),
        Row(doc_id=None, text="one two", length=None, rank=None), Row(doc_id=3, text="long word " * 4000, length=1, rank="b"),
        Row(doc_id=3, text="long word " * 4000, length=1, rank="b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length int, rank string")
    got = packing.pack(docs, max_docs=2, max_cost=2048 * 2048).collect()
    check_sequences(got, max_docs=2)
    assert sum(r.length for r in got if r.doc_id == 1) == 2
    assert sum(r.length for r in got if r.doc_id == 3) == 2 * (len(reference_ids("long word " * 4000)) + 1)
    assert packing.pack(docs.limit(0)).count() == 0
    with_ids = packing.pack(docs, with_ids=True).where("doc_id is null").collect()
    assert [list(r.ids) for r in with_ids] == [[*reference_ids("one two"), 0]]
