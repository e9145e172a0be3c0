"""Encoding by halves against the whole text at once, and the queries' digests."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from pricewright.llm import bpe, registry

TINY = bpe.Codec(leaf=3, window=4)
PARTS = [
    "a", "b", "'", "s", "'re", "'LL", "ll", " ", "  ", "\n", "\t", "1", "23", "中", "文字", "é", " ", " ", "!", "..", "-",
    "\U0001f600", "ß", "\x1c", "\x00", "́", "Ж", "aaaa", " the", "  \n ", "<|endoftext|>",
]


def direct(text):
    return TINY.encoding.encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60))
def test_halves_join_to_the_whole(parts):
    text = "".join(parts)
    assert TINY.encode(text) == direct(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80), st.text(max_size=80))
def test_join_is_the_encoding_of_the_concatenation(left, right):
    assert TINY.join(direct(left), direct(right)) == direct(left + right)
    assert TINY.bytes_of(direct(left + right)) == (left + right).encode()


@pytest.mark.parametrize("kind", ["a", "ab", "thequickbrown", "1", "0123456789", "=", "-=~", "中文", "xyz'", " ", "\n ", " "])
@pytest.mark.parametrize("around", [("", ""), (" ", " x"), ("'s", "9"), ("it'", "'s")])
def test_long_matches_without_a_sure_cut(kind, around):
    text = around[0] + "".join(kind[(i * i + i // 7) % len(kind)] for i in range(3000)) + around[1]
    assert TINY.encode(text) == direct(text)


def test_long_match_is_joined_inside():
    """Windows inside a match are a few tokens, not the match."""
    codec, seen = bpe.Codec(leaf=512), []
    whole = codec.encoding.encode_ordinary

    class Spy:
        def encode_ordinary(self, text):
            seen.append(len(text))
            return whole(text)

        _encode_single_piece = staticmethod(codec.encoding._encode_single_piece)

    text = "".join("abcdefgh"[(i * i + i // 5) % 8] for i in range(40_000))
    want, codec.encoding = whole(text), Spy()
    assert codec.encode(text) == want and max(seen) <= 512


def test_trees_of_rows(spark):
    """Texts beyond a segment go through rows and rounds; repeated rows, nulls and names that clash."""
    long = "".join(f"wörd{i % 97} it's 'll 中文字{i} " for i in range(900))
    texts = [(1, long), (1, long), (None, long), (2, None), (3, ""), (4, "short"), (4, "short"), (5, "x" * 5000), (None, None)]
    docs = spark.createDataFrame([(*t, 1, "n") for t in texts], "doc_id bigint, text string, node int, ids string").repartition(3)
    got = bpe.decode(bpe.encode(docs, leaf=7, segment=40, window=4)).collect()
    key = lambda r: (r[0] is not None, r[0], len(r[1]))
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(((i, direct(t or "")) for i, t in texts), key=key)
    assert sorted(bytes(r.decoded) for r in got) == sorted((t or "").encode() for _, t in texts)
    assert bpe.encode(docs.limit(0)).collect() == []


@pytest.mark.parametrize("leaf", [1, 2, 5, 1000])
def test_bytes_go_up_the_tree(leaf):
    import pyarrow as pa

    tokens = pa.array(TINY.token, pa.large_binary())
    texts = ["", "x", "wörd 中文 " * 50, "", "a b c d e f g h i j", " " * 300]
    ids = pa.array([[7], *map(direct, texts), None, [8]], pa.list_(pa.int32())).slice(1, len(texts) + 1)
    assert bpe.decode_lists(tokens, ids, leaf).to_pylist() == [*(t.encode() for t in texts), b""]
    assert bpe.decode_lists(tokens, ids.slice(0, 0), leaf).to_pylist() == []


def test_query_equals_direct_encoding(spark, sf_dir):
    got = {r.doc_id: r for r in registry.queries()["op12_byte_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for d in docs:
        ids = direct(d.text or "")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha((d.text or "").encode())
