"""Aligned tokens against plain loops over bytes."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers as public
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pricewright.llm import alignment, registry

NOTHING = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def readers():
    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    # The printable stand-ins of the byte-level vocabulary.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(n): n for n in plain} | {chr(256 + i): n for i, n in enumerate(x for x in range(256) if x not in plain)}
    a_bytes = lambda i: bytes(stand_in[c] for c in a.id_to_token(i))

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def read(text):
        if not text:
            return [], []
        own_a = [(i, a_bytes(i)) for i in a.encode(" " + text, add_special_tokens=False).ids]
        own_b = [(i, b_bytes(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        same = b"".join(t for _, t in own_a) == whole == b"".join(t for _, t in own_b)
        return (own_a, own_b) if same else ([], [])

    return read


def spans(tokens):
    out, at = [], 0
    for i, own in tokens:
        out.append((i, at, at + len(own)))
        at += len(own)
    return out


def brute(read, texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    aligned, counts = [], Counter()
    for text in texts:
        a, b = map(spans, read(text))
        links, j = [], 0
        for i, start, end in a:
            while j and b[j - 1][2] > start:
                j -= 1
            while j < len(b) and b[j][1] < end:
                if b[j][2] > start:
                    links.append((i, b[j][0]))
                j += 1
        counts.update(links)
        aligned.append((a, b, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for a, b, links in aligned:
        shared = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for high in shared:
            inside = [[str(i) for i, s, e in side if low <= s and e <= high] for side in (a, b)]
            groups.append("|".join(",".join(x) for x in inside))
            low = high
        best = sum(counts[x] == most[x[1]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return out


def result(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


TEXTS = [
    "The quick brown fox", "", None, " leading space", "tab\tand\nline", "naïve café 中文字 \U0001f600!", "a▁b", "<|endoftext|> <s> </s>",
    "x" * 300, "  ", " nbsp", "<0x41>", "The quick brown fox", "ｆｕｌｌ width", "é combining", "\x00 nul",
]


def test_alignment_equals_plain_loops(spark, readers):
    docs = spark.createDataFrame([(n, t, "x", 1) for n, t in enumerate(TEXTS)], "doc_id bigint, text string, block string, pair int")
    want = brute(readers, TEXTS)
    for size in (10, 1 << 20):  # blocks of a document or two, and one block a task
        got = {r.doc_id: result(r) for r in alignment.align(docs.repartition(3), block_bytes=size).collect()}
        assert got == dict(enumerate(want))
    assert want[1] == want[2] == want[6] == NOTHING != want[0]


def test_repeated_rows_null_ids_and_empty_tables(spark, readers):
    rows = [(1, "same text"), (1, "same text"), (None, "other"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = sorted(((r.doc_id, *result(r)) for r in alignment.align(docs).collect()), key=str)
    want = brute(readers, [t for _, t in rows])
    assert got == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=str)
    assert alignment.align(docs.limit(0)).collect() == []
    assert alignment.tokens(docs.limit(0)).collect() == []
    assert {result(r) for r in alignment.align(docs.where("text IS NULL")).collect()} == {NOTHING}


def test_token_lists(spark, readers):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in alignment.tokens(docs.repartition(2)).collect():
        a, b = map(spans, readers(TEXTS[r.doc_id]))
        assert (r.a_ids, r.a_ends) == ([i for i, *_ in a], [e for *_, e in a])
        assert (r.b_ids, r.b_ends) == ([i for i, *_ in b], [e for *_, e in b])
        assert r.group_ends == sorted(set(r.a_ends) & set(r.b_ends))


def test_query_equals_plain_loops(spark, sf_dir, readers):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: result(r) for r in registry.queries()["op11_token_alignment"](spark, sf_dir).collect()}
    quick = [d.text for d in docs]
    want = brute(readers, quick)
    for d, w in zip(docs, want):
        assert got[d.doc_id] == w, d.doc_id
    assert len(got) == len(docs)
