"""Byte-level BPE as a monoid: halves are encoded on their own and joined at their boundary.

``encode(left + right)`` follows from the tokens of both halves. Tokens far from the boundary cannot change, and two
facts prove it:

* A *sure cut* is a place between two characters that no match of the splitting pattern spans, whatever stands around them
  (a letter before a space, a digit before a letter, ...). The pattern looks at nothing before its match, and at such a place
  nothing behind it, so the text falls apart there: a window from the last sure cut of the left half to the first one of the
  right half is encoded anew, and all tokens outside stay.
* Inside one long match (thousands of letters without a space) merges decide. A sequence of tokens is the encoding of
  its bytes exactly if every two neighbours are the encoding of their own bytes: the first merge across a boundary would also be
  made with those two alone. So a window is encoded anew and holds once both its edges agree with their neighbours.

Windows double until one of the two holds; a window that reaches both ends is the whole text. Decoding is the same tree with plain
concatenation. A text of up to ``segment`` code points is one task's recursion; longer ones are cut into rows, encoded apart
and joined ``FAN`` neighbours at a time, round by round, so that a long text is shared by many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.llm.common import cut_lineage, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Code points that are encoded at once, and that one row of a longer text holds.
LEAF, SEGMENT = 8192, 65536
# Neighbours joined in one round; bytes of the first window; tokens of the first window inside a match.
FAN, WINDOW, TOKENS = 8, 48, 8
# Bytes of text after which a task hands on what it has encoded.
BATCH_BYTES = 4_000_000

# Characters of which every edition of the Unicode tables says the same. The apostrophe belongs to no class: it opens contractions.
KINDS = {
    "space": r" \t\n\r",
    "letter": "A-Za-zÀ-ÖØ-öø-ƺΑ-ΡΣ-ώА-яא-תء-غぁ-ゖァ-ヺ一-龥가-힣",
    "digit": "0-9",
    "mark": r"!-&(-/:-@\[-`{-~",
}
SURE_CUT = re.compile(
    "|".join(
        f"(?<=[{KINDS[before]}])(?=[{after}])"
        for before, after in {
            "letter": KINDS["space"] + KINDS["digit"] + KINDS["mark"] + "'",
            "digit": KINDS["space"] + KINDS["letter"] + KINDS["mark"] + "'",
            "mark": KINDS["space"] + KINDS["letter"] + KINDS["digit"],
        }.items()
    )
)
OTHERS = [(re.compile(f"[{kind}]"), re.compile(f"[^{kind}]")) for name, kind in KINDS.items() if name != "space"]
# A contraction ends within this many characters of the start of a run of letters.
CONTRACTION = 3


def token_bytes(vocabulary: str) -> list[bytes]:
    """The bytes of every id of a rank file; ids without a token have none."""
    import base64

    import public_tokenizers as public

    with open(public.path(vocabulary), "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks.get(rank, b"") for rank in range(max(ranks) + 1)]


class Codec:
    """Tokens of a rank file: ``encode`` by halves, ``join`` of two encoded neighbours, their bytes."""

    def __init__(self, vocabulary: str = VOCABULARY, leaf: int = LEAF, window: int = WINDOW):
        import public_tokenizers as public
        import tiktoken

        self.token = token_bytes(vocabulary)
        ranks = {token: rank for rank, token in enumerate(self.token) if token}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.longest = max(map(len, ranks))
        self.leaf, self.window = leaf, window

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.encoding.encode_ordinary(text)
        half = len(text) // 2
        return self.join(self.encode(text[:half]), self.encode(text[half:]))

    def join_all(self, nodes: list[list[int]]) -> list[int]:
        """Neighbours joined pairwise until one is left."""
        while len(nodes) > 1:
            nodes = [self.join(*nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0] if nodes else []

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the concatenated text from the tokens of its two parts."""
        if not left or not right:
            return left or right
        reach = self.window
        while True:
            i, tail = self._tail(left, reach)
            j, head = self._head(right, reach)
            text, middle = tail + head, len(tail)
            begin, end = (0 if i == 0 else None), (len(text) if j == len(right) else None)
            for cut in SURE_CUT.finditer(text):
                if cut.start() <= middle:
                    begin = cut.start()
                if cut.start() >= middle:
                    end = cut.start()
                    break
            if begin is not None and end is not None:
                keep = self._back(left, len(tail[begin:].encode()))
                skip = self._forth(right, len(text[middle:end].encode()))
                return left[:keep] + self.encoding.encode_ordinary(text[begin:end]) + right[skip:]
            inside = self._join_inside(left, right, tail, head)
            if inside is not None:
                return inside
            reach *= 2

    def _join_inside(self, left: list[int], right: list[int], tail: str, head: str) -> list[int] | None:
        """The join within one match of letters, digits or marks that reaches far to both sides; else None."""
        for kind, other in OTHERS:
            if tail and head and kind.match(tail[-1]) and kind.match(head[0]):
                break
        else:
            return None
        stops = [m.end() for m in other.finditer(tail)]
        before = len(tail[(stops[-1] if stops else 0) + CONTRACTION :].encode())
        stop = other.search(head)
        after = len(head[: stop.start()].encode()) if stop else len(head.encode())
        if before + after <= self.longest:
            return None
        count = TOKENS
        while count < len(left) and count < len(right):
            own, its = left[-count:], right[:count]
            outer_left, outer_right = left[-count - 1], right[count]
            piece_left, piece_right = self.bytes_of(own), self.bytes_of(its)
            if len(piece_left) + len(self.token[outer_left]) > before or len(piece_right) + len(self.token[outer_right]) > after:
                return None
            found = self.encoding._encode_single_piece(piece_left + piece_right)
            if self._agree(outer_left, found[0]) and self._agree(found[-1], outer_right):
                return left[:-count] + found + right[count:]
            count *= 2
        return None

    def _agree(self, first: int, second: int) -> bool:
        return self.encoding._encode_single_piece(self.token[first] + self.token[second]) == [first, second]

    def _tail(self, ids: list[int], reach: int) -> tuple[int, str]:
        """The last tokens with at least ``reach`` bytes, and their text without a broken first character."""
        i, size = len(ids), 0
        while i and size < reach:
            i -= 1
            size += len(self.token[ids[i]])
        return i, self.bytes_of(ids[i:]).decode("utf-8", "ignore")

    def _head(self, ids: list[int], reach: int) -> tuple[int, str]:
        j, size = 0, 0
        while j < len(ids) and size < reach:
            size += len(self.token[ids[j]])
            j += 1
        return j, self.bytes_of(ids[:j]).decode("utf-8", "ignore")

    def _back(self, ids: list[int], size: int) -> int:
        """Number of tokens before the last ``size`` bytes; a sure cut is a token boundary."""
        i = len(ids)
        while size > 0:
            i -= 1
            size -= len(self.token[ids[i]])
        if size:
            raise AssertionError("a sure cut inside a token")
        return i

    def _forth(self, ids: list[int], size: int) -> int:
        j = 0
        while size > 0:
            size -= len(self.token[ids[j]])
            j += 1
        if size:
            raise AssertionError("a sure cut inside a token")
        return j


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, leaf: int = LEAF, segment: int = SEGMENT, window: int = WINDOW) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text; special tokens do not exist.

    A null text is empty and an empty text has no ids. Rows that repeat or lack a ``doc_id`` are encoded like any other;
    other columns are not carried. An empty table gives no rows.
    """
    slim = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    short = slim.where(F.length("text") <= segment).mapInArrow(_encoder(vocabulary, leaf, window, []), "doc_id bigint, ids array<int>")
    # Equal rows are encoded once; what is left is known by its id and the digest of its text.
    long = slim.where(F.length("text") > segment).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    cut = long.select("doc_id", F.sha2("text", 256).alias("digest"), "copies", "text").mapInArrow(
        _segments(segment), "doc_id bigint, digest string, copies bigint, node bigint, nodes bigint, text string"
    )
    kept = ["digest string", "copies bigint", "node bigint", "nodes bigint"]
    schema = ", ".join(["doc_id bigint", *kept, "ids array<int>"])
    nodes = cut_lineage(cut.repartition("digest", "node").mapInArrow(_encoder(vocabulary, leaf, window, kept), schema))
    widest = nodes.agg(F.max("nodes").alias("n")).first()["n"] or 0
    while widest > 1:
        level = nodes.withColumns({"place": F.col("node"), "node": F.expr(f"node div {FAN}")})
        nodes = level.groupBy("doc_id", "digest", "node").applyInArrow(_joiner(vocabulary, window), schema)
        widest = -(-widest // FAN)
    whole = nodes.select("doc_id", "ids", F.expr("explode(sequence(1L, copies))")).select("doc_id", "ids")
    return short.unionByName(whole)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, leaf: int = LEAF) -> DataFrame:
    """The rows with ``decoded``, the bytes of ``ids``; null ids decode to nothing."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tokens = pa.array(token_bytes(vocabulary), pa.large_binary())
        for batch in batches:
            decoded = decode_lists(tokens, batch.column(batch.schema.get_field_index("ids")), leaf)
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, schema + ", decoded binary")


def decode_lists(tokens, ids, leaf: int):
    """Arrow lists of ids -> their bytes: leaves of ``leaf`` ids first, then ``FAN`` neighbours at a time up to one per row."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    bounds = np.asarray(ids.offsets, dtype=np.int64)
    nodes, width = tokens.take(ids.values), leaf
    while True:
        sizes = np.diff(bounds)
        above = np.maximum(-(-sizes // width), 1)  # an empty row is one empty node
        ends = np.concatenate([[0], np.cumsum(above)])
        row = np.repeat(np.arange(len(sizes)), above)
        cuts = bounds[row] + (np.arange(ends[-1]) - ends[row]) * width
        lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, bounds[-1]), pa.int32()), nodes)
        nodes, bounds, width = pc.binary_join(lists, pa.scalar(b"", nodes.type)), ends, FAN
        if len(nodes) == len(sizes):
            return nodes.cast(pa.binary())


def _encoder(vocabulary: str, leaf: int, window: int, kept: list[str]):
    """Rows (doc_id, kept columns, text) -> (doc_id, kept columns, ids)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = Codec(vocabulary, leaf, window)
        names = ["doc_id", *[c.split()[0] for c in kept], "ids"]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            begin = 0
            while begin < batch.num_rows:
                end, size, found = begin, 0, []
                while end < batch.num_rows and size < BATCH_BYTES:
                    text = texts[end].as_py()
                    size, end = size + len(text), end + 1
                    found.append(codec.encode(text))
                own = [batch.column(n).slice(begin, end - begin) for n in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*own, _column(found)], names)
                begin = end

    return run


def _column(rows: list[list[int]]):
    """Lists of ids as an Arrow column."""
    from itertools import chain

    import numpy as np
    import pyarrow as pa

    bounds = np.cumsum([0, *map(len, rows)])
    values = np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=bounds[-1])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


def _lists(column) -> list[list[int]]:
    """Rows of an Arrow list column of whole numbers; a null is empty."""
    import numpy as np

    values, bounds = np.asarray(column.values).tolist(), np.asarray(column.offsets).tolist()
    return [values[i:j] for i, j in zip(bounds, bounds[1:])]


def _segments(segment: int):
    """Rows (doc_id, digest, copies, text) -> one row per segment of the text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["doc_id", "digest", "copies", "node", "nodes", "text"]
        for batch in batches:
            for n in range(batch.num_rows):
                doc_id, digest, copies, text = (batch.column(c)[n].as_py() for c in range(4))
                parts = [text[i : i + segment] for i in range(0, len(text), segment)]
                columns = [[doc_id] * len(parts), [digest] * len(parts), [copies] * len(parts)]
                columns += [list(range(len(parts))), [len(parts)] * len(parts)]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(parts, pa.string())], names)

    return run


def _joiner(vocabulary: str, window: int):
    """Neighbouring nodes of one text -> the node above them."""

    def run(nodes):
        import pyarrow as pa

        nodes = nodes.sort_by("place")
        ids = Codec(vocabulary, window=window).join_all(_lists(nodes.column("ids").combine_chunks()))
        first = nodes.slice(0, 1).select(["doc_id", "digest", "copies", "node", "nodes"])
        return first.append_column("ids", pa.array([ids], pa.list_(pa.int32())))

    return run


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the multilingual ranks and decoded again."""
    encoded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
