"""Best-fit packing of token pieces into sequences under several capacities at once.

A sequence holds at most ``capacity`` tokens, ``max_docs`` pieces and ``max_cost`` attention cost
(the sum of squared piece lengths). All three needs of a piece follow from its length, so the
packing is decided on the histogram of lengths, which has at most ``capacity`` rows however
large the corpus is. Lengths go from long to short; each goes to the fitting kind of sequence
whose residual tokens, pieces and cost score best:

* ``norm``: the smallest weighted norm of what stays free after the piece,
* ``dot``: the smallest weighted dot product of the piece's needs and the free capacities.

Sequences with the same contents are one kind with a count, so the steps depend on the number of
lengths, not of pieces. The plan gives each kind a range of the ranks of each length; a piece
finds its sequence and offset from its length and its rank among equal lengths. Ranks come from
counts per input partition, summed over partitions: no task sees all pieces of a length.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pricewright.llm.common import cut_lineage, splittable, table

CAPACITY = 2048
# How much free tokens, pieces and cost weigh in the score of a sequence.
WEIGHTS = (1.0, 0.2, 0.2)
END_ID = 0
SPECIAL = "<|endoftext|>"
# Texts from this many bytes on, and those that name a special token, are encoded one at a time.
ROW_BITS = 40

PIECES = (
    "doc_id bigint, block int, piece int, start bigint, length bigint, ids_crc32 bigint, local_rank bigint"
)


def encoder(vocabulary: str):
    """Text -> token ids of a byte-level BPE vocabulary (its ``.json`` file).

    The ranks of the same vocabulary are read by the faster of the two installed readers; a text
    that contains a special token's string goes to the reference reader, which gives it the
    special id. Both give the same ids elsewhere (tested).
    """
    import base64

    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public.path(vocabulary))
    with open(public.path(vocabulary.replace(".json", ".tiktoken")), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if SPECIAL in text:
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full pieces, a shorter one first."""
    first = tokens % capacity if tokens > capacity else tokens
    bounds = [(0, first)] if first else []
    return bounds + [(s, capacity) for s in range(first, tokens, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k.json", with_ids: bool = False) -> DataFrame:
    """Token pieces of every document; ``local_rank`` counts equal lengths within the input partition.

    A null text is empty, and an empty document is its end token alone. Rows that repeat or lack
    a ``doc_id`` are packed like any other.
    """

    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        encode, ranks = encoder(vocabulary), np.zeros(capacity + 1, dtype=np.int64)
        names = [f.split()[0] for f in PIECES.split(", ")] + ["ids"] * with_ids
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                for n, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + length]
                    row = [doc_id, block, n, start, length, zlib.crc32(own.tobytes()), int(ranks[length])]
                    ranks[length] += 1
                    for column, value in zip(out, [*row, own.astype(np.int64)] if with_ids else row):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(run, PIECES + ", ids array<bigint>" * with_ids)


def plan(
    histogram: dict[int, int], capacity: int = CAPACITY, max_docs: int | None = None, max_cost: int | None = None,
    rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS,
) -> list[tuple[int, list[tuple[int, int]]]]:
    """Kinds of sequences: (how many, [(length, pieces of it in one sequence), ...]).

    ``histogram`` counts the pieces of each length. A piece that fits no empty sequence is an error.
    """
    import numpy as np

    caps = np.array([capacity, max_docs or capacity, max_cost or capacity * capacity], dtype=np.int64)
    scale = np.array(weights) / caps.astype(float) ** 2
    free = np.zeros((0, 3), dtype=np.int64)
    many: list[int] = []
    contents: list[list[tuple[int, int]]] = []

    def add(count: int, left, items: list[tuple[int, int]]) -> None:
        nonlocal free
        if count:
            free = np.vstack([free, left])
            many.append(count)
            contents.append(items)

    for length in sorted(histogram, reverse=True):
        need, left_over = np.array([length, 1, length * length], dtype=np.int64), histogram[length]
        if (need > caps).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left_over:
            fits = np.flatnonzero((free >= need).all(axis=1))
            if len(fits):
                rest = free[fits] - need
                score = (rest.astype(float) ** 2 * scale).sum(1) if rule == "norm" else (free[fits] * need * scale).sum(1)
                best = int(fits[np.argmin(score)])
                room, count, items = free[best].copy(), many[best], contents[best]
                free = np.delete(free, best, axis=0)
                del many[best], contents[best]
            else:
                room, count, items = caps.copy(), left_over, []
            each = int((room // need).min())  # the tightest sequence after a piece is the same one again
            full = min(count, left_over // each)
            add(full, room - each * need, [*items, (length, each)])
            left_over -= full * each
            if full < count and left_over:
                add(1, room - left_over * need, [*items, (length, left_over)])
                count, left_over = count - 1, 0
            if items:
                add(count - full, room, items)
    return list(zip(many, contents))


def slots(kinds: list[tuple[int, list[tuple[int, int]]]]):
    """The plan as arrays sorted by (length, first rank): each row serves a range of ranks."""
    import numpy as np

    rows, served, sequence = [], {}, 0
    for count, items in kinds:
        offset = 0
        for length, each in items:
            begin = served.get(length, 0)
            rows.append((length, begin, each, sequence, offset))
            served[length] = begin + count * each
            offset += length * each
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(ranked: DataFrame, plan_slots) -> DataFrame:
    """Sequence and offset of every piece from its length and rank."""

    def run(frames: Iterator) -> Iterator:
        import numpy as np

        keys = (plan_slots[:, 0] << ROW_BITS) + plan_slots[:, 1]
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            hit = plan_slots[np.searchsorted(keys, (length << ROW_BITS) + rank, side="right") - 1]
            own = rank - hit[:, 1]
            frame["sequence_id"] = hit[:, 3] + own // hit[:, 2]
            frame["offset"] = hit[:, 4] + own % hit[:, 2] * length
            yield frame

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields)
    return ranked.mapInPandas(run, schema + ", sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, max_docs: int | None = None, max_cost: int | None = None,
    rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS,
    vocabulary: str = "byte_bpe_50k.json", with_ids: bool = False,
) -> DataFrame:
    """One row per piece with its sequence and its offset there; gapless from 0 in every sequence.

    ``vocabulary`` is a file of the installed public tokenizers. Only the histogram of lengths (at
    most ``capacity`` rows) reaches the driver. With ``with_ids`` the pieces carry their token ids.
    An empty table gives no rows.
    """
    cut_pieces = cut_lineage(pieces(docs, capacity, vocabulary, with_ids))
    counts = cut_lineage(cut_pieces.groupBy("block", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    chosen = slots(plan(histogram, capacity, max_docs, max_cost, rule, weights))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut_pieces.join(splittable(starts), ["block", "length"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    return place(ranked, chosen).drop("block", "local_rank", "before", "rank")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens.

    The score weighs all three residuals. No bound on pieces or cost is set beyond what 2048 tokens imply, as the contract
    asks for as few sequences as can be.
    """
    packed = pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
