"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both vocabularies encode a text; each token has the bytes up to its end. Everything on tokens is Arrow: lists are flattened
with their parents, byte ends are cumulative sums less their document's start, and a hash join of both sides
on (document, end) gives all ends and says which are shared. Shared ends cut a text into groups. Between two
neighbouring ends one token of each side covers the bytes, so the ends of either side are the *links*: the pairs of
tokens whose bytes overlap.

How often two ids are linked is a corpus-wide count. Tasks work on *blocks* of whole documents with a bounded number of links and
group them by pair (``Table.group_by``); Spark adds the blocks' counts, finds the highest of every B id (as many rows as the
vocabulary has ids, which bounds what is broadcast) and gives every block the counts of its own pairs. Documents and pairs of a
block meet in a task of their own, so neither a table of all pairs nor all links of a pair come together anywhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.llm.common import splittable, table
from pricewright.session import ensure_checkpoint_dir

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
# Bytes of text that are aligned at a time, and that one block holds; a longer document is one by itself.
CHUNK_BYTES, BLOCK_BYTES = 1_000_000, 8_000_000
# Ids of B are below this; a pair is one number a * B_IDS + b.
B_IDS = 1 << 16

TOKENS = "doc_id bigint, a_ids array<int>, a_ends array<bigint>, b_ids array<int>, b_ends array<bigint>, group_ends array<bigint>"
STAGED = (
    "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "doc_pairs binary, doc_links binary, pair bigint, links bigint"
)
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


class Readers:
    """Both vocabularies: ids of a text and the bytes of every id."""

    def __init__(self, a: str = VOCABULARY_A, b: str = VOCABULARY_B):
        import base64

        import numpy as np
        import public_tokenizers as public
        import sentencepiece
        import tiktoken

        with open(public.path(a), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public.path(b))
        self.a_size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.a_size[rank] = len(token)
        self.b_bytes = [self._piece(n) for n in range(self.b.get_piece_size())]
        self.b_size = np.array([len(p) for p in self.b_bytes], dtype=np.int64)

    def _piece(self, n: int) -> bytes:
        piece = self.b.id_to_piece(n)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(n) else piece.replace("▁", " ").encode()

    def read(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides; none for an empty text and one whose bytes B does not give back."""
        if not text:
            return [], []
        b = self.b.encode(text)
        whole = " " + text
        if b"".join(map(self.b_bytes.__getitem__, b)) != whole.encode():
            return [], []
        return self.a.encode_ordinary(whole), b


class Aligned:
    """The tokens of some documents as Arrow columns, all in the order of documents and places.

    ``ends`` has one row per link: document, end, ``a`` and ``b`` (flat numbers of the tokens), ``shared``.
    """

    def __init__(self, readers: Readers, texts: list[str | None]):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        read = [readers.read(t) for t in texts]
        self.a = pa.array([a for a, _ in read], pa.list_(pa.int32()))
        self.b = pa.array([b for _, b in read], pa.list_(pa.int32()))
        self.a_ids, self.b_ids = pc.list_flatten(self.a), pc.list_flatten(self.b)
        sides = []
        for lists, ids, sizes in ((self.a, self.a_ids, readers.a_size), (self.b, self.b_ids, readers.b_size)):
            parents = pc.list_parent_indices(lists)
            run = pc.cumulative_sum(pc.take(pa.array(sizes), ids))
            # Bytes before a document: the running sum at the token before its first one.
            first = lists.offsets.slice(0, len(lists))
            before = pc.fill_null(pc.take(run, pc.if_else(pc.greater(first, 0), pc.subtract(first, 1), None)), 0)
            ends = pc.subtract(run, pc.take(before, parents))
            sides.append(pa.table({"doc": parents, "end": ends, "at": pa.array(np.arange(len(ids), dtype=np.int64))}))
        joined = sides[0].join(sides[1], ["doc", "end"], join_type="full outer", right_suffix="_b", use_threads=False)
        joined = joined.sort_by([("doc", "ascending"), ("end", "ascending")])
        is_a, is_b = pc.is_valid(joined["at"]), pc.is_valid(joined["at_b"])
        # The token that covers the bytes before an end: as many tokens of its side have ended before.
        number = lambda ended: pc.subtract(pc.cumulative_sum(ended.cast(pa.int64())), ended.cast(pa.int64()))
        self.ends = pa.table({
            "doc": joined["doc"], "end": joined["end"], "a": number(is_a), "b": number(is_b), "shared": pc.and_(is_a, is_b),
        }).combine_chunks()
        self.a_ends, self.b_ends = sides[0]["end"].combine_chunks(), sides[1]["end"].combine_chunks()

    def pairs(self):
        """One number per link: the ids of its two tokens."""
        import pyarrow.compute as pc

        a, b = pc.take(self.a_ids, self.ends["a"]), pc.take(self.b_ids, self.ends["b"])
        return pc.add(pc.multiply(a.cast("int64"), B_IDS), b.cast("int64"))

    def listed(self):
        """Of every document ``a1,a2|b1;a3|b2,b3``: the ids of its groups; empty without tokens."""
        import pyarrow as pa
        import pyarrow.compute as pc

        shared = self.ends.filter(self.ends["shared"])
        sides = []
        for ids, last in ((self.a_ids, shared["a"]), (self.b_ids, shared["b"])):
            cuts = pa.concat_arrays([pa.array([0], pa.int32()), pc.add(last.combine_chunks(), 1).cast(pa.int32())])
            sides.append(pc.binary_join(pa.ListArray.from_arrays(cuts, ids.cast(pa.string())), ","))
        groups = pc.binary_join_element_wise(*sides, "|")
        return pc.binary_join(pa.ListArray.from_arrays(_offsets(_per_doc(shared["doc"], len(self.a))), groups), ";")


def tokens(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """The aligned tokens of every whole text: ids and byte ends of both sides, and the shared ends.

    Bytes count from the space that goes before the text. A null or empty text, and one that B does not give back byte by byte,
    has empty lists. Rows that repeat or lack a ``doc_id`` are documents like any other; an empty table gives no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        readers = Readers(vocabulary_a, vocabulary_b)
        for ids, texts in _chunks(batches, CHUNK_BYTES):
            own = Aligned(readers, texts)
            shared = own.ends.filter(own.ends["shared"])
            counts = _per_doc(shared["doc"], len(texts))
            cuts = pa.ListArray.from_arrays(_offsets(counts), shared["end"].combine_chunks())
            columns = [
                pa.array(ids, pa.int64()), own.a, pa.ListArray.from_arrays(own.a.offsets, own.a_ends),
                own.b, pa.ListArray.from_arrays(own.b.offsets, own.b_ends), cuts,
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in TOKENS.split(", ")])

    return _slim(docs).mapInArrow(run, TOKENS)


def align(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document the tokens, groups and links, and what the corpus says of its links.

    ``n_best`` counts the links whose pair is the most frequent one of its B id, ``count_sum`` adds the corpus-wide counts of all
    links. Documents without tokens (see ``tokens``) have zeros and an empty digest. The staged blocks stay in the shared
    checkpoint folder, as the result reads them.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    # Documents and counts of a block are written once: a task done again cannot number the pairs of a block anew.
    staged = _slim(docs).mapInArrow(_stage(vocabulary_a, vocabulary_b, block_bytes), STAGED)
    staged.write.option("compression", "zstd").parquet(folder)
    pairs = spark.read.schema(STAGED).parquet(folder).where("pair IS NOT NULL").select("block", "pair", "links")
    counts = pairs.groupBy("pair").agg(F.sum("links").alias("count"))
    b_id = (F.col("pair") % B_IDS).alias("b")
    # One row per B id: bounded by the vocabulary.
    best = counts.groupBy(b_id).agg(F.max("count").alias("most"))
    judged = counts.join(F.broadcast(best), F.col("pair") % B_IDS == F.col("b")).select(
        "pair", F.when(F.col("count") == F.col("most"), -F.col("count")).otherwise(F.col("count")).alias("count")
    )
    own = pairs.select("block", "pair").join(splittable(judged), "pair")
    listed = spark.read.schema(STAGED).parquet(folder).where("pair IS NULL").drop("pair", "links")
    return listed.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(_score, RESULT)


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _chunks(batches: Iterator, size: int) -> Iterator[tuple[list, list]]:
    """(ids, texts) of rows with up to ``size`` characters together; a longer text comes alone."""
    for batch in batches:
        texts, begin = batch.column(1), 0
        while begin < batch.num_rows:
            own, chars, end = [], 0, begin
            while end < batch.num_rows and (not own or chars < size):
                own.append(texts[end].as_py())
                chars, end = chars + len(own[-1] or ""), end + 1
            yield batch.column(0).slice(begin, end - begin).to_pylist(), own
            begin = end


def _per_doc(docs, many: int):
    import numpy as np

    return np.bincount(np.asarray(docs, dtype=np.int64), minlength=many)


def _offsets(counts):
    import numpy as np
    import pyarrow as pa

    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def _stage(vocabulary_a: str, vocabulary_b: str, block_bytes: int):
    """Documents -> rows of documents and rows of the pairs of each block.

    ``doc_pairs`` are the pairs of a document by their place in the block's sorted pairs, each as the step
    from the one before, and ``doc_links`` how many links each has.
    """

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        readers = Readers(vocabulary_a, vocabulary_b)
        schema = _arrow_schema(STAGED)
        block, size, kept = TaskContext.get().partitionId() << 32, 0, []

        def flush():
            """The rows of the block: its pairs, then its documents."""
            every = pa.concat_tables([pairs for _, _, pairs in kept])
            sums = every.group_by("pair", use_threads=False).aggregate([("links", "sum")]).sort_by("pair")
            names = np.asarray(sums["pair"])
            yield _rows(schema, block=[block] * len(names), pair=sums["pair"], links=sums["links_sum"])
            for ids, columns, pairs in kept:
                place = np.searchsorted(names, np.asarray(pairs["pair"])).astype("<u4")
                links, docs = np.asarray(pairs["links"]).astype("<u4"), np.asarray(pairs["doc"])
                bounds = np.searchsorted(docs, np.arange(len(ids) + 1))
                steps = np.diff(place, prepend=place[:1])
                steps[bounds[:-1][bounds[:-1] < len(place)]] = place[bounds[:-1][bounds[:-1] < len(place)]]
                cut = lambda column: [column[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]  # noqa: E731, B023
                yield _rows(schema, block=[block] * len(ids), doc_id=ids, **columns, doc_pairs=cut(steps), doc_links=cut(links))

        for ids, texts in _chunks(batches, CHUNK_BYTES):
            own = Aligned(readers, texts)
            many = len(texts)
            pairs = pa.table({"doc": own.ends["doc"], "pair": own.pairs()})
            pairs = pairs.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "links"])
            pairs = pairs.sort_by([("doc", "ascending"), ("pair", "ascending")])
            columns = {
                "n_a": pc.list_value_length(own.a), "n_b": pc.list_value_length(own.b),
                "n_groups": _per_doc(own.ends["doc"].filter(own.ends["shared"]), many), "n_links": _per_doc(own.ends["doc"], many),
                "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in own.listed().to_pylist()],
            }
            kept.append((ids, columns, pairs))
            size += sum(len(t) for t in texts if t)
            if size >= block_bytes:
                yield from flush()
                block, size, kept = block + 1, 0, []
        if kept:
            yield from flush()

    return run


def _arrow_schema(ddl: str):
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _rows(schema, **columns):
    """A batch with the given columns, nulls in the others."""
    import pyarrow as pa

    many = len(next(iter(columns.values())))
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(many, field.type))
        elif isinstance(values, pa.ChunkedArray):
            arrays.append(values.combine_chunks().cast(field.type))
        else:
            arrays.append(values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _score(docs, pairs):
    """Documents and judged pairs of one block -> the result; a best pair has its count below zero."""
    import numpy as np
    import pyarrow as pa

    pairs = pairs.sort_by("pair")
    judged = np.asarray(pairs["count"])
    counts, is_best = np.abs(judged), judged < 0
    best, sums = [], []
    for steps, links in zip(docs["doc_pairs"].to_pylist(), docs["doc_links"].to_pylist()):
        place = np.cumsum(np.frombuffer(steps, "<u4"), dtype=np.int64)
        links = np.frombuffer(links, "<u4").astype(np.int64)
        best.append(int(links[is_best[place]].sum()))
        sums.append(int((links * counts[place]).sum()))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    out = out.append_column("n_best", pa.array(best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))
    return out.select([c.split()[0] for c in RESULT.split(", ")])


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned between the byte-level and the piece vocabulary."""
    return align(table(spark, sf_dir, "documents"))
