"""Language-model scores from a log-frequency Bloom filter.

Counts of n-grams are quantised on a logarithmic scale of base sqrt(2); an n-gram of level q is put into
a Bloom filter once for each level 1..q. A worker reads a count back by probing levels upwards until
one is missing, so a count is never read too low, and too high only by a false hit. The filter is cut into
parts by n-gram hash; each part is built by one task from its own n-grams, and the parts are broadcast.

The filter's size follows the number of n-grams up to ``max_bits``, its proven bound. Beyond
it each part leaves its lowest levels out of the filter until the rest fits (at the corpus size where that
begins, these are n-grams seen once) and lists them exactly beside it. Different n-grams of a batch of documents that
read below the lowest level kept are then sent to their part, looked up in that list, and their levels sent
back, so no count is lost at any size. The number of parts follows the corpus, so no task holds more than some
million n-grams. Counts travel as packed arrays per worker and part, twelve bytes an n-gram.

The probability of a token after another is the count of the pair, topped up by ``prior`` imaginary tokens
that follow the single-token distribution (Dirichlet smoothing); all counts in it come from probes.

The base score needs exact counts of single tokens: the ``frequent`` most frequent ones are
broadcast, all others are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.llm.common import cut_lineage, splittable, table

ORDER = 2
BASE = math.sqrt(2.0)
MAX_BITS = 1 << 30
BITS_PER_ENTRY = 8
PROBES = 4
PART_TOKENS = 1_000_000
FREQUENT = 1 << 18
PRIOR = 50.0
# Tokens a worker gathers before it emits combined counts.
FLUSH_TOKENS = 2_000_000
# Tokens of the documents that are looked up together where the filter does not hold all n-grams.
ASK_TOKENS = 1_000_000
MAX_LEVELS = 130
END = b""


def held_out(key: Column) -> Column:
    """Rows that no counts come from: crc32 of the id as text leaves 1 when divided by 5 (null: an empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words of the text, A-Z lower-cased, then the end token."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def mixed(x):
    """A 64-bit finaliser, on numpy arrays of unsigned longs."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words, starts, order: int) -> list:
    """Hashes of the n-grams of each order that end at each token.

    ``words`` holds token hashes of several documents in a row and ``starts`` where each begins;
    n-grams that reach over the beginning see end tokens there.
    """
    import numpy as np

    place = np.arange(len(words)) - np.repeat(starts, np.diff(np.append(starts, len(words))))
    out, current = [mixed(words)], words
    for n in range(1, order):
        earlier = np.concatenate([np.zeros(n, dtype=np.uint64), words[:-n]]) if n < len(words) else np.zeros_like(words)
        earlier = np.where(place >= n, earlier, np.uint64(0))
        current = mixed(current + np.uint64(n)) ^ (earlier * np.uint64(0x9E3779B97F4A7C15))
        out.append(mixed(current))
    return out


class WordHashes(dict):
    """Token -> 64-bit hash, kept for the tokens met so far; the end token has hash 0."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word) if word else 0
        return value


def levels(counts):
    """Quantised level of counts, from 1."""
    import numpy as np

    return (np.floor(np.log(counts) / math.log(BASE) + 1e-9) + 1).astype(np.int64)


def level_values():
    """Count that each level stands for: the mean of the whole numbers with that level; 0 for level 0."""
    import numpy as np

    values = [0.0]
    for q in range(1, MAX_LEVELS):
        low, high = math.ceil(BASE ** (q - 1) - 1e-6), math.ceil(BASE**q - 1e-6) - 1
        values.append((low + max(low, high)) / 2)
    return np.array(values)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the documents, the end token (empty) included."""

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                counts.update(tokens_of(text))
            if len(counts) > 200_000:
                yield _counted(counts)
                counts = Counter()
        if counts:
            yield _counted(counts)

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(docs: DataFrame, parts: int, order: int = ORDER) -> DataFrame:
    """(part, grams, counts): counts of hashed n-grams of all orders, as packed arrays of each part.

    Counts are combined per worker; an n-gram may occur in several rows of its part.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known, words, starts = WordHashes(), [], []

        def flush():
            own = np.array(words, dtype=np.uint64)
            counted = [np.unique(grams, return_counts=True) for grams in gram_hashes(own, np.array(starts), order)]
            return packed(*(np.concatenate(x) for x in zip(*counted)), parts)

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                starts.append(len(words))
                words.extend([known[w] for w in tokens_of(text)])
                if len(words) > FLUSH_TOKENS:
                    yield flush()
                    words, starts = [], []
        if words:
            yield flush()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, PACKED)


PACKED = "part bigint, grams binary, counts binary"


def packed(grams, counts, parts: int):
    """An Arrow batch of (part, grams, counts) from arrays of hashed n-grams and their counts."""
    import numpy as np
    import pyarrow as pa

    order, present, slices = part_slices(grams, parts)
    grams, counts = grams[order].astype("<u8"), counts[order].astype("<u4")
    columns = [pa.array([a[b:e].tobytes() for b, e in slices], pa.binary()) for a in (grams, counts)]
    return pa.RecordBatch.from_arrays([pa.array(present), *columns], ["part", "grams", "counts"])


def part_slices(grams, parts: int) -> tuple:
    """An order of hashed n-grams by part, the parts there are, and the place (begin, end) of each in that order."""
    import numpy as np

    part = grams.view(np.int64) % parts  # never negative
    order = np.argsort(part, kind="stable")
    present, begin = np.unique(part[order], return_index=True)
    return order, present, list(zip(begin, np.append(begin[1:], len(part))))


def level_hash(grams, level: int):
    """First hash of n-grams at a level."""
    import numpy as np

    return mixed(grams + np.uint64(level * 0xD6E8FEB86659FD93 % 2**64))


def probe_bit(first, step, probe: int, size):
    """Bit position of one probe, in parts of ``size`` bits (below 2^32)."""
    import numpy as np

    place = first if not probe else first + np.uint64(probe) * step
    return (((place >> np.uint64(32)) * size) >> np.uint64(32)).astype(np.int64)


def next_step(first):
    import numpy as np

    return mixed(first) | np.uint64(1)


def build_filter(counts: DataFrame, parts: int, max_bits: int = MAX_BITS, fetches: int = 8) -> tuple:
    """The filter of ``build_parts`` alone."""
    return build_parts(counts, parts, max_bits, fetches)[0]


def build_parts(counts: DataFrame, parts: int, max_bits: int = MAX_BITS, fetches: int = 8) -> tuple:
    """The filter (bytes of all parts, and each part's first byte and number of bits), the lowest level that
    each part has in it, and the n-grams below as rows (part, grams, levels) of packed arrays, sorted.

    At most ``max_bits`` bits reach the driver, whatever the corpus holds, in ``fetches`` portions.
    """
    most = max(64, max_bits // parts)

    def run(key, frame):
        import numpy as np
        import pandas as pd

        grams, back = np.unique(np.frombuffer(b"".join(frame["grams"]), dtype="<u8"), return_inverse=True)
        level = levels(np.bincount(back, weights=np.frombuffer(b"".join(frame["counts"]), dtype="<u4")))
        per_level = np.bincount(level, minlength=MAX_LEVELS) * np.arange(MAX_LEVELS)
        needed = np.cumsum(per_level[::-1])[::-1] * BITS_PER_ENTRY  # bits if levels from here on are kept
        lowest = int(np.flatnonzero(needed <= most)[0])
        below = level < lowest
        rest = [grams[below].tobytes(), level[below].astype(np.uint8).tobytes()]
        grams, level = grams[~below], level[~below]
        bits = np.zeros(max(64, -(-int(needed[lowest]) // 64) * 64), dtype=bool)
        for q in range(1, int(level.max(initial=0)) + 1):
            first = level_hash(grams[level >= q], q)
            step = next_step(first)
            for probe in range(PROBES):
                bits[probe_bit(first, step, probe, np.uint64(len(bits)))] = True
        whole = [key[0], np.packbits(bits, bitorder="little").tobytes(), lowest, *rest]
        return pd.DataFrame([whole], columns=["part", "bits", "lowest", "grams", "levels"])

    import numpy as np

    built = cut_lineage(counts.groupBy("part").applyInPandas(run, "part bigint, bits binary, lowest bigint, grams binary, levels binary"))
    sizes, lowest = np.full(parts, 8, dtype=np.int64), np.zeros(parts, dtype=np.int64)
    known = built.select("part", F.octet_length("bits").alias("size"), "lowest").toArrow()
    sizes[known["part"].to_numpy()] = known["size"].to_numpy()
    lowest[known["part"].to_numpy()] = known["lowest"].to_numpy()
    first = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), dtype=np.uint8)
    for begin in range(fetches):
        portion = built.where(F.col("part") % fetches == begin).select("part", "bits").toArrow()
        for part, bits in zip(portion["part"].to_pylist(), portion["bits"]):
            data[first[part] : first[part] + sizes[part]] = np.frombuffer(bits.as_buffer(), dtype=np.uint8)
    return (data, first, sizes * 8), lowest, built.where(F.octet_length("grams") > 0).select("part", "grams", "levels")


def read_counts(grams, held: tuple):
    """Counts of different hashed n-grams, by their levels in the filter."""
    return level_values()[read_levels(grams, held)]


def read_levels(grams, held: tuple):
    """Levels of different hashed n-grams, by probing upwards until one is missing."""
    import numpy as np

    data, first, size = held
    part = grams.view(np.int64) % len(first)  # never negative
    start, bits = first[part], size[part].astype(np.uint64)
    level = np.zeros(len(grams), dtype=np.int64)
    alive = np.arange(len(grams))
    for q in range(1, MAX_LEVELS):
        first, step = level_hash(grams, q), None
        for probe in range(PROBES):
            places = probe_bit(first, step, probe, bits)
            hit = (data[start + (places >> 3)] >> (places & 7).astype(np.uint8) & 1).astype(bool)
            alive, grams, start, bits, first = (a[hit] for a in (alive, grams, start, bits, first))
            step = next_step(first) if step is None else step[hit]
        if not len(alive):
            break
        level[alive] = q
    return level


def distinct_counts(grams, held: tuple):
    """``read_counts`` where n-grams repeat."""
    import numpy as np

    different, back = np.unique(grams, return_inverse=True)
    return read_counts(different, held)[back]


def token_log10(grams: list, single, starts, held: tuple, tokens: int, distinct: int, prior: float = PRIOR):
    """log10 probability of every token, from the probed counts of its n-grams and their histories.

    ``single`` are the probed counts of the tokens themselves.
    """
    import numpy as np

    documents = read_counts(mixed(np.zeros(1, dtype=np.uint64)), held)[0]
    return smoothed_log10([single, *(distinct_counts(g, held) for g in grams[1:])], documents, starts, tokens, distinct, prior)


def smoothed_log10(counts: list, documents: float, starts, tokens: int, distinct: int, prior: float):
    """log10 probability of every token, from the counts of its n-grams of each order and of the documents."""
    import numpy as np

    value, shorter = (counts[0] + 0.5) / (tokens + 0.5 * (distinct + 1)), counts[0]
    for longer in counts[1:]:
        history = np.concatenate([[0.0], shorter[:-1]])
        history[starts] = documents
        value = (np.minimum(longer, history) + prior * value) / (history + prior)
        shorter = longer
    return np.log10(value)


class Vocabulary(dict):
    """Token -> place, with what is known of each token; a worker keeps it from batch to batch."""

    LIMIT = 400_000

    def __init__(self, top: dict[bytes, int], held: tuple | None):
        import numpy as np

        super().__init__()
        self.top, self.held, self.words = top, held, []
        self.hashes, self.exact, self.single = (np.zeros(0, dtype=t) for t in (np.uint64, np.int64, float))

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        self.words.append(word)
        return place

    def complete(self) -> None:
        """Hash, exact count (0 beyond the frequent tokens) and probed count (with a filter) of the tokens met since."""
        import numpy as np
        import xxhash

        fresh = self.words[len(self.hashes) :]
        hashes = np.array([xxhash.xxh3_64_intdigest(w) if w else 0 for w in fresh], dtype=np.uint64)
        exact = np.array([self.top.get(w, 0) for w in fresh], dtype=np.int64)
        self.hashes, self.exact = np.append(self.hashes, hashes), np.append(self.exact, exact)
        if self.held is not None:
            self.single = np.append(self.single, read_counts(mixed(hashes), self.held))


def score(docs: DataFrame, order: int = ORDER, prior: float = PRIOR, max_bits: int = MAX_BITS, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out and scores all. A null text is empty, an empty text
    is its end token. Without training rows every token is unknown. Repeated rows are scored alike, and count as
    often as they are there; other columns play no part. An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    train = rows.where(~held_out(F.col("doc_id")))
    words = cut_lineage(word_counts(train))
    found = words.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = int(found[0] or 0), int(found[1])
    parts = max(1, -(-tokens // PART_TOKENS))
    held, lowest, rest = build_parts(gram_counts(train, parts, order), parts, max_bits)
    best = words.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    top = dict(zip(best["word"].to_pylist(), best["n"].to_pylist()))
    context = docs.sparkSession.sparkContext
    held, top = context.broadcast(held), context.broadcast(top)
    if (lowest > 1).any():
        asked = _asked(rows, held, context.broadcast(lowest), top, tokens, distinct, order)
        scored = _answered(_replied(asked, rest), tokens, distinct, order, prior)
    else:
        scored = _scored(rows, held, top, tokens, distinct, order, prior)
    scored = cut_lineage(scored)
    rare = scored.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.tf").join(splittable(words), "word")
    gain = F.col("tf") * (F.log10(F.col("n") + 0.5) - math.log10(0.5))
    found = rare.groupBy("uid").agg(F.sum("tf").alias("more"), F.sum(gain).alias("gain"))
    return scored.join(found, "uid", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("gain", F.lit(0.0))).alias("base_score"), "score",
    )


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return score(table(spark, sf_dir, "documents"))


def _documents(batch, known: Vocabulary, scale: float) -> tuple:
    """Number of tokens of each document of an Arrow batch (doc_id, text), the places of all tokens in the vocabulary,
    and what the base score takes: known tokens, score with rare tokens as unknown, and these tokens listed."""
    import numpy as np
    import pyarrow as pa

    places, sizes = [], []
    for text in batch.column(1).cast(pa.binary()).to_pylist():
        words = tokens_of(text)
        sizes.append(len(words))
        places.extend(map(known.__getitem__, words))
    known.complete()
    place, size = np.array(places, dtype=np.int64), np.array(sizes, dtype=np.int64)
    starts = np.cumsum(size) - size
    exact, many = known.exact, len(known)
    base = np.add.reduceat(np.log10(exact + 0.5)[place], starts) - size * scale
    n_known = np.add.reduceat((exact > 0).astype(np.int64)[place], starts)
    # Tokens that are not among the frequent ones, once per document with their number.
    rare = np.flatnonzero(exact[place] == 0)
    row = np.repeat(np.arange(len(size)), size)[rare]
    pairs, times = np.unique(row * many + place[rare], return_counts=True)
    ends = np.searchsorted(pairs, np.arange(1, len(size) + 1) * many)
    words = pa.array([known.words[i] for i in (pairs % many).tolist()], pa.binary())
    entries = pa.StructArray.from_arrays([words, pa.array(times.astype(np.int64))], ["word", "tf"])
    listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), entries)
    return size, place, [pa.array(n_known), pa.array(base), listed]


RARE = "array<struct<word:binary,tf:bigint>>"


def _scored(rows: DataFrame, held, top, tokens: int, distinct: int, order: int, prior: float) -> DataFrame:
    """Model score, and the base score with rare tokens taken as unknown and listed beside it."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 33
        known = Vocabulary(top.value, held.value)
        scale = math.log10(tokens + 0.5 * (distinct + 1))
        for batch in batches:
            if len(known) > Vocabulary.LIMIT:
                known = Vocabulary(top.value, held.value)
            size, place, (n_known, base, listed) = _documents(batch, known, scale)
            starts = np.cumsum(size) - size
            grams = gram_hashes(known.hashes[place], starts, order)
            each = token_log10(grams, known.single[place], starts, held.value, tokens, distinct, prior)
            uids = np.arange(uid, uid + len(size))
            uid += len(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids), batch.column(0), pa.array(size), n_known, base, pa.array(np.add.reduceat(each, starts)), listed],
                ["uid", "doc_id", "n_tokens", "n_known", "base_score", "score", "rare"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"uid bigint, doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, rare {RARE}"
    return rows.mapInArrow(run, schema)


# Rows on their way between documents and parts, told apart by ``kind``.
REST, ASK, STATE = 0, 1, 2


def _asked(rows: DataFrame, held, lowest, top, tokens: int, distinct: int, order: int) -> DataFrame:
    """Documents in numbered batches, and what to ask the parts for them.

    ASK: key part, at batch, a the n-grams. STATE: key and at batch; a the place of every token's n-grams among the
    different ones, order by order, b the levels of these, c the places of those that are asked for, by part; docs.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 33
        known, least = Vocabulary(top.value, None), lowest.value
        scale = math.log10(tokens + 0.5 * (distinct + 1))
        hashes, sizes, docs = [], [], []

        def flush():
            size = np.concatenate(sizes)
            different, back, many = [], [], 0
            for grams in gram_hashes(np.concatenate(hashes), np.cumsum(size) - size, order):
                own, places = np.unique(grams, return_inverse=True)
                different.append(own)
                back.append((places + many).astype("<u4"))
                many += len(own)
            grams = np.concatenate(different)
            level = read_levels(grams, held.value)
            missing = np.flatnonzero(level < least[grams.view(np.int64) % len(least)])
            by_part, present, slices = part_slices(grams[missing], len(least))
            missing = missing[by_part]
            asked = grams[missing].astype("<u8")
            columns = [pa.concat_arrays(c) for c in zip(*docs)]
            whole = pa.StructArray.from_arrays(columns, ["doc_id", "n_tokens", "n_known", "base_score", "rare"])
            whole = pa.ListArray.from_arrays(pa.array([0, len(size)], pa.int32()), whole)
            none = pa.nulls(len(present), pa.binary())
            yield _moved(
                present, ASK, np.full(len(present), uid), pa.array([asked[b:e].tobytes() for b, e in slices], pa.binary()),
                none, none, pa.nulls(len(present), whole.type),
            )
            state = [np.concatenate(back), level.astype(np.uint8), missing.astype("<u4")]
            yield _moved(np.array([uid]), STATE, np.array([uid]), *(pa.array([x.tobytes()], pa.binary()) for x in state), whole)

        for batch in batches:
            if len(known) > Vocabulary.LIMIT:
                known = Vocabulary(top.value, None)
            size, place, columns = _documents(batch, known, scale)
            hashes.append(known.hashes[place])
            sizes.append(size)
            docs.append([batch.column(0), pa.array(size), *columns])
            if sum(map(len, hashes)) > ASK_TOKENS:
                yield from flush()
                uid += sum(map(len, sizes))
                hashes, sizes, docs = [], [], []
        if sizes:
            yield from flush()

    kind = rows.schema["doc_id"].dataType.simpleString()
    docs = f"array<struct<doc_id:{kind},n_tokens:bigint,n_known:bigint,base_score:double,rare:{RARE}>>"
    return rows.mapInArrow(run, f"key bigint, kind int, at bigint, a binary, b binary, c binary, docs {docs}")


def _replied(asked: DataFrame, rest: DataFrame) -> DataFrame:
    """The batches, and for each what its parts answer: key batch, at part, b the levels of the n-grams asked for."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        part, grams, level = None, None, None
        for batch in batches:
            kinds, keys = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            whole = batch.filter(pa.array(kinds == STATE))
            if len(whole):
                yield whole
            answers, places = [], np.flatnonzero(kinds != STATE)
            for i in places.tolist():
                own = np.frombuffer(batch.column(3)[i].as_buffer(), dtype="<u8")
                if kinds[i] == REST:
                    part, grams = keys[i], own.copy()
                    level = np.frombuffer(batch.column(4)[i].as_buffer(), dtype=np.uint8).copy()
                    continue
                if part != keys[i]:  # nothing below the lowest level
                    answers.append(bytes(len(own)))
                    continue
                found = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                answers.append(np.where(grams[found] == own, level[found], 0).astype(np.uint8).tobytes())
            told = places[kinds[places] == ASK]
            if len(told):
                none = pa.nulls(len(told), pa.binary())
                yield _moved(
                    batch.column(2).take(pa.array(told)), ASK, keys[told], none, pa.array(answers, pa.binary()), none,
                    pa.nulls(len(told), batch.column(6).type),
                )

    held = rest.select(F.col("part").alias("key"), F.lit(REST).alias("kind"), F.col("grams").alias("a"), F.col("levels").alias("b"))
    moved = asked.unionByName(held, allowMissingColumns=True).repartition("key").sortWithinPartitions("key", "kind")
    return moved.mapInArrow(run, asked.schema)


def _answered(replied: DataFrame, tokens: int, distinct: int, order: int, prior: float) -> DataFrame:
    """The rows of ``_scored``, from the batches and the answers of their parts."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        answers: list = []
        for batch in batches:
            for i, kind in enumerate(batch.column(1).to_pylist()):
                if kind == ASK:
                    answers.append(np.frombuffer(batch.column(4)[i].as_buffer(), dtype=np.uint8).copy())
                    continue
                back, level, missing = (
                    np.frombuffer(batch.column(3 + n)[i].as_buffer(), dtype=t) for n, t in enumerate(("<u4", np.uint8, "<u4"))
                )
                told = np.concatenate([np.zeros(0, dtype=np.uint8), *answers])
                if len(told) != len(missing):
                    raise ValueError(f"{len(told)} answers to {len(missing)} n-grams")
                level, answers = level.copy(), []
                level[missing] = told
                counts = np.split(level_values()[level][back], order)
                doc_id, size, n_known, base, rare = batch.column(6)[i].values.flatten()
                ends = np.cumsum(size.to_numpy())
                starts, uid = ends - size.to_numpy(), batch.column(0)[i].as_py()
                # The last token of a document is the end token, which every document has once.
                each = smoothed_log10(counts, counts[0][ends[0] - 1], starts, tokens, distinct, prior)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(uid, uid + len(size))), doc_id, size, n_known, base, pa.array(np.add.reduceat(each, starts)), rare],
                    ["uid", "doc_id", "n_tokens", "n_known", "base_score", "score", "rare"],
                )

    kind = replied.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    schema = f"uid bigint, doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, rare {RARE}"
    return replied.repartition("key").sortWithinPartitions("key", "kind", "at").mapInArrow(run, schema)


def _moved(keys, kind: int, at, a, b, c, docs):
    import numpy as np
    import pyarrow as pa

    kinds = pa.array(np.full(len(keys), kind, dtype=np.int32))
    return pa.RecordBatch.from_arrays([pa.array(keys), kinds, pa.array(at), a, b, c, docs], ["key", "kind", "at", "a", "b", "c", "docs"])


def _counted(counts):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
