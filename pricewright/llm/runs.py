"""Periodic runs of words, found with string synchronising sets.

A run is a maximal stretch of words with smallest period q and at least three periods. At each scale t (1, 2, 4, ...) the runs with
2t <= q < 4t are found from a few anchors:

* every window of t words has a hash. Position i is an anchor if the smallest hash among the windows at i .. i + t is the one at
  i or the one at i + t. Whether i is an anchor depends on the words i .. i + 2t alone, so equal contexts of 2t words are anchored alike;
* windows that lie in a run of period at most t / 3 are left out of the choice, else a stretch of one repeated word would
  be all anchors. Those *highly periodic* windows come from the runs of smaller scales; period 1 is found directly;
* of any 2t neighbouring windows that are not all highly periodic, one in the first t positions is an anchor. A run of
  period q >= 2t therefore has an anchor within its first q words, and the same anchor again q words later with an equal context. Pairs of
  anchors with equal contexts at a distance of 2t to 4t propose all runs of the scale. Contexts are not highly periodic, so
  one recurs at most 12 times within 4t words.

A proposed pair is extended to both sides by the hashes of 2^k words, and every reported run is compared word by word; should a hash have
failed, the documents are done again with another one. Documents of a batch form one array with a word of its own behind each, longest
first, so a scale works on the documents that are long enough for it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.llm.common import SPACE, table

# A reported run has at least so many words and periods.
MIN_WORDS, MIN_PERIODS = 24, 3
# Words that a task works on at a time, whole documents at least.
BATCH_WORDS = 400_000
# A context that is not highly periodic recurs at most so often within the widest distance of its scale.
RECURS = 12

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Hash:
    """Hashes of the windows of 2^k words, for every k that some document is long enough for."""

    def __init__(self, words, lengths, seed: int):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.factors = rng.integers(1 << 32, 1 << 63, 3, dtype=np.uint64) | np.uint64(1)
        ends = np.cumsum(lengths + 1)
        self.levels = [self._mix(words.astype(np.uint64), np.uint64(0))]
        while (longer := np.flatnonzero(lengths >= 2 << len(self.levels) - 1)).size:
            size, half = int(ends[longer[-1]]), 1 << len(self.levels) - 1
            below = self.levels[-1]
            second = below[half : size + half]
            if len(second) < size:  # windows that leave the array: no run reaches them
                second = np.concatenate([second, np.arange(size - len(second), dtype=np.uint64)])
            self.levels.append(self._mix(below[:size], second))

    def _mix(self, first, second):
        import numpy as np

        mixed = first * self.factors[0] + (second ^ (second >> np.uint64(29))) * self.factors[1]
        return (mixed ^ (mixed >> np.uint64(32))) * self.factors[2]

    def extend(self, left, right):
        """How far the words before, and from, both positions on are equal."""
        import numpy as np

        ahead, back = np.zeros(len(left), dtype=np.int64), np.zeros(len(left), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            at = right + ahead
            can = np.flatnonzero(at < len(level))
            same = can[level[left[can] + ahead[can]] == level[at[can]]]
            ahead[same] += step
            low, high = left - back - step, right - back - step
            can = np.flatnonzero((low >= 0) & (high < len(level)))
            same = can[level[low[can]] == level[high[can]]]
            back[same] += step
        return back, ahead


def anchors(level, periodic, scale: int):
    """Positions whose window hash, or the one ``scale`` later, is the smallest of the ``scale + 1`` windows there."""
    import numpy as np

    nothing = np.uint64(0xFFFFFFFFFFFFFFFF)
    chosen = np.where(periodic[: len(level)], nothing, level)
    least, width = chosen, 1
    while width < scale:  # scale is a power of two
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if len(least) < 2:
        return np.zeros(0, dtype=np.int64)
    least = np.minimum(least[:-1], least[1:])
    first, last = chosen[: len(least)], chosen[scale : scale + len(least)]
    return np.flatnonzero((least != nothing) & ((least == first) | (least == last)))


def pairs(positions, contexts, shortest: int, longest: int):
    """(position, distance) of anchors with equal contexts at a distance of shortest <= d < longest."""
    import numpy as np

    order = np.argsort(contexts, kind="stable")  # equal contexts stay in the order of their positions
    positions, contexts = positions[order], contexts[order]
    found, here = [], np.arange(len(positions))
    for lag in range(1, RECURS + 1):
        here = here[here + lag < len(positions)]
        gap = positions[here + lag] - positions[here]
        near = (contexts[here + lag] == contexts[here]) & (gap < longest)
        here, gap = here[near], gap[near]
        if not len(here):
            break
        found.append(np.stack([positions[here], gap])[:, gap >= shortest])
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)


def find_runs(words, lengths, seed: int = 0):
    """Maximal stretches with at least ``MIN_PERIODS`` smallest periods: rows (start, length, period).

    ``words`` are numbers: the documents one after the other, longest first, each followed by a number that occurs once;
    ``lengths`` are theirs, in words.
    """
    import numpy as np

    hashed = Hash(words, lengths, seed)
    ends = np.cumsum(lengths + 1)
    equal = np.flatnonzero(np.diff(np.concatenate([[False], words[1:] == words[:-1], [False]]).astype(np.int8)))
    begins, stops = equal[::2], equal[1::2] + 1  # period 1
    known = np.stack([begins, stops - begins, np.ones_like(begins)])
    known = known[:, known[1] >= MIN_PERIODS]
    scale, k = 1, 0
    # The shortest run of the scale has 3 * 2t words.
    while (longer := np.flatnonzero(lengths >= 2 * MIN_PERIODS * scale)).size:
        size = int(ends[longer[-1]])
        level, context = hashed.levels[k][:size], hashed.levels[k + 1][:size]
        small = known[:, (3 * known[2] <= scale) & (known[1] >= scale) & (known[0] < size)]
        marks = np.zeros(size + 1, dtype=np.int64)
        np.add.at(marks, small[0], 1)
        np.add.at(marks, np.minimum(small[0] + small[1] - scale + 1, size), -1)
        periodic = np.cumsum(marks)[:size] > 0
        at = anchors(level, periodic, scale)
        at = at[at < len(context)]
        left, period = pairs(at, context[at], 2 * scale, 4 * scale)
        if len(left):
            back, ahead = hashed.extend(left, left + period)
            new = np.stack([left - back, back + ahead + period, period])
            new = np.unique(new[:, new[1] >= MIN_PERIODS * period], axis=1)
            # A stretch that is known has a smaller period, which divides this one.
            had = {*zip(known[0].tolist(), known[1].tolist())}
            fresh = [n for n, key in enumerate(zip(new[0].tolist(), new[1].tolist())) if key not in had]
            known = np.concatenate([known, new[:, fresh]], axis=1)
        scale, k = 2 * scale, k + 1
    return known.T


def holds(words, start: int, length: int, period: int) -> bool:
    """Whether the words say so themselves: the period holds within and at neither side beyond."""
    end = start + length
    if (words[start + period : end] != words[start : end - period]).any():
        return False
    return (start == 0 or words[start - 1] != words[start - 1 + period]) and words[end] != words[end - period]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The reported runs (start, length, period) of each list of words, by start and period."""
    from collections import defaultdict
    from itertools import count

    import numpy as np

    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((n for n, t in enumerate(texts) if len(t) >= MIN_WORDS), key=lambda n: -len(texts[n]))
    if not order:
        return found
    number = defaultdict(count(1).__next__)
    lengths = np.array([len(texts[n]) for n in order], dtype=np.int64)
    ends = np.cumsum(lengths + 1)
    words = np.empty(int(ends[-1]), dtype=np.int64)
    for n, end, length in zip(order, ends.tolist(), lengths.tolist()):
        words[end - 1 - length : end - 1] = np.fromiter(map(number.__getitem__, texts[n]), dtype=np.int64, count=length)
    words[ends - 1] = -np.arange(1, len(order) + 1)
    for seed in count():
        rows = find_runs(words, lengths, seed)
        rows = rows[rows[:, 1] >= MIN_WORDS]
        if all(holds(words, *row) for row in rows.tolist()):
            break
    which = np.searchsorted(ends, rows[:, 0], side="right")
    for n, (start, length, period) in zip(which.tolist(), rows.tolist()):
        found[order[n]].append((start - int(ends[n] - 1 - lengths[n]), length, period))
    for own in found:
        own.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of every run only the first period."""
    if not runs:
        return b" ".join(words)
    kept = bytearray(b"\x01") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return b" ".join(w for w, keep in zip(words, kept) if keep)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of every whole text by start and period, and the text with one period of each.

    A null text has no words. Rows that repeat or lack a ``doc_id`` are documents like any other; other columns are not carried.
    An empty table gives no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            texts, begin = batch.column(1).cast(pa.binary()), 0
            while begin < batch.num_rows:
                end, size, own = begin, 0, []
                while end < batch.num_rows and size < BATCH_WORDS:
                    own.append((texts[end].as_py() or b"").split())
                    size, end = size + len(own[-1]), end + 1
                found = runs_of(own)
                rows = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
                rest = [collapse(words, runs) for words, runs in zip(own, found)]
                columns = [batch.column(0).slice(begin, end - begin), pa.array(rows, kind), pa.array(rest, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])
                begin = end

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(run, f"doc_id bigint, runs {RUNS}, collapsed string")


def repeat_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of one document in ten the words from a place on are replaced by repeats of those there.

    With h the crc32 of the id and g = h div 10, words i >= a = g mod n become word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    A null id is the empty text here, whose crc32 is 0.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("h"))
    found = chosen.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumns(
        {"n": F.size("words").cast("bigint"), "g": F.expr("h div 10")}
    )
    found = found.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    found = found.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("transform(sequence(0L, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))])")
    text = F.when(F.col("a").isNotNull(), F.concat_ws(" ", repeated)).otherwise(F.col("text"))
    return found.select("doc_id", text.alias("text"))


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, one in ten with a repeated tail: the runs, the one with most periods, the collapsed text.

    Quotients of two whole numbers below 2^26 differ as doubles whenever they differ.
    """
    found = periodic_runs(repeat_tails(table(spark, sf_dir, "documents")))
    ranked = F.transform(
        "runs", lambda r: F.struct((r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("start"), (-r["period"]).alias("period"), r["length"].alias("length"))
    )
    best = F.array_max(ranked)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
