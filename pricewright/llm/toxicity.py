"""Toxicity by a weighted lexicon.

Texts are folded first: compatibility forms are resolved, letters of other scripts that look Latin become
Latin, invisible characters go, and inside words digits and signs that stand for letters become
those letters. The folded words, single-spaced, run through one Aho-Corasick automaton that holds the lexicon
and the exception phrases; a lexicon term inside an exception phrase does not count.

A term is a word, or a stem that begins words (``achl*``), so inflected forms count together. The lexicon is
learned from all labelled training rows: per term the labelled documents that hold it are counted by label, and
terms that go with the toxic label beyond ``min_z`` standard errors enter with their log-odds as weight, at
most ``max_terms`` of them (that bounds what is broadcast), and none that begins, or begins with, a stronger one. A document's density is the
weight of its matches over a power of its length, so one term in a long text counts less than in a short one. A logistic curve over the density, fitted on at most ``fit_rows`` training rows (those with the
smallest digests of their ids), gives the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.llm.common import cut_lineage, splittable, table

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = str.maketrans(
    "абвгеёзикмнопрстухѕіјԁԛԝһӏαβγεηικνορτυχω",
    "abbreeзukmhonpctyxsijdqwhlabyenikvoptuxw".replace("з", "e"),
)
# Digits and signs that stand for letters inside words.
SUBSTITUTES = str.maketrans("01345789@$!|+€", "oieastbgasiite")
# Phrases in which a lexicon term is harmless.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "clownfish", "scum line", "pond scum", "sore loser")
STEMS = (5, 7)
LENGTH_POWER = 0.75
MIN_Z = 4.0
MIN_DOCS = 3
MAX_TERMS = 2000
FIT_ROWS = 20_000
RIDGE = 0.01

# Characters that print nothing (soft hyphen, zero-width and direction marks).
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]")
_SIGNS = re.compile("[0-9@$!|+€]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_ASCII_LETTERS = "".join(chr(i) if chr(i).isalpha() else " " for i in range(128))
_OTHER_SCRIPTS = re.compile("[\u0370-\u052f]")
_EDGES = re.compile(r"^[^\w@$|+€]+|\W+$")


def training(key: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text leaves no 0 when divided by 5."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 != 0


def _unmask(token: str) -> str:
    """A token without edge signs, its inner digits and signs as letters if it has a letter at all."""
    core = _EDGES.sub("", token)
    return core.translate(SUBSTITUTES) if any(c.isalpha() for c in core) else token


def fold(text: str) -> str:
    """The folded words of a text, with a space before and after each."""
    text = text.lower()
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text).lower())
        if _OTHER_SCRIPTS.search(text):
            text = text.translate(HOMOGLYPHS)
    if _SIGNS.search(text):
        text = " ".join(_unmask(t) if _SIGNS.search(t) else t for t in text.split())
    text = text.translate(_ASCII_LETTERS) if text.isascii() else _NOT_LETTERS.sub(" ", text)
    return f" {' '.join(text.split())} "


def terms_of(folded: str) -> set[str]:
    """The different words of a folded text and their stems, those marked with a star."""
    words = set(folded.split())
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def automaton(weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
    """Aho-Corasick automaton over padded terms; an exception has no weight."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term, weight in weights.items():
        padded = f" {term[:-1]}" if term.endswith("*") else f" {term} "
        machine.add_word(padded, (len(padded), weight))
    for phrase in exceptions:
        folded = fold(phrase)
        machine.add_word(folded, (len(folded), None))
    machine.make_automaton()
    return machine


def matched(folded: str, machine) -> tuple[float, int]:
    """Sum of the weights of the terms found outside exception phrases, and their number."""
    hits, covered = [], []
    for end, (length, weight) in machine.iter(folded):
        (covered if weight is None else hits).append((end - length + 1, end, weight))
    if covered:
        hits = [h for h in hits if not any(begin <= h[0] and h[1] <= end for begin, end, _ in covered)]
    return math.fsum(w for _, _, w in hits), len(hits)


def labelled_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(word, toxic, clean): labelled training documents that hold the term, by label; word "" counts documents.

    What moves to the labels are the different folded words of each document, not its text. Labels may be as many as
    documents, so the join is a merge join at every size.
    """
    known = labels.where("toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = docs.where(training(F.col("doc_id"))).select("doc_id", F.col("text").cast("string").alias("text"))

    def words(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            different = [" ".join(set(fold(t or "").split())) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(different, pa.string())], ["doc_id", "words"])

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            words = list({**counts[0], **counts[1]})
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *[pa.array([c[w] for w in words], pa.int64()) for c in (counts[1], counts[0])]],
                ["word", "toxic", "clean"],
            )

        for batch in batches:
            for listed, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic != 0].update({"", *terms_of(listed)})
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield flush()
                counts = (Counter(), Counter())
        if counts[0] or counts[1]:
            yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    listed = rows.mapInArrow(words, f"doc_id {kind}, words string")
    joined = listed.join(known.hint("merge"), "doc_id").select("words", "toxic")
    found = joined.mapInArrow(run, "word string, toxic bigint, clean bigint")
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(docs: DataFrame, labels: DataFrame, min_z: float = MIN_Z, min_docs: int = MIN_DOCS, max_terms: int = MAX_TERMS) -> dict[str, float]:
    """Word -> weight, from all labelled training rows."""
    words = cut_lineage(labelled_words(docs, labels))
    whole = words.where("word = ''").first()
    if whole is None:
        return {}
    toxic, clean = F.col("toxic"), F.col("clean")
    odds = F.log((toxic + 0.5) / (whole["toxic"] - toxic + 0.5)) - F.log((clean + 0.5) / (whole["clean"] - clean + 0.5))
    error = F.sqrt(1 / (toxic + 0.5) + 1 / (whole["toxic"] - toxic + 0.5) + 1 / (clean + 0.5) + 1 / (whole["clean"] - clean + 0.5))
    chosen = (
        words.where((F.col("word") != "") & (toxic >= min_docs))
        .select("word", odds.alias("weight"), (odds / error).alias("z"))
        .where(F.col("z") >= min_z)
        .orderBy(F.desc("z"), F.col("word").endswith("*").desc(), F.length("word").desc(), "word")
        .limit(8 * max_terms)
    )
    lexicon: dict[str, float] = {}
    beginnings: set[str] = set()
    for row in chosen.collect():
        plain = row.word.rstrip("*")
        begun = {plain[:n] for n in range(1, len(plain) + 1)}
        covered = any(b + "*" in lexicon for b in begun) or plain in beginnings
        if not covered and len(lexicon) < max_terms:
            lexicon[row.word] = row.weight
            beginnings |= begun
    return lexicon


def densities(docs: DataFrame, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    """(doc_id, density, hits) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((weights, exceptions))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        machine = automaton(*shared.value)
        for batch in batches:
            density, hits = [], []
            for text in batch.column(1).to_pylist():
                folded = fold(text or "")
                weight, n = matched(folded, machine) if len(machine) else (0.0, 0)
                density.append(weight / max(1, folded.count(" ") - 1) ** LENGTH_POWER)
                hits.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(density, pa.float64()), pa.array(hits, pa.int64())], ["doc_id", "density", "hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, density double, hits bigint")


def fit_curve(sample: list[tuple[float, int]], ridge: float = RIDGE, steps: int = 50) -> tuple[float, float]:
    """Intercept and slope of a logistic curve with a small ridge on the slope, by Newton's method."""
    import numpy as np

    x, y = np.array([s[0] for s in sample]), np.array([float(s[1]) for s in sample])
    if not len(y) or y.min() == y.max():
        return (math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0)
    design, weights = np.column_stack([np.ones_like(x), x]), np.zeros(2)
    penalty = np.diag([1e-6, ridge])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - penalty @ weights
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, slope)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def toxicity(
    docs: DataFrame, labels: DataFrame, min_z: float = MIN_Z, max_terms: int = MAX_TERMS, fit_rows: int = FIT_ROWS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, hits.

    A null text is empty. Labels that are null, or belong to no document, are not used; without usable labels
    every score is one half. Repeated rows are scored alike; other columns play no part. An empty table gives no rows.
    """
    weights = learn_lexicon(docs, labels, min_z, max_terms=max_terms)
    scored = cut_lineage(densities(docs, weights, exceptions))
    known = labels.where("toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    learned = scored.where(training(F.col("doc_id"))).join(splittable(known), "doc_id")
    digest = F.xxhash64(F.col("doc_id").cast("string"))
    sampled = learned.orderBy(digest, "density", "toxic").limit(fit_rows).select("density", "toxic")
    sample = [(r.density, int(r.toxic != 0)) for r in sampled.collect()]
    intercept, slope = fit_curve(sample)
    value = 1 / (1 + F.exp(-(F.lit(intercept) + F.lit(slope) * F.col("density"))))
    return scored.withColumn("score", value).select(
        "doc_id", (~training(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
