"""Planted passages of every length in changing surroundings: what line dedup removes of them, and nothing else."""

import random

import pytest
from pyspark.sql import functions as F

from pricewright.llm import linededup

LENGTHS = (2, 3, 4, 5, 6, 8, 10, 15, 20)
COPIES = 120


@pytest.fixture(scope="module")
def found(spark):
    """Of every length: (planted lines removed, planted lines, copies touched, copies); and the other lines removed."""
    rng, rows, planted = random.Random(11), [], {}
    line = lambda: " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 9) for _ in range(6)) + str(rng.random())
    for k in LENGTHS:
        for _ in range(COPIES):
            passage = [line() for _ in range(k)]
            for second in (0, 1):
                before, after = ([line() for _ in range(rng.randint(5, 15))] for _ in range(2))
                planted[len(rows)] = (k, second, len(before))
                rows.append((len(rows), "\n".join(before + passage + after)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    drops = {r.doc_id: set(r.drops or ()) for r in linededup.repeated_chunks(docs).select("doc_id", F.col("drops")).collect()}
    result, others = {k: [0, 0, 0, 0] for k in LENGTHS}, 0
    for n, (k, second, at) in planted.items():
        hit = drops[n] & set(range(at, at + k)) if second else set()
        others += len(drops[n] - hit)
        if second:
            result[k] = [a + b for a, b in zip(result[k], (len(hit), k, bool(hit), 1))]
    return result, others


def test_recall_by_length(found):
    result, _ = found
    for k, (lines, of_lines, copies, of_copies) in result.items():
        least = 0.8 if k == 2 else 0.95
        assert copies >= least * of_copies and lines >= (0.8 if k == 2 else 0.9) * of_lines, (k, lines / of_lines, copies / of_copies)


def test_nothing_unique_is_removed(found):
    assert found[1] == 0


def test_one_copy_of_every_line_stays(spark):
    """Passages that overlap, repeat inside a document and are copied from copies."""
    rng = random.Random(3)
    pool = [f"line {i} of the pool" for i in range(60)]
    rows = []
    for n in range(200):
        text = []
        for _ in range(rng.randint(1, 5)):
            at = rng.randrange(55)
            text += pool[at : at + rng.randint(1, 9)] + [f"own {rng.random()}"] * rng.randint(0, 1)
        rows.append((n, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = {x for r in linededup.dedup_lines(docs).collect() for x in r.text.split("\n")}
    assert {x for _, t in rows for x in t.split("\n")} <= left


def test_shared_by_a_third_of_the_documents(spark):
    shared = "\n".join(f"license line {i}" for i in range(6))
    rows = [(n, f"own {n} a\nown {n} b\n{shared if n % 3 == 0 else n}\nown {n} c") for n in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert got[0] == rows[0][1] and all(got[n] == f"own {n} a\nown {n} b\nown {n} c" for n in range(3, 600, 3))
    assert all(got[n] == t for n, t in rows if n % 3)
