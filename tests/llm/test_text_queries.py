"""Queries on whole tables against SQL or brute force."""

import math
from collections import Counter, defaultdict

import pytest

import brute
from check_oracle import compare, connect
from pricewright.llm import registry


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    ok, note, _ = compare(spark, connect(sf_dir), name, registry.queries()[name], registry.oracle_sql()[name], sf_dir)
    assert ok, note


def test_quality_equals_brute_force(spark, sf_dir, docs):
    got = {r.doc_id: r for r in registry.queries()["op2_quality_rules"](spark, sf_dir).collect()}
    kept = brute.quality_kept([(r.doc_id, r.text, r.lang) for r in docs])
    for row, keep in zip(docs, kept):
        r = got[row.doc_id]
        own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert own == brute.base_quality(row.text) and r.kept == keep
    assert any(kept) and not all(kept) and len(got) == len(docs)


def test_line_dedup_equals_brute_force(spark, sf_dir, docs):
    import hashlib

    want = brute.line_dedup([(r.doc_id, r.text) for r in docs])
    got = {r.doc_id: r for r in registry.queries()["op10_line_dedup"](spark, sf_dir).collect()}
    for row, (text, drops) in zip(docs, want):
        r = got[row.doc_id]
        listed = [range(int(a), int(b) + 1) for a, b in (x.split("-") for x in r.removed.split(",") if x)]
        assert [i for x in listed for i in x] == drops and all(a.stop < b.start for a, b in zip(listed, listed[1:]))
        assert r.removed_lines == len(drops) and r.n_lines == row.text.count("\n") + 1
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert any(drops for _, drops in want)


def test_secret_base_equals_brute_force(spark, sf_dir, docs):
    import hashlib
    import re

    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    got = {r.doc_id: r for r in registry.queries()["op4_secret_scan"](spark, sf_dir).collect()}
    for row in docs:
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(row.text) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", row.text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", row.text) if len(m[0]) >= 32]
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        r, many = got[row.doc_id], Counter(k for _, k, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (many[0], many[1], many[2])
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_lm_base_is_exact_and_the_model_beats_it(spark, sf_dir, docs):
    tokens = lambda text: [*(text or "").encode().lower().split(), b""]
    counts = Counter()
    for r in docs:
        if brute.crc(r.doc_id) % 5 != 1:
            counts.update(tokens(r.text))
    whole, distinct = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in registry.queries()["op5_lm_score"](spark, sf_dir).collect()}
    model, base = defaultdict(float), defaultdict(float)
    for row in docs:
        own, r = tokens(row.text), got[row.doc_id]
        want = sum(math.log10((counts[w] + 0.5) / (whole + 0.5 * (distinct + 1))) for w in own)
        assert math.isclose(r.base_score, want, rel_tol=1e-12)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (brute.crc(row.doc_id) % 5 == 1, len(own), whole)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        model[r.held_out] += r.score
        base[r.held_out] += r.base_score
    assert model[True] > base[True] and model[False] > base[False]


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in registry.queries()["op7_toxicity"](spark, sf_dir).collect()}
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if brute.crc(r.doc_id) % 5 == 0]
    assert all(got[r.doc_id].held_out and 0 <= got[r.doc_id].score <= 1 for r in labels)
    right = sum(got[r.doc_id].predicted == r.toxic for r in labels)
    found = [got[r.doc_id].predicted for r in labels if r.toxic]
    assert right >= 0.93 * len(labels) and sum(found) >= 0.6 * len(found)
    assert all(r.predicted == (r.score >= 0.5) for r in got.values())


def test_pipeline_equals_brute_force(spark, sf_dir, docs):
    """Every stage against its plain version, on what the stage before left."""
    import corpus_pipeline
    from test_simhash import brute_classes, brute_fingerprint
    from test_packing import check_sequences, reference_ids

    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs]
    expect = [row for row, keep in zip(rows, brute.quality_kept([r[:3] for r in rows])) if keep]
    assert 0 < len(expect) < len(rows)
    cut = [(i, t, lang, s) for (i, _, lang, s), (t, _) in zip(expect, brute.line_dedup([r[:2] for r in expect]))]
    classes = brute_classes(sorted((i, brute_fingerprint(t)) for i, t, _, _ in cut), 3)
    single = [r for r in cut if classes[r[0]] == r[0]]
    passes = brute.mixing([(i, s, t) for i, t, _, s in single])
    mixed = [row for n, row in enumerate(single) for _ in range(passes[n][3])]
    for name, want in zip(stages, (expect, cut, single, mixed)):
        frame = stages[name](spark, frame, sf_dir)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        found = frame.collect()
        assert sorted((r.doc_id, r.text, r.lang, r.source) for r in found) == sorted(want), name
        frame = spark.createDataFrame(found, frame.schema)
    packed = stages["packing"](spark, frame, sf_dir).collect()
    assert sum(r.length for r in packed) == sum(len(reference_ids(t)) + 1 for _, t, _, _ in mixed)
    check_sequences(packed)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole.collect()) == sorted(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed
    )


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries())
    assert [name.split("_")[0] for name in registry.queries()] == [*(f"op{n}" for n in range(1, 14)), "pipeline"]
