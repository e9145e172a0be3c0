"""What each method promises, on small inputs."""

import math
import random
import string
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from pricewright.llm import chat, lm, mixing, quality, secrets, toxicity


def test_random_tokens_pass_and_words_fail(spark):
    rng = random.Random(11)
    alnum = string.ascii_letters + string.digits
    keys = ["".join(rng.choices(alnum, k=40)) for _ in range(60)] + ["".join(rng.choices("0123456789abcdef", k=31)) for _ in range(60)]
    plain = ["".join(rng.choice(["the", "and", "ing", "tion"]) for _ in range(12)) + str(i) for i in range(120)]
    docs = spark.createDataFrame([(i, f"before {k} after") for i, k in enumerate(keys + plain)], "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in secrets.scan(docs).collect()}
    found = sum(len(got[i]) == 1 and (got[i][0].start, got[i][0].stop) == (7, 7 + len(k)) for i, k in enumerate(keys))
    wrong = sum(len(got[len(keys) + i]) for i in range(len(plain)))
    assert found >= 0.9 * len(keys) and wrong <= 0.1 * found


def test_random_tokens_behind_a_name_and_without_a_digit(spark):
    rng = random.Random(5)
    alnum = string.ascii_letters + string.digits
    keys = ["".join(rng.choices(alnum, k=40)) for _ in range(240)]
    bare = [k for k in ("".join(rng.choices(alnum, k=20)) for _ in range(4000)) if not any(c.isdigit() for c in k)][:60]
    forms = ["client_key={}", "export AWS_ACCESS={}\nexport B=2", "https://x.org/a?id=7&sig={}&v=1", "auth={}=="]
    rows = [(forms[i % 4], k) for i, k in enumerate(keys)] + [("before {} after", k) for k in bare]
    docs = spark.createDataFrame([(i, form.format(k)) for i, (form, k) in enumerate(rows)], "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in secrets.scan(docs).collect()}
    found = [0] * 5
    for i, (form, key) in enumerate(rows):
        start, stop = form.index("{"), form.index("{") + len(key) + 2 * form.endswith("==")
        found[i % 4 if i < len(keys) else 4] += [(s.start, s.stop) for s in got[i]] == [(start, stop)]
    assert all(n >= 0.9 * 60 for n in found), found


def test_p_values_are_uniform_for_random_tokens(spark):
    rng = random.Random(7)
    rows = [("".join(rng.choices("0123456789abcdef", k=64)),) for _ in range(400)]
    p = spark.createDataFrame(rows, "t string").select(secrets.randomness(F.col("t"), F.lit("hex")).alias("p")).collect()
    share = [sum(r.p < x for r in p) / len(p) for x in (0.1, 0.25, 0.5, 0.75)]
    assert all(abs(a - b) < 0.08 for a, b in zip(share, (0.1, 0.25, 0.5, 0.75)))


def test_prefix_sums(spark):
    rows = [(list(range(n)),) for n in (0, 1, 63, 64, 65, 200)]
    got = spark.createDataFrame(rows, "a array<bigint>").select("a", secrets.prefix_sums(F.col("a")).alias("s")).collect()
    for r in got:
        assert list(r.s or []) == [sum(r.a[:i]) for i in range(len(r.a))]


def test_counts_come_back_from_the_filter(spark):
    rng = np.random.default_rng(3)
    grams = rng.integers(-(2**63), 2**63 - 1, 20_000)
    counts = np.unique(rng.zipf(1.3, 20_000).clip(1, 10**9))[rng.integers(0, 50, 20_000)]
    half = len(grams) // 2
    batches = [lm.packed(grams.view(np.uint64)[s], counts[s], 7).to_pylist() for s in (slice(0, half), slice(half, None))]
    rows = spark.createDataFrame([(r["part"], r["grams"], r["counts"]) for b in batches for r in b], lm.PACKED)
    held = lm.build_filter(rows, 7)
    back = lm.read_counts(grams.view(np.uint64), held)
    level = lm.levels(counts.astype(float))
    exact = back == lm.level_values()[level]
    assert (back >= lm.level_values()[level]).all() and exact.mean() > 0.95
    absent = lm.read_counts(rng.integers(-(2**63), 2**63 - 1, 20_000).view(np.uint64), held)
    assert (absent > 0).mean() < 0.05
    small = lm.build_filter(rows, 7, max_bits=7 * 100_000)
    assert len(small[0]) * 8 <= 7 * 100_000 + 7 * 64
    pruned = lm.read_counts(grams.view(np.uint64), small)
    kept = pruned >= lm.level_values()[level]
    assert kept[counts == counts.max()].all() and not kept.all()


def test_a_small_filter_loses_no_counts(spark, sf_dir):
    """What the filter does not hold is looked up in the parts: with next to no filter every count is exact."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").repartition(3)
    rows = [(r.doc_id, lm.tokens_of((r.text or "").encode())) for r in docs.collect()]
    single, pairs = Counter(), Counter()
    for key, words in rows:
        if brute.crc(key) % 5 != 1:
            single.update(words)
            pairs.update(zip([b"", *words], words))
    tokens, distinct = sum(single.values()), len(single)
    read = lambda n: lm.level_values()[lm.levels(np.array([float(n)]))][0] if n else 0.0
    one, two = ({k: read(n) for k, n in c.items()} for c in (single, pairs))

    def log10(earlier, word):
        history = one.get(earlier, 0.0)
        value = (one.get(word, 0.0) + 0.5) / (tokens + 0.5 * (distinct + 1))
        return math.log10((min(two.get((earlier, word), 0.0), history) + lm.PRIOR * value) / (history + lm.PRIOR))

    want = {key: sum(log10(*pair) for pair in zip([b"", *words], words)) for key, words in rows}
    exact, some, whole = ({r.doc_id: r for r in lm.score(docs, max_bits=bits).collect()} for bits in (64, 20_000, lm.MAX_BITS))
    assert exact.keys() == want.keys() and all(math.isclose(r.score, want[k], rel_tol=1e-9) for k, r in exact.items())
    for got in (some, whole):  # a false hit reads a count too high
        assert sum(abs(r.score - want[k]) for k, r in got.items()) <= 0.01 * abs(sum(want.values()))
    assert all(r[:-1] == exact[k][:-1] == some[k][:-1] for k, r in whole.items())


def test_levels_keep_small_counts():
    values = lm.level_values()
    assert [values[q] for q in lm.levels(np.array([1.0, 2.0, 3.0, 4.0]))] == [1.0, 2.0, 3.0, 4.5]


def test_ngram_hashes_stop_at_documents():
    words = np.array([5, 6, 7, 5, 6], dtype=np.uint64)
    grams = lm.gram_hashes(words, np.array([0, 3]), 3)
    assert grams[1][1] == grams[1][4] and grams[1][0] == grams[1][3] and grams[2][1] == grams[2][4] and grams[1][3] != grams[1][2]


@pytest.mark.parametrize(
    "text, word",
    [("Tr4sh", "trash"), ("1d10t", "idiot"), ("ѕсum", "scum"), ("ＳＣＵＭ", "scum"), ("sc​um", "scum"), ("stup1d!!", "stupid"), ("m0r0n.", "moron"), ("l0$er", "loser")],
)
def test_folding(text, word):
    assert toxicity.fold(f"so {text} it is") == f" so {word} it is "


def test_numbers_stay_numbers():
    assert toxicity.fold("call 1357 or 455 now") == " call or now "


def test_stems_words_and_exceptions():
    machine = toxicity.automaton({"trash": 2.0, "achl*": 1.0})
    assert toxicity.matched(toxicity.fold("Trash trash, the trash can and trashy achlichen Achl"), machine) == (6.0, 4)
    assert toxicity.matched(" no ", machine) == (0, 0)


def test_water_filling_equals_resharing(spark):
    rng = random.Random(2)
    for _ in range(3):
        rows = [(i, rng.choice("abcdefg"), " ".join("w" * rng.choice([0, 1, 5, 400 if i % 9 == 0 else 3]))) for i in range(60)]
        rows.append((99, None, "x y z"))
        got = {r.doc_id: r for r in mixing.mix_plan(spark.createDataFrame(rows, "doc_id bigint, source string, text string")).collect()}
        want = brute.mixing([(i, s, t) for i, s, t in rows])
        for n, (i, _, _) in enumerate(rows):
            size, source_size, target, passes, _ = want[n]
            assert (got[i].size, got[i].source_size, got[i].passes) == (size, source_size, passes)
            assert math.isclose(got[i].target, target, rel_tol=1e-9)


@pytest.mark.parametrize("schedule", [*mixing.SCHEDULES, [(0.0, 0.0), (0.5, 4.0), (1.0, 0.0)], [(0.0, 2.0), (0.25, 0.0), (1.0, 3.0)]])
def test_positions_invert_the_demand(spark, schedule):
    def delivered(t):
        total = 0.0
        for (t0, a), (t1, b) in zip(schedule, schedule[1:]):
            end = min(t, t1)
            if end > t0:
                total += (end - t0) * (a + (a + (b - a) * (end - t0) / (t1 - t0))) / 2
        return total / mixing.area(schedule)

    shares = [i / 50 for i in range(51)]
    rows = spark.createDataFrame([(s,) for s in shares], "s double").select("s", mixing.time_of(schedule, F.col("s")).alias("t")).collect()
    assert all(abs(delivered(r.t) - r.s) < 1e-9 and 0 <= r.t <= 1 for r in rows)


def test_mix_is_ordered_by_position(spark, sf_dir):
    """Early in training the fading source takes more than its share, late the growing one does."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    mix = [(r.source, len(r.text.split())) for r in mixing.mix(docs).collect()]
    half = len(mix) // 2
    share = lambda part, s: sum(n for x, n in part if x == s) / sum(n for _, n in part)
    assert share(mix[:half], "a") > share(mix[half:], "a") and share(mix[:half], "b") < share(mix[half:], "b")


def test_js_distance(spark):
    rows = [([1, 2, 3], [2, 4, 6]), ([1, 0], [0, 5]), ([3, 1], [1, 3]), ([0, 0], [1, 1])]
    frame = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = [r.d for r in frame.select(quality.js_distance(F.col("a"), F.col("b")).alias("d")).collect()]
    assert all(math.isclose(g, brute.js_distance(*r), abs_tol=1e-9) for g, r in zip(got, rows)) and got[1] == 1.0


PARTS = [*"ab&#\\<>/: \n", "### ", "</turn>", "&lt;", "&amp;", "é", "\U0001f600"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@settings(max_examples=15, deadline=None)
@given(turns=st.lists(st.tuples(st.one_of(st.just("assistant"), TEXT), TEXT), max_size=6))
def test_formatting_is_reversible(spark, turns):
    frame = spark.createDataFrame([(turns,)], "turns array<struct<role:string,text:string>>")
    row = frame.select(chat.format_turns(F.col("turns")).alias("f")).select("f.*", chat.read_turns(F.col("f.formatted")).alias("back")).first()
    assert [tuple(t) for t in row.back] == turns
    learned = [chat_unescape(row.formatted[s.start : s.stop]) for s in row.loss]
    assert learned == [t for r, t in turns if r == "assistant"]


def chat_unescape(text):
    for plain, coded in reversed(chat.TEXT_ESCAPES):
        text = text.replace(coded, plain)
    return text


def test_junk_does_not_judge_itself(spark):
    """A language of its own that holds only junk, one with a few clean documents among junk, and a clean one."""
    import random

    import brute
    from pricewright.llm import quality

    rng = random.Random(8)
    symbols = lambda: " ".join("".join(rng.choice("#$%&*+/<=>@0123456789") for _ in range(rng.randint(2, 9))) for _ in range(160))
    salad = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(160))
    words = "the of and to in is that for it was on with".split()
    prose = lambda: " ".join(rng.choice(words) if rng.random() < 0.17 else "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(160)) + "."
    made = [("xx", symbols) for _ in range(30)] + [("es", salad) for _ in range(30)] + [("en", prose) for _ in range(30)]
    made += [("de", symbols) for _ in range(30)]
    docs = [(n, make(), lang) for n, (lang, make) in enumerate(made)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.kept for r in quality.quality(frame).collect()}
    assert [got[n] for n, *_ in docs] == brute.quality_kept(docs)
    kept = {lang: sum(got[n] for n, _, own in docs if own == lang) for lang in ("xx", "es", "en", "de")}
    assert kept == {"xx": 0, "es": 0, "en": 30, "de": 0}
