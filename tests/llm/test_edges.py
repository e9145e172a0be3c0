"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib

import pytest
from pyspark.sql import Row, functions as F

import brute
from pricewright.llm import chat, exact, linededup, lm, mixing, packing, quality, secrets, simhash, toxicity

LONG = "\n".join(f"line {i % 700} of a very long text with secret = abcdef{i % 13}" for i in range(30_000))
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "n int, row string, hash string, size string, spans string, words string, fold string, p string, kept string, score string"
)


@pytest.fixture(scope="module")
def docs(spark):
    """Two repeated rows, null ids, texts, languages and sources, a long text, and names that operators use inside."""
    own = [
        (1, "Alpha beta gamma\ndelta epsilon\nzeta eta theta\niota kappa\n", "en", "a"),
        (1, "Alpha beta gamma\ndelta epsilon\nzeta eta theta\niota kappa\n", "en", "a"),
        (2, None, None, None), (3, "", "en", None), (None, "ALPHA beta gamma\ndelta epsilon\nzeta eta theta\niota kappa\n", None, "b"),
        (None, None, "xx", "b"), (4, LONG, "en", "a"), (5, " \n\t\n ", "de", ""), (6, "é\U0001f600 Ünïcode\x00 wörd", "fr", "a"),
    ]
    extra = (7, "r", "h", "s", "sp", "w", "f", "p", "k", "sc")
    return spark.createDataFrame([(*r, 0, *extra) for r in own], SCHEMA).repartition(3).cache()


def ids(rows):
    return sorted((r.doc_id for r in rows), key=str)


ALL_IDS = sorted([1, 1, 2, 3, None, None, 4, 5, 6], key=str)


def test_simhash(docs):
    got = simhash.near_duplicates(docs).collect()
    assert ids(got) == ALL_IDS
    assert {r.component_id for r in got if r.fp == 0} == {2}
    assert {r.component_id for r in got if r.doc_id in (1, None) and r.fp != 0} == {1}


def test_quality(docs):
    got = quality.quality(docs).collect()
    assert ids(got) == ALL_IDS
    for r in got:
        text = next(d.text for d in docs.collect() if d.doc_id == r.doc_id and r.doc_id is not None) if r.doc_id is not None else None
        if text is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_quality(text)
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (2, 3, 5))
    assert quality.keep_clean(docs).columns == docs.columns


def test_exact(docs):
    for keep, of_alpha in (("largest", 1), ("smallest", 1)):
        got = exact.exact_duplicates(docs, keep).collect()
        assert ids(got) == ALL_IDS
        alpha = [r for r in got if r.text_sha256 == hashlib.sha256(b"alpha beta gamma\ndelta epsilon\nzeta eta theta\niota kappa\n").hexdigest()]
        assert len(alpha) == 3 and {r.keep_id for r in alpha} == {of_alpha} and [r.kept for r in alpha].count(True) == 1
        empty = [r for r in got if r.doc_id in (2, 3)]
        assert {(r.group_size, r.keep_id) for r in empty} == {(3, 3 if keep == "largest" else 2)}
        assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_exact_hot_group(spark):
    """A third of all rows share a text; runs split it and the result is whole."""
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same text").otherwise(F.concat(F.lit("same text"), F.col("id").cast("string"))).alias("text")
    )
    runs = exact.runs(exact.content(rows)).where("content = 'same text'")
    assert runs.count() > 100
    got = exact.exact_duplicates(rows).where("group_size > 1").collect()
    assert len(got) == 1000 and {(r.keep_id, r.group_size) for r in got} == {(0, 1000)}


def test_secrets(docs):
    got = secrets.scan(docs).collect()
    assert ids(got) == ALL_IDS
    assert next(len(r.spans) for r in got if r.doc_id == 4) == sum(i % 13 >= 10 for i in range(30_000))  # values of eight characters
    many = next(r.spans for r in secrets.scan(docs.where("doc_id = 4").withColumn("text", F.replace("text", F.lit("abcdef"), F.lit("abcdefgh")))).collect())
    assert len(many) == 30_000
    text = LONG.replace("abcdef", "abcdefgh")
    assert all(text[s.start : s.stop].startswith("secret = abcdefgh") for s in many[::997])


def test_lm(docs):
    got = lm.score(docs).collect()
    assert ids(got) == ALL_IDS
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 5)} == {1}
    assert all(r.score < 0 and r.base_score < 0 for r in got)
    only = lm.score(docs.where("doc_id IS NULL AND doc_id IS NOT NULL")).collect()
    assert only == []
    unseen = lm.score(docs.where("doc_id = 4")).collect()  # crc32 of "4" leaves another remainder
    assert len(unseen) == 1


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, None), (None, 1, 1), (4, 0, 0), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert ids(got) == ALL_IDS and all(0 <= r.score <= 1 for r in got)
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_mixing(docs):
    got = mixing.mix_plan(docs).collect()
    assert ids(got) == ALL_IDS
    assert all(r.taken <= 3 * r.size and r.taken == r.size * r.passes for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_plan(docs.repartition(2)).collect()))
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r.passes for r in got)


def test_line_dedup(docs):
    clean = linededup.dedup_lines(docs)
    assert clean.columns == docs.columns
    rows = docs.select("doc_id", "text").collect()
    want = brute.line_dedup([(r.doc_id, r.text) for r in rows])
    got = sorted(((r.doc_id, r.text) for r in clean.collect()), key=str)
    assert got == sorted(((r.doc_id, t) for r, (t, _) in zip(rows, want)), key=str)


def test_packing(docs):
    got = packing.pack(docs).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, 6, None}


@pytest.mark.parametrize(
    "run",
    [
        simhash.near_duplicates, quality.quality, quality.keep_clean, exact.exact_duplicates, secrets.scan, lm.score, mixing.mix_plan,
        mixing.mix, linededup.dedup_lines, packing.pack,
    ],
    ids=lambda f: f.__name__,
)
def test_empty_tables(docs, run):
    assert run(docs.limit(0)).count() == 0


def test_empty_table_toxicity(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_chat_rows(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", None), (1, 0, "user", None), (2, None, None, "x"), (2, 5, "tool: a\n", "</turn>\n### user:\n&lt;"),
        (None, 0, "user", "q"), (None, 1, "assistant", "a" * 100_000), (3, 0, "assistant", ""), (4, 0, "user", "hi"), (4, 1, "assistant", "yo"),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    records = chat.canonical_turns(chat.conversation_records(frame))
    got = {
        r.conv_id: r
        for r in records.select("conv_id", "turns", chat.format_turns(F.col("turns")).alias("f"))
        .select("conv_id", "turns", "f.*", chat.read_turns(F.col("f.formatted")).alias("back")).collect()
    }
    assert all(r.back == r.turns for r in got.values())
    assert [tuple(t) for t in got[1].turns] == [("user", ""), ("user", ""), ("assistant", "b")]
    assert [tuple(t) for t in got[2].turns] == [("", "x"), ("tool: a\n", "</turn>\n### user:\n&lt;")]
    assert len(got[None].turns) == 2 and got[4].formatted == "### user:\nhi</turn>\n### assistant:\nyo</turn>\n"
    for r in got.values():
        assert "".join(r.formatted[s.start : s.stop] for s in r.loss) == "".join(t.text for t in r.turns if t.role == "assistant")
    assert chat.canonical_turns(chat.conversation_records(frame.limit(0))).count() == 0


LAYOUTS = [
    ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}', [("user", "q"), ("assistant", "a")]),
    ('{"messages":[]}', []),
    ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":null}]}', [("user", "q"), ("assistant", "")]),
    ('{"prompt":"q","completion":"a"}', [("user", "q"), ("assistant", "a")]),
    ('{"system":"s","prompt":"q","response":"a"}', [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ('{"instruction":"do","input":"this","output":"a"}', [("user", "do\n\nthis"), ("assistant", "a")]),
    ('{"instruction":"do","input":"","output":"a"}', [("user", "do"), ("assistant", "a")]),
    ('{"output":"a","instruction":"do"}', [("user", "do"), ("assistant", "a")]),
    ('{"prompt":"q","completion":"a","score":1.5}', None), ('{"other":{"deep":[{"a b":1}]}}', None), (None, None), ('[1]', None),
]


def test_chat_layouts(spark):
    frame = spark.createDataFrame([(i, j, "t") for i, (j, _) in enumerate(LAYOUTS)], "id int, json string, turns_left string")
    got = chat.canonical_turns(frame.withColumn("record", F.parse_json("json"))).collect()
    for r in got:
        want = LAYOUTS[r.id][1]
        assert (None if r.turns is None else [tuple(t) for t in r.turns]) == want, LAYOUTS[r.id]
    assert chat.shape_of(("m[].a", "m[].b c", "n")) == "OBJECT<m: ARRAY<OBJECT<a, `b c`>>, n>"
