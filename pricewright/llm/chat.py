"""Chat formatting: records of any known layout to canonical turns, and turns to one training text.

A record is a variant. The nested paths of its fields, written as its schema without the types of values, are
hashed to its fingerprint; a table of declarative mappings, keyed by fingerprint, says where the
turns are: in an array (path, role field, text field, and names for roles), or in fields of the record, each with
a fixed role. Records with an unknown fingerprint give no turns and are reported as such. Fields beyond the mapping
(ids, scores) are part of the fingerprint, so a mapping names the whole layout it is for.

The template writes a turn as ``### role:``, a newline, the text and ``</turn>`` with a newline. Inside
roles and texts ``&`` becomes ``&amp;``, then ``</turn>`` becomes ``&lt;/turn>`` and ``### `` becomes
``&num;## `` (in roles also ``:`` and newlines), which is undone in the opposite order, so every text comes back
exactly and no text can pose as a control string. The loss mask is a list of spans over the formatted
text: the texts of the assistant.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.llm.common import table
from pricewright.llm.linededup import let
from pricewright.llm.secrets import prefix_sums

TURN = "struct<role:string,text:string>"
END = "</turn>\n"
ASSISTANT = "assistant"
TEXT_ESCAPES = [("&", "&amp;"), ("</turn>", "&lt;/turn>"), ("### ", "&num;## ")]
ROLE_ESCAPES = [*TEXT_ESCAPES, (":", "&colon;"), ("\n", "&newline;")]


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are.

    ``paths`` are all field paths of the layout. Either ``turns`` names an array whose items have a
    ``role`` and a ``text`` field (``names`` translates roles), or ``fields`` lists (role, fields): the
    texts of the fields that are not empty, joined by a blank line, make a turn.
    """

    paths: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    names: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def fingerprints(self) -> list[str]:
        """That of the layout, and of the layout with an empty array of turns."""
        shapes = [shape_of(self.paths)]
        if self.turns is not None:
            others = [p for p in self.paths if not p.startswith(f"{self.turns}[]")]
            shapes.append(shape_of((*others, f"{self.turns}[]")))
        return [hashlib.sha256(s.encode()).hexdigest() for s in shapes]


def shape_of(paths: tuple[str, ...]) -> str:
    """Field paths as a schema without types: ``m[].a`` becomes ``OBJECT<m: ARRAY<OBJECT<a>>>``."""
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def render(node: dict) -> str:
        fields = []
        for name in sorted(node):
            plain, inner = name.removesuffix("[]"), render(node[name]) if node[name] else ""
            shown = plain if re.fullmatch(r"[A-Za-z_]\w*", plain) else f"`{plain}`"
            if name.endswith("[]"):
                inner = f"ARRAY<{inner}>"
            fields.append(f"{shown}: {inner}" if inner else shown)
        return f"OBJECT<{', '.join(fields)}>"

    return render(tree)


MAPPINGS = (
    Mapping(("messages[].content", "messages[].role"), turns="messages"),
    Mapping(
        ("conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value",
        names=(("human", "user"), ("gpt", "assistant")),
    ),
    Mapping(("completion", "prompt"), fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping(("prompt", "response", "system"), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("input", "instruction", "output"), fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(("instruction", "output"), fields=(("user", ("instruction",)), ("assistant", ("output",)))),
)


def shape(record: Column) -> Column:
    """Nested field paths of a variant: its schema (fields by name) with the types of values left out."""
    value = r"[A-Z][A-Z_0-9]*(\(\d+, ?\d+\))?"
    plain = F.regexp_replace(F.schema_of_variant(record), f": {value}(?=[,>])", "")
    return F.regexp_replace(plain, f"<{value}>", "<>")


def fingerprint(record: Column) -> Column:
    return F.sha2(shape(record).cast("binary"), 256)


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS, record: str = "record") -> DataFrame:
    """The records with a column ``turns`` (role, text) and their ``fingerprint``.

    Null texts and roles become empty. An unknown layout, a null record and a record without turns have no
    turns (null, null and empty). Other columns stay. An empty table gives no rows.
    """
    known = {print_: m for m in mappings for print_ in m.fingerprints}

    def turns(kind: Column) -> Column:
        chosen = F.lit(None).cast(f"array<{TURN}>")
        for print_, mapping in known.items():
            chosen = F.when(kind == print_, _mapped(F.col(record), mapping)).otherwise(chosen)
        return chosen

    printed = records.withColumn("fingerprint", F.when(F.col(record).isNotNull(), fingerprint(F.col(record))))
    return printed.withColumn("turns", turns(F.col("fingerprint")))


def escaped(text: Column, rules: list[tuple[str, str]] = TEXT_ESCAPES) -> Column:
    for plain, coded in rules:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescaped(text: Column, rules: list[tuple[str, str]] = TEXT_ESCAPES) -> Column:
    for plain, coded in reversed(rules):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_turns(turns: Column) -> Column:
    """struct(formatted, loss): the training text, and the spans (start, stop) of assistant texts in code points."""
    head = lambda t: F.concat(F.lit("### "), escaped(t["role"], ROLE_ESCAPES), F.lit(":\n"))
    parts = F.transform(
        turns,
        lambda t: F.struct(
            head(t).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("learned")
        ),
    )

    def joined(x: Column) -> Column:
        before = prefix_sums(F.transform(x, lambda p: (F.length(p["head"]) + F.length(p["body"]) + len(END)).cast("long")))
        spans = F.zip_with(
            x, before,
            lambda p, b: F.when(p["learned"], F.struct((b + F.length(p["head"])).alias("start"), (b + F.length(p["head"]) + F.length(p["body"])).alias("stop"))),
        )
        return F.struct(
            F.array_join(F.transform(x, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
            F.when(F.size(x) == 0, F.array().cast("array<struct<start:bigint,stop:bigint>>"))
            .otherwise(F.filter(spans, lambda s: s.isNotNull())).alias("loss"),
        )

    return let(parts, joined)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as they were."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: let(
            F.instr(p, ":\n"),
            lambda at: F.struct(
                unescaped(F.substring(p, F.lit(5), at - 5), ROLE_ESCAPES).alias("role"),
                unescaped(F.substring(p, at + 2, F.length(p))).alias("text"),
            ),
        ),
    )


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): conversations as records, each in the shortest layout that holds its turns.

    A prompt and its answer, those after a system text, or a list of messages. Rows go by turn; rows
    that share a turn go by role and text, null turns come first. Null texts and roles are empty. The
    rows of a conversation meet in one row, as they have to for one training text.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = F.struct("turn", empty("role").alias("role"), empty("text").alias("content"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("m"))
    messages = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    text = lambda i: F.get("m", F.lit(i))["content"]
    roles = F.array_join(F.transform("m", lambda x: F.to_json(F.struct(x["role"]))), ",")
    shape = lambda *names: roles == ",".join(f'{{"role":"{n}"}}' for n in names)
    filled = ~F.exists("m", lambda x: x["content"] == "")
    record = (
        F.when(filled & shape("user", "assistant"), F.to_variant_object(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(
            filled & shape("system", "user", "assistant"),
            F.to_variant_object(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))),
        )
        .otherwise(F.to_variant_object(F.struct(messages.alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more (-7) that holds control strings, read back from their formatted texts."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    turns = canonical_turns(conversation_records(rows.union(more)))
    formatted = turns.select("conv_id", format_turns(F.col("turns")).alias("f")).select("conv_id", "f.formatted", "f.loss")
    learned = F.array_join(
        F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), ""
    )
    back = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), learned.alias("learned"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '</turn>', '&lt;/turn>'), '### ', '&num;## ')) AS text_chars,
         length(replace(replace(replace(replace(replace(role, '&', '&amp;'), '</turn>', '&lt;/turn>'), '### ', '&num;## '),
                                ':', '&colon;'), chr(10), '&newline;')) AS role_chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + role_chars + 14) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def _mapped(record: Column, mapping: Mapping) -> Column:
    """Turns of a record of the mapping's layout."""
    if mapping.turns is not None:
        items = F.variant_get(record, f"$.{mapping.turns}", "array<variant>")
        names = F.create_map(*[F.lit(v) for pair in mapping.names for v in pair]) if mapping.names else None

        def turn(item: Column) -> Column:
            role = F.coalesce(F.variant_get(item, f"$.{mapping.role}", "string"), F.lit(""))
            named = F.coalesce(F.element_at(names, role), role) if names is not None else role
            return F.struct(named.alias("role"), F.coalesce(F.variant_get(item, f"$.{mapping.text}", "string"), F.lit("")).alias("text"))

        return F.transform(items, turn)

    def fixed(role: str, fields: tuple[str, ...]) -> Column:
        texts = F.array(*[F.coalesce(F.variant_get(record, f"$.{f}", "string"), F.lit("")) for f in fields])
        return F.struct(F.lit(role).alias("role"), F.array_join(F.filter(texts, lambda t: t != ""), "\n\n").alias("text"))

    return F.array(*[fixed(role, fields) for role, fields in mapping.fields])
