"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation (a sequence of turns):

    user       <s>[INST] body [/INST]
    assistant  (space)body </s>
    system     <<SYS>> body <</SYS>>
    any other  <<ROLE>> role <<TEXT>> body <</ROLE>>

A body ends at the first terminator of its kind. It is the text itself, or ``\\e``
and the text with ``\\``, ``<`` and ``[`` written ``\\\\``, ``\\l`` and ``\\b``, so that no
control string is left in it. A conversation is first rendered plainly and parsed
again; if the recovered turns are not the source's, the turns with ``<``, ``[`` or a
leading ``\\`` are escaped and it is rendered and parsed again. A conversation that
would still differ raises an error, so what is returned reads back identically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What stands before and after the body of each role.
FORMS = {
    "user": ("<s>[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
    "system": ("<<SYS>> ", " <</SYS>>"),
}
OTHER = ("<<ROLE>> ", " <<TEXT>> ", " <</ROLE>>")
_TURN = r"(?s)<s>\[INST\] .*? \[/INST\]|<<SYS>> .*? <</SYS>>|<<ROLE>> .*? <<TEXT>> .*? <</ROLE>>| .*? </s>"


def _escape(text: Column) -> Column:
    for raw, written in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")):
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def _unescape(text: Column) -> Column:
    plain = F.transform(F.split(text, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")))
    return F.array_join(plain, "\\")


def _body(text: Column, escape: bool) -> Column:
    if not escape:
        return text
    conflicting = text.contains("<") | text.contains("[") | text.startswith("\\")
    return F.when(conflicting, F.concat(F.lit("\\e"), _escape(text))).otherwise(text)


def _before(turn: Column) -> Column:
    """What stands before a turn's body."""
    out = F.concat(F.lit(OTHER[0]), _escape(turn["role"]), F.lit(OTHER[1]))
    for role, (head, _) in FORMS.items():
        out = F.when(turn["role"] == role, head).otherwise(out)
    return out


def _after(turn: Column) -> Column:
    out = F.lit(OTHER[2])
    for role, (_, tail) in FORMS.items():
        out = F.when(turn["role"] == role, tail).otherwise(out)
    return out


def _render(turns: Column, escape: bool) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_before(t), _body(t["text"], escape), _after(t))), "")


def _read_body(body: Column) -> Column:
    return F.when(body.startswith("\\e"), _unescape(body.substr(F.lit(3), F.length(body)))).otherwise(body)


def _inside(turn: Column, head: Column | str, tail: str) -> Column:
    head = F.length(F.lit(head)) if isinstance(head, str) else head
    return turn.substr(head + 1, F.length(turn) - head - len(tail))


def _parse_turn(turn: Column) -> Column:
    split = F.locate(OTHER[1], turn)
    role = turn.substr(F.lit(len(OTHER[0]) + 1), split - len(OTHER[0]) - 1)
    out = F.struct(_unescape(role).alias("role"), _read_body(_inside(turn, split + len(OTHER[1]) - 1, OTHER[2])).alias("text"))
    for name, (head, tail) in FORMS.items():
        out = F.when(turn.startswith(head), F.struct(F.lit(name).alias("role"), _read_body(_inside(turn, head, tail)).alias("text"))).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, by the grammar alone."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), _parse_turn)


def loss_spans(formatted: Column) -> Column:
    """Spans (start, end in code points, end exclusive) of the assistant bodies in a formatted conversation."""
    turns = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))
    empty = F.expr("named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int>>))")
    head, tail = FORMS["assistant"]

    def step(state: Column, turn: Column) -> Column:
        n = F.length(turn)
        span = F.struct((state["at"] + len(head)).alias("start"), (state["at"] + n - len(tail)).alias("end"))
        kept = F.when(turn.startswith(head), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + n).alias("at"), kept.alias("spans"))

    return F.aggregate(turns, empty, step, lambda s: s["spans"])


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (the source's role and text, by turn), formatted and loss_spans, one row a conversation.

    Null texts and roles are empty strings. Rows of one turn number follow each
    other by role, then text; repeated rows are repeated turns; rows with a null
    turn come first. Null conv_ids form one conversation. An empty table gives an
    empty result; other columns are not read. A conversation is one string, so its
    turns meet in one task; conversations of equal content stay apart.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    whole = whole.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    plain = whole.withColumn("plain", _render(F.col("turns"), False))
    tried = plain.withColumn("formatted", F.when(parse(F.col("plain")) == F.col("turns"), F.col("plain")).otherwise(_render(F.col("turns"), True)))
    checked = F.when(parse(F.col("formatted")) == F.col("turns"), F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not read back")))
    return tried.select("conv_id", "turns", checked.alias("formatted")).withColumn("loss_spans", loss_spans(F.col("formatted")))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests read back from the formatted conversations alone."""
    read = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("read"), "loss_spans")
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform("loss_spans", lambda s: _read_body(F.col("formatted").substr(s["start"] + 1, s["end"] - s["start"]))), "")
    return read.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose two turns both say a string of control words."""
    said = F.lit("</s>[INST] ok [/INST]")
    turns = F.array(*[F.struct(F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), said.alias("text")) for k, r in enumerate(("user", "assistant"))])
    probe = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(turns).alias("t")).select("conv_id", "t.*")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN ' </s>' WHEN 'system' THEN ' <</SYS>>' ELSE ' <</ROLE>>' END AS tail,
             CASE role WHEN 'user' THEN 10 WHEN 'assistant' THEN 1 WHEN 'system' THEN 8
                       ELSE 19 + length(role) + length(regexp_replace(role, '[^\\<\[]', '', 'g')) END AS head,
             length(regexp_replace(text, '[^\\<\[]', '', 'g')) AS marks FROM c),
k AS (SELECT *, strpos(text || tail, tail) <= length(text) OR starts_with(text, '\e') AS broken,
             marks > 0 AND (contains(text, '<') OR contains(text, '[') OR starts_with(text, '\')) AS escapable FROM e),
f AS (SELECT *, bool_or(broken) OVER (PARTITION BY conv_id) AS again FROM k)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(head + length(tail) + length(text) + CASE WHEN again AND escapable THEN 2 + marks ELSE 0 END) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
