"""Chat formatting from event logs: fold each conversation's events into messages, then render them.

A log row is (conv_id, seq, message, kind, role, text). Events of one message are sorted by seq and folded:

* `open` starts the message (its role counts) with its text; `delta` appends text;
* `edit` replaces the text so far; `regenerate` does the same and streaming goes on from there;
* `drop` removes the message, unless a later `open`, `edit` or `regenerate` brings it back.

Messages are ordered by their first event. Folding is dealt out by (conversation, message) before the
messages of a conversation meet, so a long stream is never sorted with its whole conversation.

The template marks a turn as `<|im_start|>role, newline, text<|im_end|>, newline`. In texts and roles a
backslash is doubled, `<|` becomes `<\\|` and a newline inside a role `<\\n>`; `parse` reverses that. The result carries
`segments` (text, loss): joined they are the formatted string; loss marks the texts of the trained roles.

Defined cases: null roles and texts are empty; events of equal seq are ordered by kind, role and text; a
null conversation id is a conversation of its own; deltas without an open message make one with an empty role;
an empty log gives no rows; columns beyond the six are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import let

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = ("assistant",)
#: Characters a streamed delta carries in logs made from a message table.
DELTA_CHARS = 512


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    return _replace(_replace(text, "\\", "\\\\"), "<|", "<\\|")


def unescape(text: Column) -> Column:
    return _replace(_replace(text, "<\\|", "<|"), "\\\\", "\\")


def escape_role(role: Column) -> Column:
    return _replace(escape(role), "\n", "<\\n>")


def unescape_role(role: Column) -> Column:
    return unescape(_replace(role, "<\\n>", "\n"))


def log_of(rows: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """A log that streams each row (conv_id, turn, role, text) as an open event and deltas.

    Rows of a conversation are numbered by turn, then role and text; repeated rows stay apart.
    """
    numbered = rows.selectExpr(
        "conv_id",
        "coalesce(role, '') AS role",
        "coalesce(text, '') AS text",
        "row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS message",
    )
    steps = F.sequence(F.lit(0), F.expr(f"cast(length(text) div {delta_chars} AS int)"))
    events = numbered.select("conv_id", "message", "role", "text", F.explode(steps).alias("k"))
    return events.select(
        "conv_id",
        (F.col("message") * (1 << 31) + F.col("k")).alias("seq"),
        "message",
        F.when(F.col("k") == 0, "open").otherwise("delta").alias("kind"),
        F.when(F.col("k") == 0, F.col("role")).alias("role"),
        F.expr(f"substring(text, k * {delta_chars} + 1, {delta_chars})").alias("text"),
    )


def fold(log: DataFrame) -> DataFrame:
    """One row per message that remains: conv_id, first_seq, message, role, text."""
    event = F.struct(
        "seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    told = log.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("e"))

    def last(kinds: Sequence[str]) -> Column:
        at = F.transform("e", lambda x, i: F.when(x["kind"].isin(list(kinds)), i + 1).otherwise(0))
        return F.array_max(at)

    resets = ("open", "edit", "regenerate")
    told = told.select("conv_id", "message", "e", last(resets).alias("reset"), last(["drop"]).alias("gone"))
    parts = F.filter(
        F.slice("e", F.greatest("reset", F.lit(1)), F.size("e")), lambda x: x["kind"].isin([*resets, "delta"])
    )
    role = F.get(F.filter("e", lambda x: x["kind"] == "open"), F.lit(0))["role"]
    return told.where("gone <= reset").select(
        "conv_id",
        F.get("e", F.lit(0))["seq"].alias("first_seq"),
        "message",
        F.coalesce(role, F.lit("")).alias("role"),
        F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"),
    )


def render(messages: DataFrame, trained: Sequence[str] = TRAINED) -> DataFrame:
    """One row per conversation: conv_id, segments, formatted."""
    turn = F.struct("first_seq", "message", "role", "text")
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("m"))

    def segment(text: Column, loss: Column | bool) -> Column:
        return F.struct(text.alias("text"), (loss if isinstance(loss, Column) else F.lit(loss)).alias("loss"))

    def parts(m: Column) -> Column:
        return F.array(
            segment(F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n")), False),
            segment(escape(m["text"]), m["role"].isin(list(trained))),
            segment(F.lit(END + "\n"), False),
        )

    cut = turns.select("conv_id", F.flatten(F.transform("m", parts)).alias("segments"))
    return cut.select("conv_id", "segments", F.array_join("segments.text", "").alias("formatted"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted string, as an array of (role, text)."""

    def turn(piece: Column) -> Column:
        def split(head: Column) -> Column:
            size = F.length(piece) - F.length(head) - 1 - len(END) - 1
            body = F.substring(piece, F.length(head) + 2, size)
            return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

        return let(F.substring_index(piece, "\n", 1), split)

    pieces = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def format_log(log: DataFrame, trained: Sequence[str] = TRAINED) -> DataFrame:
    return render(fold(log), trained)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests, read back from the formatted strings and their loss mask."""
    said = formatted.select(
        "conv_id",
        "formatted",
        parse(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return said.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
