r"""Chat formatting checked by a grammar round trip, in DataFrame operations only.

A conversation becomes one text of turns, `### Label: body</turn>` and a line feed each. A deterministic parser
reads such a text back: it cuts at every `</turn>` and `### `, ends the label at its first `: `, and takes one
backslash out of every escaped control string. Each turn is rendered as it is, reparsed and compared with its source;
where they differ its text and role are escaped and it is reparsed again, so that plain texts stay as they
are. A turn that no rendering brings back is an error. Turns are a prefix code, so the
conversation parses as they do; the joined text is reparsed nevertheless and compared by a hash a turn.

Escaping puts a backslash behind the first character of a control string, and one more where there are some
already: `</turn>`, `<\/turn>`, `<\\/turn>` become `<\/turn>`, `<\\/turn>`, `<\\\/turn>`. No control string is
left, and nothing else changes, so any text comes back.

The rows of a conversation are ordered by turn (null first), then role, then the body as formatted. Null texts and
roles are empty; any text may be a role, and only the bodies of the role `assistant` are under the loss mask. Rows
without a conv_id are one conversation. Repeated rows are turns of their own. An empty table gives an empty
one, and other columns are left out. A conversation becomes one row, so it must fit a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, LABEL_END, END = "### ", ": ", "</turn>"
LABELS = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
#: The label of any other role, before the role itself.
OTHER = "Role "
LEARNT = "assistant"


def _stuffed(text: Column, first: str, rest: str) -> Column:
    return F.regexp_replace(text, rf"{first}(\\*+){rest}", rf"{first}\\$1{rest}")


def _unstuffed(text: Column, first: str, rest: str) -> Column:
    return F.regexp_replace(text, rf"{first}\\(\\*+){rest}", f"{first}$1{rest}")


def escaped(text: Column) -> Column:
    return _stuffed(_stuffed(text, "#", "## "), "<", "/turn>")


def unescaped(text: Column) -> Column:
    return _unstuffed(_unstuffed(text, "#", "## "), "<", "/turn>")


def header(role: Column) -> Column:
    label = F.concat(F.lit(OTHER), role)
    for known, shown in LABELS.items():
        label = F.when(role == known, F.lit(shown)).otherwise(label)
    return F.concat(F.lit(HEAD), label, F.lit(LABEL_END))


def parse(formatted: Column) -> Column:
    """The turns, (role, text) each, of a formatted text; null where it ends within a turn, and a null
    turn where one is not in the grammar."""
    parts = F.split(F.concat(F.lit("\n"), formatted), END)  # the line feed of a turn leads the next part

    def turn(halves: Column) -> Column:
        rest = halves[1]
        label = F.substring_index(rest, LABEL_END, 1)
        role = F.when(label.startswith(OTHER), unescaped(_unstuffed(F.substr(label, F.lit(len(OTHER) + 1)), ":", " ")))
        for known, shown in LABELS.items():
            role = F.when(label == shown, F.lit(known)).otherwise(role)
        text = unescaped(F.substr(rest, F.char_length(label) + len(LABEL_END) + 1))
        grammatical = (F.size(halves) == 2) & (halves[0] == "\n") & rest.contains(LABEL_END) & role.isNotNull()
        return F.when(grammatical, F.struct(role.alias("role"), text.alias("text")))

    turns = F.transform(F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda part: F.split(part, HEAD)), turn)
    return F.when(F.element_at(parts, -1) == "\n", turns)


def round_trip(role: Column, text: Column) -> Column:
    """(header, body) of the first rendering that reparses to exactly this turn: as it is, else escaped."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    renderings = [(role, text), (_stuffed(escaped(role), ":", " "), escaped(text))]
    tried = []
    for shown, body in renderings:
        head = header(shown)
        again = parse(F.concat(head, body, F.lit(END + "\n")))
        tried.append(F.when(again.eqNullSafe(source), F.struct(head.alias("header"), body.alias("body"))))
    failed = F.raise_error(F.lit("a turn does not come back from its rendering"))
    return F.coalesce(*tried, failed.cast("struct<header:string,body:string>"))


def _mark(role: Column, text: Column) -> Column:
    return F.xxhash64(role, text)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, segments: array of (text, loss)) of each conversation of rows (conv_id, turn, role, text).

    The segments joined are the formatted text; those with `loss` are the loss mask.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .withColumn("shown", round_trip(F.col("role"), F.col("text")))
        .select("conv_id", F.struct("turn", "role", "shown.body", "shown.header", _mark(F.col("role"), F.col("text")).alias("mark")).alias("piece"))
    )

    def segments(piece: Column) -> Column:
        def one(text: Column, loss: bool) -> Column:
            return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

        end = F.lit(END + "\n")
        learnt = F.array(one(piece["header"], False), one(piece["body"], True), one(end, False))
        return F.when(piece["role"] == LEARNT, learnt).otherwise(
            F.array(one(F.concat(piece["header"], piece["body"], end), False))
        )

    joined = (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
        .select("conv_id", F.flatten(F.transform("pieces", segments)).alias("segments"), F.col("pieces.mark").alias("marks"))
    )
    again = F.transform(parse(formatted(F.col("segments"))), lambda turn: _mark(turn["role"], turn["text"]))
    failed = F.raise_error(F.lit("a conversation does not come back from its rendering"))
    return joined.select("conv_id", F.when(again.eqNullSafe(F.col("marks")), F.col("segments")).otherwise(failed).alias("segments"))


def formatted(segments: Column) -> Column:
    """The formatted text of a conversation."""
    return F.array_join(segments["text"], "")


def learnt(segments: Column) -> Column:
    """The text under the loss mask, unescaped."""
    masked = F.filter(segments, lambda segment: segment["loss"])
    return F.array_join(F.transform(masked, lambda segment: unescaped(segment["text"])), "")
