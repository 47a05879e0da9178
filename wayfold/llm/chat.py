"""Chat formatting from an event log, with DataFrame expressions only.

A log row is (conv_id, msg, seq, kind, role, text). ``start`` opens message ``msg`` with a role, ``delta`` appends text, ``edit``
replaces what the message holds, ``regenerate`` drops it so that later deltas write it anew. Events are folded per
message, in order of (seq, kind, text); then the messages of a conversation, in order of ``msg``, are rendered:

    <|im_start|>role NEWLINE text<|im_end|> NEWLINE

Control strings inside roles and texts get a backslash after their first character, and one more if backslashes are
there already; that is undone exactly by taking one away. Backslashes and line breaks of roles are escaped too.
The loss mask holds the code-point spans of assistant texts in the rendered string.

Hot keys: events are grouped by (conversation, message), so one long conversation is folded by many tasks; only its
final messages meet, because the result has one row and one string per conversation (Spark's row limit binds it).

Rows: null texts and roles are empty. Events with a null kind or an unknown one are ignored, as are repeated
``start`` events but the last. Null conversation or message ids are ids of their own. Equal events count as often as they
occur. An empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: strings that mark turns in this template or in common ones
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>")
START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("start", "delta", "edit", "regenerate")


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in "|[]/<>" else c for c in s)


_TAILS = "|".join(_quoted(c[1:]) for c in CONTROL)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_TAILS})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_TAILS})", r"$1$2$3")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda s: F.replace(s, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def fold_events(log: DataFrame) -> DataFrame:
    """(conv_id, msg, role, text): the final state of every message that has a known event."""
    empty = F.lit("")
    event = F.struct("seq", "kind", F.coalesce("text", empty).alias("text"), F.coalesce("role", empty).alias("role"))
    per = log.where(F.col("kind").isin(*KINDS)).groupBy("conv_id", "msg").agg(F.sort_array(F.collect_list(event)).alias("events"))
    at = F.transform("events", lambda e, i: F.when(e["kind"] != "delta", i))
    last = F.greatest(F.coalesce(F.array_max(at), F.lit(0)), F.lit(0))
    # from the last reset on; a start or an edit brings text of its own
    live = F.filter("events", lambda e, i: (i >= last) & (e["kind"] != "regenerate"))
    starts = F.filter("events", lambda e: e["kind"] == "start")
    return per.select("conv_id", "msg", F.coalesce(F.try_element_at(starts, F.lit(-1))["role"], empty).alias("role"),
                      F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): spans are (start, end) in code points, end excluded."""
    per = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("msg", "role", "text"))).alias("m"))
    parts = F.transform("m", lambda x: F.struct(
        F.concat(F.lit(START), _escape_role(x["role"]), F.lit("\n")).alias("head"), escape(x["text"]).alias("body"), (x["role"] == trained).alias("loss")))
    per = per.select("conv_id", parts.alias("m"))
    tail = f"{END}\n"
    step = F.aggregate(
        "m", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["head"]) + F.char_length(x["body"]) + len(tail)).alias("at"),
            F.when(x["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.char_length(x["head"])).alias("start"), (acc["at"] + F.char_length(x["head"]) + F.char_length(x["body"])).alias("end")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return per.select("conv_id", F.array_join(F.transform("m", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), "").alias("formatted"), step.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """Back to array<struct<role, text>>."""
    turns = F.slice(F.split(formatted, _quoted(START)), 2, 1 << 30)

    def turn(x: Column) -> Column:
        cut = F.instr(x, "\n")
        body = F.substring(x, cut + 1, F.char_length(x) - cut - F.lit(len(END) + 1))
        return F.struct(_unescape_role(F.substring(x, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, turn)


def masked_texts(formatted: Column, spans: Column) -> Column:
    """Unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def format_log(log: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of an event log."""
    return render(fold_events(log))
