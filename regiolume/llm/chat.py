"""Chat logs folded from events into final messages, and rendered with a template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiolume.llm.common import LEAST_ID
from regiolume.session import stage

#: A message is ``### role: text</turn>`` and a line end. In texts and roles ``\``, ``#`` and ``<`` (in roles ``:``
#: too) get a ``\`` before them, so neither mark can stand in a text.
HEAD, TAIL = "### ", "</turn>\n"
MESSAGE = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*?)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: Column, role: bool = False) -> Column:
    return F.regexp_replace(text, r"([\\#<:])" if role else r"([\\#<])", r"\\$1")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def fold_messages(events: DataFrame) -> DataFrame:
    """Final messages of an event log with ``conv_id, seq, message, kind, role, text``.

    Kinds: ``open`` begins a message and names its role; ``delta`` appends a piece of text; ``edit`` replaces the text
    so far; ``regenerate`` clears it, and messages that were opened after this one, but before the event,
    are dropped with it. Events count in the order of ``seq``; an event delivered twice counts once.

    Returns ``conv_id, message, opened`` (the order within the conversation, ties by ``message``), ``role, text``. Events
    are grouped by conversation and message, never by conversation alone, so a conversation that holds a third of
    the log is spread over many tasks. NULL texts are empty, a NULL conversation is one of its own, a NULL ``seq``
    comes first. A message without ``open`` has the role '' and stands where its first event stands.
    """
    kind, seq = F.col("kind"), F.col("seq")
    part = F.struct(seq, kind, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    messages = events.groupBy("conv_id", "message").agg(
        F.coalesce(F.min(F.when(kind == "open", seq)), F.min(seq)).alias("opened"),
        F.coalesce(F.max(F.when(kind == "open", F.col("role"))), F.lit("")).alias("role"),
        F.max(F.when(kind == "regenerate", seq)).alias("regenerated"),
        F.max(F.when(kind.isin("edit", "regenerate"), seq)).alias("reset"),
        F.sort_array(F.collect_set(F.when(kind != "open", part))).alias("parts"),
    )

    def counts(x: Column) -> Column:
        new = F.col("reset").isNull() | (x["seq"] > F.col("reset"))
        return new | ((x["seq"] == F.col("reset")) & x["kind"].isin("edit", "regenerate"))

    text = F.array_join(F.transform(F.filter("parts", counts), lambda x: x["text"]), "")
    messages = messages.select("conv_id", "message", "opened", "role", "regenerated", text.alias("text"))
    # Which messages a regeneration drops is decided on rows without text, of conversations that have one.
    heads = events.groupBy("conv_id", "message").agg(
        F.coalesce(F.min(F.when(kind == "open", seq)), F.min(seq)).alias("opened"),
        F.max(F.when(kind == "regenerate", seq)).alias("regenerated"),
    )
    anew = heads.where("regenerated is not null").select(F.col("conv_id").alias("__conv")).distinct()
    heads = heads.join(anew, F.col("conv_id").eqNullSafe(F.col("__conv")), "left_semi")
    earlier = Window.partitionBy("conv_id").orderBy("opened", "message").rowsBetween(Window.unboundedPreceding, -1)
    dropped = heads.withColumn("cut", F.max("regenerated").over(earlier)).where("cut > opened")
    dropped = dropped.select(F.col("conv_id").alias("__conv"), F.col("message").alias("__message"))
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & F.col("message").eqNullSafe(F.col("__message"))
    return messages.join(dropped, same, "left_anti").drop("regenerated")


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """Messages as pieces of formatted text, one row each: ``conv_id, opened, message, piece, loss_start, loss_end``.

    A conversation's text is its pieces in order of ``opened, message``. The loss mask of a piece is a range of code
    points: the escaped text of a message of role ``learn``, else an empty range.
    """
    text, role = escape(F.col("text")), escape(F.col("role"), role=True)
    head = F.concat(F.lit(HEAD), role, F.lit(": "))
    learned = F.col("role") == learn
    return messages.select(
        "conv_id", "opened", "message",
        F.concat(head, text, F.lit(TAIL)).alias("piece"),
        F.when(learned, F.length(head)).otherwise(0).alias("loss_start"),
        F.when(learned, F.length(head) + F.length(text)).otherwise(0).alias("loss_end"),
    )


def number_copies(conversations: DataFrame) -> DataFrame:
    """Whole turns (``conv_id, turn, role, text``) with ``copy``, 0, 1, ... for rows that agree in all four, NULL and empty
    roles and texts being alike. Equal rows are counted before they meet, so a row that is repeated often is one row of a
    task until it is dealt out again."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    counted = conversations.groupBy(F.col("conv_id"), F.col("turn"), empty("role"), empty("text"))
    counted = counted.agg(F.count(F.lit(1)).alias("copies"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    return counted.select("conv_id", "turn", "role", "text", copy)


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of whole turns (``conv_id, turn, role, text``) as the log of a streamed chat: each row opens a message
    and delivers its text in two pieces. A message's name is its turn, role and a hash, so a repeated row repeats events
    and counts once, and different rows of one turn stay apart; with a column ``copy`` (see ``number_copies``) it is part of
    the name, and each copy counts. A NULL turn comes before all others and is none of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    half = (F.length(text) / 2).cast("int")
    turn = F.when(F.col("turn").isNotNull(), F.format_string("%020d", "turn")).otherwise("")
    name = [turn, role, F.hex(F.xxhash64(text))]
    if "copy" in conversations.columns:
        name.append(F.format_string("%020d", "copy"))
    name = F.concat_ws("/", *name)
    seq = F.coalesce(F.col("turn").cast("long") * 3, F.lit(LEAST_ID))
    none = F.lit(None).cast("string")
    event = lambda i, kind, role, text: F.struct(
        (seq + i).alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text")
    )
    made = F.array(
        event(0, "open", role, none),
        event(1, "delta", none, F.substring(text, F.lit(1), half)),
        event(2, "delta", none, F.substring(text, half + 1, F.length(text) - half)),
    )
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), name.alias("message"), F.explode(made))
    return rows.select("conv_id", "message", "col.*")


def format_conversations(events: DataFrame, learn: str = "assistant") -> DataFrame:
    """The pieces of ``render``, written to the shared folder and read back."""
    return stage(render(fold_messages(events), learn), "formatted")


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, parsed back from its pieces: counts and hashes of turns and of what the loss mask shows.

    Pieces are sorted by Spark and hashed as they pass, so a conversation is never held in memory.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "opened", "message")
    return dealt.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(_digest, schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now = None  # conversation, turns, hash of turns, loss characters, hash of loss, characters

    def closed(x: list) -> list:
        return [x[0], x[1], x[2].hexdigest(), x[3], x[4].hexdigest(), x[5]]

    for batch in batches:
        done = []
        for conv, piece, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now[0] != conv:
                if now is not None:
                    done.append(closed(now))
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = (unescape(x) for x in MESSAGE.fullmatch(piece).groups())
            loss = unescape(piece[a:b])
            now[1] += 1
            now[2].update(f"{role}\n{text}\n".encode())
            now[3] += len(loss)
            now[4].update(loss.encode())
            now[5] += len(piece)
        if done:
            columns = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(closed(now), types, strict=True)], names)
