"""Reply-ordered conversations: quoted passages are linked to what they quote."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitframe.operators.frames import ranked_hits
from hitframe.sources.stages import materialise

from .common import for_python

_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)*)")
_ATTRIBUTION = re.compile(r"(?:on\b.*|.*\b)wrote:", re.I)
_NO_ID = -(1 << 63)


def _is_attribution(line: str) -> bool:
    """Whether the line says who wrote what follows; its end is looked at first, so that
    the time is linear in its length."""
    line = line.strip(" \t")
    return line[-6:].lower() == "wrote:" and _ATTRIBUTION.fullmatch(line) is not None


def passages(text: str | None) -> list[tuple[int, str]]:
    """``(level, passage)`` in order: runs of lines of one quote level, cut at empty lines.

    The level is the number of ``>`` marks before a line; 0 is the author's own text.
    A line that says who wrote what follows, right above a deeper quote, belongs to
    the quote and is left out.
    """
    lines = []
    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        level = marks[1].count(">")
        lines.append((level, line[marks.end() :] if level else line))
    out: list[tuple[int, list[str]]] = []
    fresh = True
    for at, (level, line) in enumerate(lines):
        if not line.strip():
            fresh = True
            continue
        if at + 1 < len(lines) and lines[at + 1][0] > level and _is_attribution(line):
            fresh = True
            continue
        if fresh or out[-1][0] != level:
            out.append((level, []))
            fresh = False
        out[-1][1].append(line)
    return [(level, "\n".join(lines)) for level, lines in out]


def passage_hash(passage: str) -> bytes | None:
    """Digest without case, punctuation and line breaks; null if nothing is left."""
    words = re.findall(r"\w+", passage.lower())
    return hashlib.sha256(" ".join(words).encode()).digest()[:16] if words else None


def line_hashes(passage: str) -> list[bytes]:
    """Digests of the lines with words in them, each once and in order."""
    return sorted({h for line in passage.split("\n") if (h := passage_hash(line)) is not None})


def _parsed(messages: DataFrame) -> DataFrame:
    """Per message its own text and lines, and every passage with its level.

    Quoted passages come with the hashes of their lines.
    """

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.binary()), ("lines", pa.list_(pa.binary()))]))
        for batch in batches:
            own, said, found = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                parts = passages(text)
                own.append("\n\n".join(p for level, p in parts if not level))
                said.append(line_hashes(own[-1]))
                found.append(
                    [
                        {"level": level, "hash": h, "lines": line_hashes(p) if level else []}
                        for level, p in parts
                        if (h := passage_hash(p)) is not None
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(own, pa.string()),
                    pa.array(said, pa.list_(pa.binary())),
                    pa.array(found, kind),
                ],
                names=["conv", "turn", "role", "content", "lines", "passages"],
            )

    schema = (
        "conv long, turn long, role string, content string, lines array<binary>,"
        " passages array<struct<level: int, hash: binary, lines: array<binary>>>"
    )
    return messages.mapInArrow(run, schema)


def _holders(parts: DataFrame, own: DataFrame) -> DataFrame:
    """``(conv, lines, first_turn)``: the first message that has all lines of a set as its own.

    Each distinct set is looked up by the line of it that the fewest messages have, and
    the messages found are held against the others.
    """
    sets = materialise(parts.select("conv", "lines").distinct(), "quoted-parts")
    each = sets.select("conv", "lines", F.explode("lines").alias("line"))
    held = own.join(each.select("conv", "line").distinct(), ["conv", "line"], "left_semi")
    counts = held.groupBy("conv", "line").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (
        each.join(counts, ["conv", "line"])
        .groupBy("conv", "lines")
        .agg(F.min(F.struct("_n", "line")).alias("_rarest"))
        .select("conv", "lines", F.col("_rarest.line").alias("line"))
    )
    messages = rarest.join(held, ["conv", "line"]).select("conv", "turn", "lines")
    return (
        messages.withColumn("line", F.explode("lines"))
        .join(held, ["conv", "turn", "line"])
        .groupBy("conv", "turn", "lines")
        .agg(F.count(F.lit(1)).alias("_found"))
        .where(F.col("_found") == F.size("lines"))
        .groupBy("conv", "lines")
        .agg(F.min("turn").alias("first_turn"))
    )


def _threads(parents: DataFrame) -> DataFrame:
    """``(conv, turn, root_turn, depth)`` of every message with a parent.

    Pointer jumping: each round replaces a message's ancestor by the ancestor of
    that, so chains of any length take the logarithm of it in rounds.
    """
    up = parents.select("conv", "turn", F.col("parent").alias("root_turn"), F.lit(1).cast("long").alias("depth"))
    while True:
        onward = up.select(
            "conv", F.col("turn").alias("root_turn"), F.col("root_turn").alias("_next"), F.col("depth").alias("_more")
        )
        jumped = materialise(
            up.join(onward, ["conv", "root_turn"], "left").select(
                "conv",
                "turn",
                F.coalesce("_next", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"),
                F.col("_next").isNotNull().alias("_moved"),
            ),
            "threads",
        )
        up = jumped.drop("_moved")
        if jumped.where("_moved").isEmpty():
            return up


def link_quotations(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Every message without its quotes, with the message it answers and its place.

    A quoted passage of any level is linked to the first message of the conversation
    that has it as its own text, if that came before. A passage that none has as a whole,
    as it is trimmed or answered in between, is linked to the first message that has all
    its lines among its own, if that came before. The latest message so quoted is
    the parent. A thread is a message without a parent and all that answer it, at any
    depth; conversations are ordered by the turn of the thread's root, then by turn,
    so a reply always follows what it answers. ``position`` counts from 1.

    The originals of a passage are reduced to their first turn before the join, so
    that a passage said a thousand times is still one row per conversation, and the
    positions come from ranges of the order, so that one conversation may hold any
    share of the rows.

    A null text has no passages. Rows without a conversation form one, rows without a
    turn come first; their ids come back as null. Rows that repeat a conversation and
    turn are one message for linking, and each has its own position, in the order of
    role and content. Other columns are not read; an empty table gives an empty result.
    """
    for_python(messages.sparkSession)
    keyed = messages.select(
        F.coalesce(F.col(conv).cast("long"), F.lit(_NO_ID)).alias("conv"),
        F.coalesce(F.col(turn).cast("long"), F.lit(_NO_ID)).alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).alias("text"),
    )
    parsed = materialise(_parsed(keyed), "parsed-messages")
    said = parsed.select("conv", "turn", F.explode("passages").alias("p")).select("conv", "turn", "p.*")
    originals = said.where("level = 0").groupBy("conv", "hash").agg(F.min("turn").alias("first_turn"))
    quotes = materialise(
        said.where("level > 0")
        .join(originals, ["conv", "hash"], "left")
        .select("conv", "turn", "lines", F.expr("if(first_turn < turn, first_turn, null)").alias("first_turn")),
        "quoted-passages",
    )
    parts = quotes.where("first_turn IS NULL").drop("first_turn")
    own = parsed.select("conv", "turn", F.explode("lines").alias("line")).distinct()
    by_parts = parts.join(_holders(parts, own), ["conv", "lines"]).where("first_turn < turn")
    linked = (
        quotes.where("first_turn IS NOT NULL")
        .unionByName(by_parts)
        .groupBy("conv", "turn")
        .agg(F.max("first_turn").alias("parent"), F.count(F.lit(1)).alias("n_linked"))
    )
    linked = materialise(linked, "quote-links")
    threads = _threads(linked)
    quoted = F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long")
    placed = (
        parsed.withColumn("n_quotes", quoted)
        .drop("passages", "lines")
        .join(linked, ["conv", "turn"], "left")
        .join(threads, ["conv", "turn"], "left")
        .withColumn("root_turn", F.coalesce("root_turn", "turn"))
        .withColumn("depth", F.coalesce("depth", F.lit(0)))
        .withColumn("n_linked", F.coalesce("n_linked", F.lit(0)))
    )
    order = [F.col(c).asc() for c in ("root_turn", "turn", "role", "content")]
    ranked = ranked_hits(placed, ["conv"], order)
    real = lambda c: F.nullif(F.col(c), F.lit(_NO_ID))
    return ranked.select(
        real("conv").alias(conv),
        real("turn").alias(turn),
        F.col("role").alias(role),
        real("parent").alias("parent_turn"),
        real("root_turn").alias("root_turn"),
        "depth",
        F.col("rank").alias("position"),
        "n_quotes",
        "n_linked",
        "content",
    )
