"""Conversations linked by what their messages quote.

Each message is parsed into its own text and its quoted passages with their nesting level. Normalised passages are
hashed and joined to the earlier message of the same conversation that wrote them; messages are then put in the order
of replies, without the quotes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threatloom.llm.common import checkpointed, slices, stage

_SLICE = 4 << 20
_MARKS = re.compile(r"(?:[ \t]*>)+")
_PASSAGE = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))
_PARSED = "conv_id long, turn long, role string, own string, quoted array<struct<level:int,hash:long>>, written array<long>"


def passage_hash(text: str) -> int | None:
    """Hash of a passage without regard to case and white space; blank passages have none."""
    plain = " ".join(text.lower().split())
    return int.from_bytes(hashlib.blake2b(plain.encode(), digest_size=8).digest(), "little", signed=True) if plain else None


def passages(text: str) -> list[tuple[int, list[str]]]:
    """(level, lines) of each run of lines of one quote level; a blank line ends a run."""
    found: list[tuple[int, list[str]]] = []
    fresh = True
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks.group().count(">") if marks else 0
        body = line[marks.end() :] if marks else line
        if not body.strip():
            fresh = True
        elif fresh or not found or found[-1][0] != level:
            found.append((level, [body]))
            fresh = False
        else:
            found[-1][1].append(body)
    return found


def _hashes(lines: list[str]) -> list[int]:
    """Of the whole passage and, if there are several, of each line."""
    whole = passage_hash("\n".join(lines))
    each = [passage_hash(x) for x in lines] if len(lines) > 1 else []
    return [h for h in (whole, *each) if h is not None]


def _own(text: str) -> str:
    return "\n".join(line for line in text.split("\n") if not _MARKS.match(line)).strip()


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text", _SLICE):
        own, quoted, written = [], [], []
        for raw in texts:
            text = None if raw is None else raw.decode()
            found = passages(text or "")
            own.append(None if text is None else _own(text))
            quoted.append([{"level": level, "hash": h} for level, lines in found if level for h in _hashes(lines)])
            written.append(sorted({h for level, lines in found if not level for h in _hashes(lines)}))
        columns = [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int64()), batch.column(2).cast(pa.string())]
        columns += [pa.array(own, pa.string()), pa.array(quoted, _PASSAGE), pa.array(written, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "role", "own", "quoted", "written"])


def _answered(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, answers, linked): the latest earlier message whose passage the message quotes, by least level.

    Only passages that are quoted somewhere in the conversation take part. A window over all writers and quoters of a
    passage, by turn, hands on the last writer, so no pair of rows is made.
    """
    quotes = parsed.select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.level", "q.hash").distinct()
    wanted = quotes.select("conv_id", "hash").distinct()
    writers = parsed.select("conv_id", "turn", F.explode("written").alias("hash")).join(wanted, ["conv_id", "hash"], "left_semi")
    both = writers.select("conv_id", "hash", "turn", F.lit(0).alias("level")).union(quotes.select("conv_id", "hash", "turn", "level"))
    before = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("writer", F.max(F.when(F.col("level") == 0, F.col("turn"))).over(before))
    found = found.where("level > 0 AND writer IS NOT NULL")
    best = F.min(F.struct("level", (-F.col("writer")).alias("later")))
    return found.groupBy("conv_id", "turn").agg(best.alias("best"), F.countDistinct("hash").alias("linked")).select(
        "conv_id", "turn", (-F.col("best.later")).alias("answers"), "linked"
    )


def link_conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, answers, root, depth, n_quoted, n_linked) per message.

    ``messages`` has conv_id, turn, role and text. ``text`` is the message without quoted lines; ``answers`` the turn
    it replies to: the message it quotes, at the lowest quote level and the latest of several, else the turn before
    it, if there is one. Within a conversation, order by (root, depth, turn): each message comes after the one it
    answers. ``n_quoted`` counts the quoted passages and lines, ``n_linked`` those found in an earlier message.

    A null text stays null and quotes nothing; an empty or wholly quoted one is empty. Rows with a null conv_id or
    turn answer nothing and are roots. Rows that share conv_id and turn are alternatives of one message: each keeps
    its text, and they answer what any of them quotes. A conversation is never gathered: messages are joined by their
    turns, and roots are found by doubling jumps, in rounds of the logarithm of the longest chain.
    """
    narrow = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "text")
    parsed = stage(narrow.mapInArrow(_parse, _PARSED), "chat")
    keys = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    previous = keys.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("previous"))
    links = keys.join(previous, ["conv_id", "turn"], "left").join(_answered(parsed), ["conv_id", "turn"], "left")
    links = links.select("conv_id", "turn", F.coalesce("answers", "previous").alias("answers"), F.coalesce("linked", F.lit(0)).alias("n_linked"))
    links = stage(links, "chat-links")
    jumps = links.select("conv_id", "turn", F.coalesce("answers", "turn").alias("root"), F.when(F.col("answers").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    while True:
        ahead = jumps.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        moved = jumps.join(ahead, ["conv_id", "root"]).select(
            "conv_id", "turn", F.col("next").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("next") != F.col("root")).alias("moved")
        )
        moved = checkpointed(moved)
        jumps = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    places = links.join(jumps, ["conv_id", "turn"])
    return parsed.join(places, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        F.col("own").alias("text"),
        "answers",
        F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.size("quoted").cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )
