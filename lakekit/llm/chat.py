"""Chat formatting with a loss mask that is aligned to token offsets.

A conversation is rendered as a whole and encoded once, with the offsets of its tokens. The template marks each turn with its
role and its end; the control strings are escaped inside roles and texts with a backslash, which can be undone. The spans of
the answers are then intersected with the spans of the tokens by binary search in the sorted token starts: a token belongs to
the loss as far as it overlaps an answer, so a token that straddles an edge counts only on the answer's side.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrow_text import arrow_batches

#: The template: a turn is OPEN role COLON text CLOSE.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_MARK = re.compile(r"\\|###|</turn>")


def escaped(text: str, role: bool = False) -> str:
    """The text with a backslash before each control string (in roles also before colons)."""
    return (_CONTROL if role else _MARK).sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The formatted conversation, and start and end of each text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escaped(role, role=True)}{COLON}", escaped(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; anything that the template did not make fails."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


def masked(answers: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens overlap an answer, and the overlaps, token by token.

    Both are sorted spans. Tokens that share a character (its bytes fall to several) have one span each; their overlaps are
    merged, so that no character counts twice.
    """
    chosen = np.zeros(len(tokens), dtype=bool)
    overlaps = []
    for start, end in answers:
        low = int(np.searchsorted(tokens[:, 1], start, side="right"))
        high = int(np.searchsorted(tokens[:, 0], end, side="left"))
        if start < end and low < high:
            chosen[low:high] = True
            cut = np.clip(tokens[low:high], start, end)
            reach = np.maximum.accumulate(np.append(start, cut[:-1, 1]))
            cut[:, 0] = np.maximum(cut[:, 0], reach)
            overlaps.append(cut[cut[:, 0] < cut[:, 1]])
    return chosen, np.concatenate(overlaps) if overlaps else np.zeros((0, 2), np.int64)


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True  # control strings of the vocabulary are ordinary text here
    return loaded


RESULT = ("conv_id {kind}, n_turns long, formatted string, token_ids array<int>, loss_mask array<boolean>, "
          "loss_spans array<struct<start: int, end: int>>")


def format_conversations(
    conversations: DataFrame, tokenizer_path: str, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", answering: str = "assistant", shards: int | None = None,
) -> DataFrame:
    """One row per conversation: its formatted text, token ids, loss mask per token, and the answers' character spans as the
    tokens cover them.

    Turns are ordered by ``turn`` (null first), then role and text; repeated rows are turns of their own. A null role or text
    is empty. Rows without a conv_id cannot be told apart by it: each is a conversation of its own, so that they never gather
    in one group. An empty table gives no rows. A task holds one conversation at a time.
    """
    spark = conversations.sparkSession
    arrow_batches(spark)
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    spread = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    parts = [shards] if shards else []
    sorted_ = rows.repartition(*parts, F.col("conv_id"), spread).sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        made: list[tuple] = []
        size = 0

        def out(kind: pa.DataType) -> pa.RecordBatch:
            ids, counts, texts, tokens, masks, spans = zip(*made, strict=True)
            return pa.RecordBatch.from_arrays([
                pa.array(ids, kind), pa.array(counts, pa.int64()), pa.array(texts, pa.string()), pa.array(tokens, pa.list_(pa.int32())),
                pa.array(masks, pa.list_(pa.bool_())),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ], names=["conv_id", "n_turns", "formatted", "token_ids", "loss_mask", "loss_spans"])

        def finished(key, turns: list[tuple[str, str]]) -> None:
            nonlocal size
            formatted, where = rendered(turns)
            found = tokenizer.encode(formatted, add_special_tokens=False)
            answers = where[[r == answering for r, _ in turns]]
            chosen, overlaps = masked(answers, np.array(found.offsets, np.int64).reshape(-1, 2))
            made.append((key, len(turns), formatted, found.ids, chosen.tolist(),
                         [{"start": s, "end": e} for s, e in overlaps.tolist()]))
            size += len(formatted)

        key, turns, type_ = None, [], None
        for batch in batches:
            type_ = batch.schema.field("conv_id").type
            for c, r, t in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
                if turns and (c != key or c is None):
                    finished(key, turns)
                    turns = []
                key = c
                turns.append((r, t))
                if size > 1 << 18:
                    yield out(type_)
                    made, size = [], 0
        if turns:
            finished(key, turns)
        if made:
            yield out(type_)

    return sorted_.mapInArrow(run, RESULT.format(kind=kind))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the output of ``format_conversations`` says: roles and texts of the turns, and the text under the loss mask.

    Adds ``turns`` (array of role, text) and ``loss_text``; everything is read from the formatted text and the spans.
    """
    names = formatted.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("formatted").to_pylist()
            turns = [[{"role": r, "text": t} for r, t in parsed(x)] for x in texts]
            loss = [unescaped("".join(x[s["start"]:s["end"]] for s in spans))
                    for x, spans in zip(texts, batch.column("loss_spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                pa.array(loss, pa.string()),
            ], names=[*names, "turns", "loss_text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in formatted.schema.fields)
    return formatted.mapInArrow(run, f"{fields}, turns array<struct<role: string, text: string>>, loss_text string")
