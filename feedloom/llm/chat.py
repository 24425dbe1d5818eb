"""Conversations as one training text each, with the loss mask aligned by character offsets.

A conversation is rendered whole and encoded once. Tokens and turns are both sorted by position,
so the tokens of each assistant turn are found by binary search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ":\n", "\n</turn>\n"
ESCAPE = "\\"
#: What marks a turn. Inside roles and texts each of these gets the escape sign in front, and so
#: does the escape sign itself; roles also write their line breaks with it.
CONTROLS = ("###", "</turn>")
_control = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROLS))))
_escaped = re.compile(re.escape(ESCAPE) + "(" + "|".join(map(re.escape, (ESCAPE, *CONTROLS))) + ")")
_skip = re.compile(_escaped.pattern + "|(?P<end>" + re.escape(END) + ")")
_role_out = {ESCAPE: ESCAPE * 2, "\n": ESCAPE + "n", ":": ESCAPE + "c", "#": ESCAPE + "h"}
_role_in = {v: k for k, v in _role_out.items()}


def escape(text: str) -> str:
    return _control.sub(lambda m: ESCAPE + m[0], text)


def unescape(text: str) -> str:
    return _escaped.sub(lambda m: m[1], text)


def escape_role(role: str) -> str:
    return re.sub(r"[\\\n:#]", lambda m: _role_out[m[0]], role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\[\\nch]", lambda m: _role_in[m[0]], role)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as text, and where the text of each turn stands in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = HEAD + escape_role(role) + COLON, escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at = spans[-1][1] + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation, as they were before."""
    turns, at = [], 0
    while at < len(formatted):
        colon = formatted.index(COLON, at)
        begin = place = colon + len(COLON)
        while not (found := _skip.search(formatted, place))["end"]:
            place = found.end()
        turns.append((unescape_role(formatted[at + len(HEAD):colon]),
                      unescape(formatted[begin:found.start()])))
        at = found.end()
    return turns


def masked(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token whether it counts for the loss, and the part of it inside a span.

    ``offsets`` holds begin and end of each token, ``spans`` those of the trained turns, both in
    order. Begins are set to the end of the token before where a tokenizer leaves a gap, so every
    character belongs to a token. A token over the edge of a span counts with its inner part. A
    character that several tokens share belongs to the first of them.
    """
    n = len(offsets)
    mask, inner_from, inner_to = np.zeros(n, np.int8), np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not spans:
        return mask, inner_from, inner_to
    ends = np.maximum.accumulate(offsets[:, 1])
    begins = np.concatenate([[0], ends[:-1]])
    for begin, end in spans:
        first, last = np.searchsorted(ends, begin, "right"), np.searchsorted(begins, end, "left")
        if begin < end:
            own = slice(first, last)
            mask[own] = 1
            inner_from[own] = np.maximum(begins[own], begin)
            inner_to[own] = np.minimum(ends[own], end)
    return mask, inner_from, inner_to


def trained_text(formatted: str, mask, inner_from, inner_to) -> str:
    """All text under the mask, as it was before it was escaped."""
    pieces, run, at = [], [], -1
    for on, begin, end in zip(mask, inner_from, inner_to):
        if not on:
            continue
        if begin != at:
            pieces.append(unescape("".join(run)))
            run = []
        run.append(formatted[begin:end])
        at = end
    return "".join(pieces) + unescape("".join(run))


@lru_cache(maxsize=2)
def encoder(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


FORMATTED = ("n_turns bigint, formatted string, token_ids array<int>, loss_mask array<tinyint>, "
             "loss_from array<bigint>, loss_to array<bigint>")


def format_conversations(
    conversations: DataFrame, path: str, conversation: str = "conv_id", trained: str = "assistant"
) -> DataFrame:
    """One row per conversation: the rendered text, its tokens and the loss mask over them.

    Turns stand in order of ``turn`` (null first), equal turn numbers by role and text. Null roles
    and texts count as empty. Rows without a conversation id form one conversation. Other columns
    are not looked at; an empty table gives an empty one. Special strings in a text are ordinary
    text to the tokenizer. ``loss_from`` and ``loss_to`` give the characters of each masked token
    that count. A conversation is one text and is rendered by one task, in memory that follows its
    length; different conversations spread over all tasks.
    """
    rows = conversations.select(
        F.col(conversation).alias("conv_id"),
        F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    kind = conversations.schema[conversation].dataType.simpleString()
    ids = grouped.select("conv_id", "rows.role", "rows.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for i in range(batch.num_rows):
                turns = list(zip(batch["role"][i].as_py(), batch["text"][i].as_py()))
                formatted, spans = render(turns)
                encoding = encode(formatted, add_special_tokens=False)
                offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)
                own = [s for s, (role, _) in zip(spans, turns) if role == trained]
                mask, begins, ends = masked(offsets, own)
                yield pa.RecordBatch.from_arrays([
                    batch["conv_id"].slice(i, 1), pa.array([len(turns)], pa.int64()),
                    pa.array([formatted]), pa.array([encoding.ids], pa.list_(pa.int32())),
                    pa.array([mask], pa.list_(pa.int8())),
                    pa.array([begins], pa.list_(pa.int64())),
                    pa.array([ends], pa.list_(pa.int64())),
                ], names=["conv_id", *(f.split()[0] for f in FORMATTED.split(", "))])

    return ids.mapInArrow(run, f"conv_id {kind}, {FORMATTED}").withColumnRenamed(
        "conv_id", conversation)
