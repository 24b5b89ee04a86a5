"""Chat formatting by columnar byte assembly.

Method.  Turns arrive sorted by conversation and turn.  Per Arrow batch, texts
and roles are escaped as columns; segment lengths, cumulative offsets and
scatter indices are computed in numpy, and headers and contents are copied into
one preallocated buffer that becomes the string column.  A conversation longer
than a batch continues in further chunks, so memory stays bounded.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import materialize, n_partitions, pick, ranges, raw_buffers

# Template: <s><|role|>text</s> per turn.  A control string inside a text or
# role gets its first character replaced; a backslash is doubled.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>")
OPEN, MIDDLE, CLOSE = b"<s><|", b"|>", b"</s>"
_PLAIN = {"\\\\": "\\", "\\l": "<", "\\b": "[", "\\p": "|"}
_TURN = re.compile(r"<s><\|(.*?)\|>(.*?)</s>", re.S)
_CHUNKS = "conv_id bigint, chunk int, formatted string, turns int, loss array<struct<first:int,end:int>>"


def escape(texts: pa.Array) -> pa.Array:
    texts = pc.replace_substring(pc.fill_null(texts, ""), "\\", "\\\\")
    texts = pc.replace_substring_regex(texts, r"<(/?s>|</?SYS>>|\|)", r"\\l\1")
    texts = pc.replace_substring_regex(texts, r"\[(/?INST\])", r"\\b\1")
    return pc.replace_substring(texts, "|>", "\\p>")


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: _PLAIN[m[0]], text) if "\\" in text else text


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start of each turn with the end appended, text start, text end)."""
    sources = [(np.array([0, len(x)]), np.frombuffer(x, np.uint8)) for x in (OPEN, MIDDLE, CLOSE)]
    role, text = raw_buffers(escape(roles)), raw_buffers(escape(texts))
    n = len(texts)
    columns = [sources[0], role, sources[1], text, sources[2]]
    lengths = np.stack([np.diff(offsets) if k in (1, 3) else np.full(n, len(data))
                        for k, (offsets, data) in enumerate(columns)], axis=1)
    flat = lengths.ravel()
    at = (np.cumsum(flat) - flat).reshape(n, 5)
    out = np.empty(int(flat.sum()), dtype=np.uint8)
    for k, (offsets, data) in enumerate(columns):
        own = offsets[:-1] if k in (1, 3) else np.zeros(n, np.int64)
        out[ranges(at[:, k], lengths[:, k])] = data[ranges(own, lengths[:, k])]
    return out, np.append(at[:, 0], len(out)), at[:, 3], at[:, 3] + lengths[:, 3]


def _format_pass(trained: tuple[str, ...]):
    spans = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        current, chunk = object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_pylist()
            roles = pc.fill_null(batch.column("role"), "")
            data, starts, first, end = assemble(roles, batch.column("text"))
            cuts = [0] + [i for i in range(1, len(ids)) if ids[i] != ids[i - 1]] + [len(ids)]
            learn = np.isin(np.array(roles.to_pylist(), dtype=object), list(trained))
            chunks, loss = [], []
            for a, b in zip(cuts[:-1], cuts[1:]):
                chunk = chunk + 1 if current == ids[a] else 0
                current = ids[a]
                chunks.append(chunk)
                base = starts[a]
                loss.append([{"first": int(first[i] - base), "end": int(end[i] - base)} for i in range(a, b) if learn[i]])
            offsets = starts[cuts]
            text = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()),
                                                    pa.py_buffer(data)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[a] for a in cuts[:-1]], pa.int64()), pa.array(chunks, pa.int32()), text,
                 pa.array(np.diff(cuts).astype(np.int32)), pa.array(loss, spans)],
                ["conv_id", "chunk", "formatted", "turns", "loss"])
    return run


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, chunk, formatted, turns, loss): the formatted conversation and the
    byte ranges of the texts to be learned.

    Rows are taken by turn, then role and text for equal turns (nulls first).
    Null text and role count as empty; rows without conv_id form one
    conversation.  A conversation over several batches has chunks 0, 1, ...
    Extra columns are ignored; an empty table gives no rows.
    """
    mine = pick(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    mine = mine.withColumn("conv_id", F.col("conv_id").cast("bigint"))
    dealt = mine.repartition(n_partitions(turns.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format_pass(trained), _CHUNKS)


def _read_pass(batches):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def fresh(conv):
        return {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "all": 0}

    def rows(states):
        return pa.RecordBatch.from_arrays(
            [pa.array([s["conv"] for s in states], pa.int64()), pa.array([s["n"] for s in states], pa.int64()),
             pa.array([s["turns"].hexdigest() for s in states], pa.string()),
             pa.array([s["chars"] for s in states], pa.int64()),
             pa.array([s["loss"].hexdigest() for s in states], pa.string()),
             pa.array([s["all"] for s in states], pa.int64())], names)

    state = None
    for batch in batches:
        done = []
        for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
            if state is None or state["conv"] != conv:
                if state is not None:
                    done.append(state)
                state = fresh(conv)
            state["all"] += len(formatted)
            for m in _TURN.finditer(formatted):
                state["n"] += 1
                state["turns"].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            raw = formatted.encode()
            for x in loss:
                text = unescape(raw[x["first"]:x["end"]].decode())
                state["chars"] += len(text)
                state["loss"].update(text.encode())
        if done:
            yield rows(done)
    if state is not None:
        yield rows([state])


def read_chats(chunks: DataFrame) -> DataFrame:
    """Parse formatted chunks back and digest every conversation."""
    dealt = chunks.repartition(n_partitions(chunks.sparkSession), "conv_id").sortWithinPartitions("conv_id", "chunk")
    return dealt.select("conv_id", "formatted", "loss").mapInArrow(
        _read_pass, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                    "formatted_chars bigint")


def chat_round_trip(turns: DataFrame) -> DataFrame:
    return read_chats(materialize(format_chats(turns), "chats"))
