"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``; the turns of a conversation
follow one another. Control strings inside a text or role are escaped reversibly:
``<``, any number n of backslashes, ``|im_start|>`` or ``|im_end|>`` gets one
backslash more, so an unescaped control string only ever comes from the template.
In a role, backslashes and line feeds are written ``\\\\`` and ``\\n`` before that.

For a batch of turns the lengths of headers, contents and trailers are taken from
Arrow offsets, their places come from cumulative sums, and every byte is scattered
once into one preallocated buffer, which becomes the Arrow string column. The loss
mask is a list of (start, length) byte spans: the content of each assistant turn.

Turns are dealt by conversation and sorted by (turn, role, text), so equal turn
numbers have a defined order and a repeated row is a turn of its own. Null text and
null role are empty; a null conversation id is a conversation; null turns come first.
A conversation's output is one row, so one conversation is the unit of memory; a
task holds one Arrow batch and the conversation that it is in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import _ragged as R
from gridloom.llm._spark import schema_of, slots, whole_ids

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPE = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_UNESCAPE = re.compile(r"<(\\*)\\\|(im_start|im_end)\|>")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|\2|>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _escaped(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts; only texts that hold a control word are looked at one by one."""
    column = column.fill_null("")
    hit = pc.match_substring_regex(column, r"\|im_(start|end)\|>")
    if pc.any(hit).as_py():
        column = pa.array([escape(t) if h else t for t, h in zip(column.to_pylist(), hit.to_pylist(), strict=True)], pa.large_string())
    return R.text_bytes(column)


def _scatter(out: np.ndarray, data: np.ndarray, at: np.ndarray, to: np.ndarray) -> None:
    """Copy the pieces data[at[i]:at[i+1]] to out[to[i]:]."""
    if len(data):
        out[np.arange(len(data)) + np.repeat(to - at[:-1], np.diff(at))] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, turn offsets, content starts, content lengths) of formatted turns."""
    body, body_at = _escaped(texts)
    coded = roles.fill_null("").dictionary_encode()
    heads = [f"{START}{escape_role(r)}\n".encode() for r in coded.dictionary.to_pylist()]
    kinds = coded.indices.to_numpy(zero_copy_only=False)
    head_sizes = np.array([len(h) for h in heads], np.int64)[kinds] if len(kinds) else np.empty(0, np.int64)
    tail = np.frombuffer(f"{END}\n".encode(), np.uint8)
    size = np.diff(body_at)
    turn_at = np.concatenate(([0], np.cumsum(head_sizes + size + len(tail))))
    out = np.empty(int(turn_at[-1]), np.uint8)
    content = turn_at[:-1] + head_sizes
    for k, head in enumerate(heads):
        own = turn_at[:-1][kinds == k]
        out[(own[:, None] + np.arange(len(head))).ravel()] = np.tile(np.frombuffer(head, np.uint8), len(own))
    _scatter(out, body, body_at, content)
    out[(turn_at[1:, None] - len(tail) + np.arange(len(tail))).ravel()] = np.tile(tail, len(kinds))
    return out, turn_at, content, size


def format_chats(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for each conversation: conv_id, n_turns, formatted, loss_spans (array of byte start and length)."""
    rows = turns.select(whole_ids(turns, conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    dealt = rows.repartition(slots(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    schema = schema_of("conv_id long, n_turns long, formatted string, loss_spans array<struct<start:long,length:long>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column(0)
            keys, missing = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (missing[1:] != missing[:-1]))))
            last = np.append(first[1:], len(keys))
            data, turn_at, content, size = assemble(batch.column(1), batch.column(2))
            conv_at = np.append(turn_at[first], turn_at[-1])
            text = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(conv_at.astype(np.int64)), pa.py_buffer(data)])
            voiced = pc.equal(batch.column(1).fill_null(""), "assistant").to_numpy(zero_copy_only=False)
            which = np.flatnonzero(voiced)
            owner = np.searchsorted(first, which, side="right") - 1
            spans = pa.StructArray.from_arrays([pa.array(content[which] - conv_at[owner]), pa.array(size[which])], ["start", "length"])
            by = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(first))))).astype(np.int32)
            columns = [ids.take(pa.array(first)), pa.array(last - first), text.cast(pa.string()), pa.ListArray.from_arrays(pa.array(by), spans)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "n_turns", "formatted", "loss_spans"])

        def whole(some: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.Table.from_batches(some).combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_pylist()
            cut = len(ids)  # turns from here on may go on in the next batch
            while cut and ids[cut - 1] == ids[-1]:
                cut -= 1
            if cut:
                yield made(whole([*held, batch.slice(0, cut)]))
                held = []
            elif held and held[-1].column(0)[0].as_py() != ids[-1]:
                yield made(whole(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield made(whole(held))

    return dealt.mapInArrow(run, schema)


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from formatted text and loss spans alone."""
    schema = schema_of("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        from gridloom.llm.chat_format import read_turns, unescape

        for batch in batches:
            out: list[tuple] = []
            for conv, text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_turns(text)
                data = text.encode()
                loss = "".join(unescape(data[s["start"] : s["start"] + s["length"]].decode()) for s in spans)
                joined = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append((conv, len(turns), sha256(joined.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return chats.select("conv_id", "formatted", "loss_spans").mapInArrow(run, schema)
