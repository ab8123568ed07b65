"""Chat formatting by columnar byte assembly.

Conversations are dealt out by their id and sorted by turn. Each batch of turns is formatted as columns: the lengths of all
segments (header, text, trailer of every turn) give cumulative offsets, numpy index arrays scatter headers and texts to their
places, and everything is copied into one preallocated buffer that becomes the Arrow string column as it is.

The template is ``<s>`` and then, turn by turn, ``[INST] text [/INST]``, `` text</s>``, ``<<SYS>>\\ntext\\n<</SYS>>`` for users,
assistants and the system, and ``<|role|>role<|text|>text<|end|>`` for every other role. A control string inside a text gets a
backslash behind its first character and every backslash is doubled; both come off again when the output is read. The loss
mask is the list of code point ranges that hold the assistant's texts.

Null texts are empty, null roles are the empty role, null turns come first; turns with equal numbers are sorted by role and
text, repeated rows stay repeated turns. Rows with a null conversation id are one conversation. A conversation is one output row,
so it must fit in memory; larger batches than ``SCATTER`` bytes are scattered in pieces and long texts are copied as slices. Empty
tables give empty results, other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

# The control strings of the template.
BEGIN, END = "<s>", "</s>"
USER = ("[INST] ", " [/INST]")
ASSISTANT = (" ", END)
SYSTEM = ("<<SYS>>\n", "\n<</SYS>>")
ROLE, TEXT, STOP = "<|role|>", "<|text|>", "<|end|>"
CONTROL = r"([\[<])(/?INST\]|/?s>|<SYS>>|</SYS>>|\|role\|>|\|text\|>|\|end\|>)"

SCATTER = 1 << 22
_SLICE = 1 << 16
_BACK = re.compile(r"\\(\\?)")
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>\n(?P<system>.*?)\n<</SYS>>|<\|role\|>(?P<role>.*?)<\|text\|>(?P<text>.*?)<\|end\|>"
    r"| (?P<assistant>.*?)</s>", re.S)
FORMATTED = "conv_id long, formatted string, loss array<struct<start:long,end:long>>"
READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def escape(texts):
    """An Arrow string column with control strings and backslashes escaped."""
    import pyarrow.compute as pc

    return pc.replace_substring_regex(pc.replace_substring(texts, "\\", "\\\\"), CONTROL, r"\1\\\2")


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def _buffer(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and lengths of an Arrow large_string column without nulls."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets[:-1], np.diff(offsets)


def _scatter(out: np.ndarray, to: np.ndarray, source: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copy ``source[start:start + length]`` to ``out[to:]`` for all segments."""
    for k in np.flatnonzero(length >= _SLICE):
        out[to[k]: to[k] + length[k]] = source[start[k]: start[k] + length[k]]
    short = np.flatnonzero((length < _SLICE) & (length > 0))
    if not len(short):
        return
    to, start, length = to[short], start[short], length[short]
    ends = np.cumsum(length)
    piece = ends // SCATTER
    for a, b in zip(*(lambda c: (np.r_[0, c], np.r_[c, len(length)]))(np.flatnonzero(np.diff(piece)) + 1)):
        n = length[a:b]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to[a:b], n) + within] = source[np.repeat(start[a:b], n) + within]


def assemble(conversation: np.ndarray, role, text):
    """Formatted strings and loss ranges of whole conversations, whose turns stand together in order.

    ``conversation``: a number per turn that rises from one conversation to the next. ``role`` and ``text`` are Arrow columns
    without nulls. Returns the Arrow columns of one row per conversation.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    role, text = role.cast(pa.large_string()), escape(text.cast(pa.large_string()))
    known = {"user": USER, "assistant": ASSISTANT, "system": SYSTEM}
    coded = pc.dictionary_encode(role).combine_chunks() if isinstance(role, pa.ChunkedArray) else pc.dictionary_encode(role)
    names = coded.dictionary.to_pylist()
    escaped = escape(pa.array(names, pa.large_string())).to_pylist()
    pairs = [known.get(n) or (f"{ROLE}{e}{TEXT}", STOP) for n, e in zip(names, escaped)]
    kind = coded.indices.to_numpy(zero_copy_only=False)
    first = np.r_[True, conversation[1:] != conversation[:-1]]

    # Segments of every turn: the beginning of the conversation (first turns only), header, text, trailer.
    parts = pa.array([BEGIN, *(h for h, _ in pairs), *(t for _, t in pairs)], pa.large_string())
    fixed, fixed_at, fixed_bytes = _buffer(parts)
    fixed_chars = pc.utf8_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    body, body_at, body_bytes = _buffer(text)
    body_chars = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    head, tail, zero = 1 + kind, 1 + len(pairs) + kind, np.zeros(len(kind), np.int64)
    lengths = np.stack([np.where(first, fixed_bytes[0], 0), fixed_bytes[head], body_bytes, fixed_bytes[tail]], axis=1)
    chars = np.stack([np.where(first, fixed_chars[0], 0), fixed_chars[head], body_chars, fixed_chars[tail]], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]), np.uint8)
    for column, (source, at) in enumerate(((fixed, zero), (fixed, fixed_at[head]), (body, body_at), (fixed, fixed_at[tail]))):
        _scatter(out, starts[:, column], source, at, lengths[:, column])

    begin = np.flatnonzero(first)
    offsets = np.r_[starts[begin, 0], len(out)].astype(np.int64)
    formatted = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(out)])

    number = np.cumsum(first) - 1
    char_ends = np.cumsum(chars.ravel()).reshape(chars.shape)
    base = (char_ends - chars)[begin, 0][number]
    masked = np.flatnonzero(np.array([n == "assistant" for n in names], bool)[kind])
    ranges = pa.StructArray.from_arrays(
        [pa.array((char_ends[:, 2] - chars[:, 2] - base)[masked]), pa.array((char_ends[:, 2] - base)[masked])], names=["start", "end"])
    per = np.bincount(number[masked], minlength=len(begin))
    loss = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)].astype(np.int32)), ranges)
    return formatted, loss


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss."""
    empty = F.lit("")
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text"))

    def run(batches):
        import pyarrow as pa

        def done(table):
            ids = table.column("conv_id").combine_chunks()
            plain = ids.fill_null(0).to_numpy(zero_copy_only=False)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            change = np.r_[True, (plain[1:] != plain[:-1]) | (null[1:] != null[:-1])]
            one = lambda c: pa.concat_arrays([x.cast(pa.large_string()) for x in table.column(c).chunks])
            formatted, loss = assemble(np.cumsum(change), one("role"), one("text"))
            return pa.RecordBatch.from_arrays(
                [ids.take(pa.array(np.flatnonzero(change))), formatted.cast(pa.string()), loss], names=["conv_id", "formatted", "loss"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch.select(["conv_id", "role", "text"])])
            held = table if held is None else pa.concat_tables([held, table])
            ids = held.column("conv_id")
            last = ids[len(ids) - 1].as_py()
            # The last conversation may go on in the next batch.
            cut = len(ids)
            while cut and ids[cut - 1].as_py() == last:
                cut -= 1
            if cut:
                yield done(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield done(held)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    if not formatted.startswith(BEGIN):
        raise ValueError("not a formatted conversation")
    out, at = [], len(BEGIN)
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        role = unescape(m["role"]) if kind == "text" else kind
        out.append((role, unescape(m[kind])))
        at = m.end()
    return out


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and loss text of formatted conversations, as counts and digests."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
                turns = parse(formatted)
                digest = hashlib.sha256()
                for role, text in turns:
                    digest.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                learned = "".join(unescape(formatted[r["start"]:r["end"]]) for r in loss)
                rows.append((conv, len(turns), digest.hexdigest(), len(learned),
                             hashlib.sha256(learned.encode("utf-8", "surrogatepass")).hexdigest(), len(formatted)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=list(names))

    return chats.mapInArrow(run, READ)
