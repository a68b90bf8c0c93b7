"""Chat formatting: conversations as token ids with an offset-aligned loss mask.

A conversation is rendered whole and its turns' spans are noted; the text is
encoded once, and the ends of the tokens are the running sums of their byte
lengths.  Spans and tokens are both sorted, so the tokens that a span covers
are found by binary search.  Control strings are tokens of their own, so no
token crosses the border of a turn; where a text says a control string itself
it is escaped, reversibly.

Rows are shuffled once, by conversation, and come to a task sorted: it holds
one segment, not a conversation.  Segments end at turns; as control strings are
tokens of their own, a conversation's ids are the same however it is cut.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from candlewick.llm import bpe

# The control strings.  A conversation is BEGIN and its turns; a
# turn is HEAD, role, BODY, text, END.
BEGIN, HEAD, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (BEGIN, END, HEAD, BODY)
LEARNED = ("assistant",)  # roles whose text is under the loss mask

SEGMENT = 1 << 18  # characters after which a segment ends at the next turn
BATCH_BYTES = 4 << 20  # size of a batch of segments

_SPLIT = re.compile(f"({'|'.join(map(re.escape, CONTROL))})")
_SAID = re.compile(r"([<\[])(\\*(?:/?s>|/?INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*(?:/?s>|/?INST\]))")


def escape(text: str) -> str:
    """A backslash goes behind the first character of what reads like a
    control string, with any number of backslashes already there."""
    return _SAID.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(turns: Iterable[tuple[str, str]], first: bool = True,
           learned: tuple[str, ...] = LEARNED) -> tuple[str, list[tuple[int, int]]]:
    """(text, spans in bytes of the learned roles' texts, in order)."""
    parts, spans, at = ([BEGIN], [], len(BEGIN)) if first else ([], [], 0)
    for role, text in turns:
        body = escape(text)
        head = f"{HEAD}{escape(role)}{BODY}"
        begin = at + len(head.encode())
        at = begin + len(body.encode())
        if role in learned and begin < at:
            spans.append((begin, at))
        at += len(END)
        parts += (head, body, END)
    return "".join(parts), spans


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a rendered text."""
    state, role, text = None, "", ""
    for k, part in enumerate(_SPLIT.split(formatted)):
        if k % 2 == 0:
            if state == HEAD:
                role = unescape(part)
            elif state == BODY:
                text = unescape(part)
            elif part:
                raise ValueError("text outside of a turn")
        else:
            if part == END:
                yield role, text
            state = part


class Encoder:
    """Ids and token ends of a rendered text.  The control strings have the
    ids after the largest rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, key: str):
        self.find, self.cache = bpe._tools(ranks, pattern, key)
        self.table = bpe._tokens(ranks)
        self.control = {c: (len(self.table) + k).to_bytes(4, "little") for k, c in enumerate(CONTROL)}
        self.table += [c.encode() for c in CONTROL]
        self.lengths = np.array([len(t) for t in self.table])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        pieces, out = self.cache.__getitem__, []
        for k, part in enumerate(_SPLIT.split(text)):
            if k % 2:
                out.append(self.control[part])
            elif part:
                out += map(pieces, self.find.findall(part))
        ids = np.frombuffer(b"".join(out), dtype="<u4")
        return ids, np.cumsum(self.lengths[ids])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))


def mask(ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """One byte per token: 1 if it lies in a span, even in part."""
    out = np.zeros(len(ends), dtype=np.uint8)
    if spans:
        begin, end = np.array(spans).T
        first = np.searchsorted(ends, begin, side="right")
        last = np.searchsorted(ends, end, side="left")  # the token that holds the span's last byte
        for a, b in zip(first, last):
            out[a:b + 1] = 1
    return out


def runs(loss: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the runs of tokens under the mask."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], loss, [0])).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


FORMATTED = "segment bigint, n_turns bigint, formatted string, ids binary, loss binary"


def _key(ranks: dict[bytes, int], pattern: str) -> str:
    return hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(id, role, text) of the rows of sorted batches, one at a time."""
    for batch in batches:
        for k in range(len(batch)):
            yield tuple(c[k].as_py() for c in batch.columns)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    make = lambda: pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    for row in rows:
        held.append(row)
        n += size(row)
        if n >= BATCH_BYTES:
            yield make()
            held, n = [], 0
    if held:
        yield make()


def _schemas(kind: T.DataType, id_col: str, fields: str) -> tuple[T.StructType, pa.Schema]:
    out = T.StructType([T.StructField(id_col, kind), *T._parse_datatype_string(fields).fields])
    return out, pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out])


def format_conversations(convs: DataFrame, ranks: dict[bytes, int], pattern: str,
                         id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", *, learned: tuple[str, ...] = LEARNED,
                         segment: int = SEGMENT) -> DataFrame:
    """Conversations as text, token ids and loss mask.

    Returns rows of (``id_col``, ``segment``, ``n_turns``, ``formatted``,
    ``ids``, ``loss``): ids as little-endian unsigned 32-bit integers, the mask
    as one byte per token (1: text of a role of ``learned``, never a control
    string).  A conversation is one row unless it is longer than ``segment``
    characters; then it goes on, at a turn, in the rows of the next numbers.
    All of its rows are in one partition, in order (see :func:`read_back`).

    Turns are in the order of turn, role and text, nulls first; repeated turns
    all stay.  A null role or text is empty; a turn without text is a turn.
    Rows without an id are one conversation.  Texts of any length are encoded
    whole; a task holds one segment, or one text if that is longer.  No rows
    give no rows.  Other columns are not read.
    """
    rows = convs.select(F.col(id_col).alias("c"), F.col(turn_col).alias("t"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("r"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("x"))
    rows = rows.repartition("c").sortWithinPartitions("c", "t", "r", "x").select("c", "r", "x")
    out, arrow = _schemas(rows.schema["c"].dataType, id_col, FORMATTED)
    key = _key(ranks, pattern)

    def segments(batches):
        encoder = Encoder(ranks, pattern, key)

        def row(conv, no, turns):
            text, spans = render(turns, no == 0, learned)
            ids, ends = encoder.encode(text)
            return conv, no, len(turns), text, ids.tobytes(), mask(ends, spans).tobytes()

        conv, no, turns, chars = None, 0, [], 0
        for c, r, x in _conversations(batches):
            if turns and (c != conv or chars >= segment):
                yield row(conv, no, turns)
                no, turns, chars = no + 1, [], 0
            if c != conv:
                conv, no = c, 0
            turns.append((r, x))
            chars += len(r) + len(x)
        if turns:
            yield row(conv, no, turns)

    def formatted(batches):
        yield from _batched(segments(batches), arrow, lambda r: 5 * len(r[3]))

    return rows.mapInArrow(formatted, out)


DIGESTS = ("n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint, n_tokens bigint")


def read_back(formatted: DataFrame, ranks: dict[bytes, int], pattern: str,
              id_col: str = "conv_id") -> DataFrame:
    """What a formatted table says, one row per conversation: the number of its
    turns and the digest of role, newline, text, newline of each, parsed from
    the text; the characters and the digest of what stands under the loss mask,
    decoded from the ids; the characters of the text and the number of ids.

    ``formatted`` is as :func:`format_conversations` returns it, with a
    conversation's rows in one partition and in order; digests run along."""
    out, arrow = _schemas(formatted.schema[id_col].dataType, id_col, DIGESTS)
    key = _key(ranks, pattern)

    def digests(batches):
        encoder = Encoder(ranks, pattern, key)
        conv, held = None, None

        def row():
            n, turns, chars, loss, text, tokens = held
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), text, tokens

        for c, text, ids, loss in _conversations(batches):
            if held is None or c != conv:
                if held is not None:
                    yield row()
                conv, held = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, said in parse(text):
                held[0] += 1
                held[1].update(f"{role}\n{said}\n".encode())
            ids = np.frombuffer(ids, dtype="<u4")
            for a, b in runs(np.frombuffer(loss, dtype=np.uint8)):
                said = unescape(encoder.decode(ids[a:b]).decode())
                held[2] += len(said)
                held[3].update(said.encode())
            held[4] += len(text)
            held[5] += len(ids)
        if held is not None:
            yield row()

    def read(batches):
        yield from _batched(digests(batches), arrow, lambda r: 256)

    return formatted.select(id_col, "formatted", "ids", "loss").mapInArrow(read, out)


# The conversation that says control strings itself.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_format(spark, sf_dir: str) -> DataFrame:
    convs = (spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
             .unionByName(spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")))
    ranks, pattern = bpe.public_vocabulary()
    out = read_back(format_conversations(convs, ranks, pattern), ranks, pattern)
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                        (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) AS p(conv_id, turn, r, x)),
e AS (SELECT *, length(regexp_replace(r, '([<\[])(\\*(/?s>|/?INST\]))', '\1\\\2', 'g'))
              + length(regexp_replace(x, '([<\[])(\\*(/?s>|/?INST\]))', '\1\\\2', 'g'))
              + length('[INST][/INST]</s>') AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
       coalesce(sum(length(x)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
       (sum(chars) + length('<s>'))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
