"""Byte-level BPE: overlapping chunks, stitched where they resynchronise.

A text longer than a chunk is cut into chunks that overlap.  Chunks are
pre-tokenised on their own, spread over the cluster; where the boundaries of
two neighbours meet again inside their overlap both agree from there on, so
the boundary lists are stitched at that place and the pieces are encoded.
If two neighbours never meet (a run without any common boundary) their text
is pre-tokenised again as one.  A text within one chunk is the same work
without a stitch and is not shuffled.  Decoding concatenates raw bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.rows import row_function

CHUNK = 1 << 15  # characters of a chunk
OVERLAP = 1 << 9  # characters that neighbours share on either side of a cut
GUARD = 3  # a boundary this near a chunk's end may change with the text after it
CACHE = 300_000  # pieces whose ids a Python worker remembers


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of lowest rank, leftmost first, is merged
    until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 128:
        return _merge_long(piece, ranks)
    get, none = ranks.get, len(ranks) << 1
    parts = [piece[i:i + 1] for i in range(len(piece))]
    rank = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while rank and (low := min(rank)) != none:
        i = rank.index(low)
        parts[i] += parts.pop(i + 1)
        del rank[i]
        if i < len(rank):
            rank[i] = get(parts[i] + parts[i + 1], none)
        if i:
            rank[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap over a linked list: n log n steps."""
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: end of the part that begins at i; 0 if merged away
    before = list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            r = ranks.get(piece[i:end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] != j or end[j] != k:
            continue
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Pieces(dict):
    """Piece -> its ids, packed; the pieces met first stay, up to a bound."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.packed = [i.to_bytes(4, "little") for i in range(max(ranks.values(), default=0) + 1)]

    def __missing__(self, piece: str) -> bytes:
        ids = b"".join([self.packed[i] for i in merge(piece.encode(), self.ranks)])
        if len(self) < CACHE and len(piece) <= 64:
            self[piece] = ids
        return ids


def boundaries(text: str, pattern) -> np.ndarray:
    """Ends of the pieces of ``text``, in characters."""
    return np.cumsum(np.fromiter(map(len, pattern.findall(text)), dtype=np.int64))


def chunks_of(text: str, size: int = CHUNK, overlap: int = OVERLAP) -> Iterator[tuple[int, int, str]]:
    """(number, begin, text) of the chunks of a text."""
    for no, at in enumerate(range(0, max(len(text), 1), size)):
        begin = max(0, at - overlap)
        yield no, begin, text[begin:at + size + overlap]


def stitch(chunks: list[tuple[int, str, np.ndarray]], pattern) -> list[str]:
    """Pieces of a text from its chunks (begin, text, boundaries), in order."""
    pieces: list[str] = []
    begin, text, ends = chunks[0]
    done = 0  # everything before is in pieces
    cut = lambda ends, begin, text, upto: [
        text[a - begin:b - begin] for a, b in zip(
            np.concatenate(([done], ends[(ends > done) & (ends < upto)])),
            ends[(ends > done) & (ends <= upto)])]
    ends = ends + begin
    for n_begin, n_text, n_ends in chunks[1:]:
        n_ends = n_ends + n_begin
        safe = ends[(ends > n_begin) & (ends > done) & (ends <= begin + len(text) - GUARD)]
        meet = np.intersect1d(safe, n_ends, assume_unique=True)
        if len(meet):
            pieces += cut(ends, begin, text, meet[0])
            done = int(meet[0])
            begin, text, ends = n_begin, n_text, n_ends
        else:  # no common boundary: one text from the last sure boundary on
            text = text[done - begin:n_begin - begin] + n_text if n_begin >= done else \
                n_text[done - n_begin:]
            begin = done
            ends = boundaries(text, pattern) + begin
    return pieces + cut(ends, begin, text, begin + len(text))


def _tools(ranks: dict[bytes, int], pattern: str, key: str):
    """(compiled pattern, piece cache), kept by the Python worker from task
    to task: Spark reuses workers, and pieces repeat."""
    import regex

    held = sys.modules.setdefault("_candlewick_worker", ModuleType("_candlewick_worker")).__dict__
    if key not in held:
        held[key] = regex.compile(pattern), Pieces(ranks)
    return held[key]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text", *, chunk: int = CHUNK, overlap: int = OVERLAP,
           round_trip: bool = False) -> DataFrame:
    """Encode every text, without special tokens.

    Returns one row per input row: ``id_col``, ``n_tokens`` and ``ids`` (the
    ids packed as little-endian unsigned 32-bit integers); with
    ``round_trip`` also ``decoded``, the ids decoded again in the same pass.  Null text counts
    as empty; an empty text has no ids.  Repeated rows give repeated results
    (a long text is told apart by a row number of the scan, not by its id).
    Other columns are not read.  ``ranks`` is the vocabulary, sent with the
    tasks; its size does not grow with the data.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()

    result = "struct<ids:binary,decoded:binary>" if round_trip else "struct<ids:binary>"

    def coded(pieces_of):
        """A row function's maker: ``pieces_of(find)`` gives the pieces of a value."""
        def make():
            find, cache = _tools(ranks, pattern, key)
            pieces, table = pieces_of(find), _tokens(ranks) if round_trip else None

            def one(x):
                ids = b"".join(map(cache.__getitem__, pieces(x)))
                return {"ids": ids, "decoded": _decoded(ids, table)} if round_trip else {"ids": ids}

            return one

        return make

    def ends():
        find, _ = _tools(ranks, pattern, key)
        return lambda t: boundaries(t, find).astype("<i4").tobytes()

    def cut():
        return lambda t: [{"no": no, "begin": begin, "text": part}
                          for no, begin, part in chunks_of(t, chunk, overlap)]

    def stitched(find):
        return lambda chunks: stitch([
            (c["begin"], c["text"], np.frombuffer(c["ends"], dtype="<i4").astype(np.int64))
            for c in chunks], find)

    whole = row_function(coded(lambda find: find.findall), result)
    join = row_function(coded(stitched), result)
    cuts = row_function(cut, "array<struct<no:bigint,begin:bigint,text:string>>")
    bounds = row_function(ends, "binary")
    one = base.where(F.char_length("text") <= chunk).select("id", whole("text").alias("r"))
    pieces = (base.where(F.char_length("text") > chunk)
              .withColumn("row", F.monotonically_increasing_id())
              .select("id", "row", F.explode(cuts("text")).alias("c")).select("id", "row", "c.*")
              .repartition("row", "no").withColumn("ends", bounds("text")))
    many = (pieces.groupBy("row").agg(
        F.first("id").alias("id"),
        F.sort_array(F.collect_list(F.struct("no", "begin", "text", "ends"))).alias("chunks"))
        .select("id", join("chunks").alias("r")))
    return one.unionByName(many).select(
        F.col("id").alias(id_col), F.floor(F.octet_length("r.ids") / 4).alias("n_tokens"), "r.*")


def _tokens(ranks: dict[bytes, int]) -> list[bytes]:
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


def _decoded(packed: bytes | None, table: list[bytes]) -> bytes | None:
    if packed is None:
        return None
    return b"".join(map(table.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``: the raw bytes of the packed ids, which
    need not be valid UTF-8.  A null list of ids decodes to null."""
    def to_bytes():
        table = _tokens(ranks)
        return lambda p: _decoded(p, table)

    return tokens.withColumn("decoded", row_function(to_bytes, "binary")(ids_col))


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken"):
    """(ranks, pattern) of an installed public tokenizer."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    ranks, pattern = public_vocabulary()
    tokens = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks, pattern, round_trip=True)
    return tokens.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
