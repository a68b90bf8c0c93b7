"""Source divergence audit: how the sources of a language differ in their terms.

Terms are counted by single-pass in-memory indexing.  A task fills a block of
postings (term -> documents, and count per source) until its memory bound,
then spills it as runs in term order, cut into pieces and dealt to hash shards.
A shard receives the pieces of all runs by their first term and merges them
with a heap that holds only pieces whose range has been reached, so neither
side holds more than blocks and open pieces.  What comes out is one row per
term with all its counts.

Divergences are sums over all kept terms, most of which most sources lack.  A
pair of sources starts from the value that terms without a count in either
give, gets a correction per source and distinct count, and is then corrected
from the stream of terms for those that both have; corrections are added up in
the task before anything is returned.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import written

# Scale of the probabilities, least documents of a term, ranks
# that the term report lists.
SCALE, MIN_DOCS, TOP_TERMS = 1_000_000_000, 3, 200

BLOCK_BYTES = 48 << 20  # size at which a block is spilled
ENTRY_BYTES = 180  # a term of a block beside its text
POSTING_BYTES = 24
WORDS = 1 << 19  # words that are counted at once
PART = 1 << 22  # bytes of a text that are split at once
PIECE = 2048  # terms of a piece of a run
ROUND = 1 << 18  # open terms from which a merge moves on before its next piece
CELLS = 1 << 20  # pairs corrected at once
PAIRS = 1 << 20  # sums of pairs that a task holds

# bytes of terms as they are, but A-Z lower-cased; all others become blanks
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> Iterator[list[bytes]]:
    """Runs of ASCII letters and non-ASCII characters, A-Z lower-cased, of one
    part of the text after the other; parts end at blanks."""
    data, at = text.encode().translate(FOLD), 0
    while at < len(data):
        end = data.find(b" ", at + PART)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, in order, and the sums of the values of each."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return (keys[starts], *[np.add.reduceat(v[order], starts) for v in values])


class Numbers(dict):
    """Value -> its number, in the order in which they come."""

    def __missing__(self, value) -> int:
        self[value] = n = len(self)
        return n


class Block:
    """Postings in memory: occurrences and documents per (language, source)
    and term, as arrays of (group and term number, occurrences, documents)."""

    def __init__(self):
        self.terms, self.groups = Numbers(), Numbers()
        self.waiting: list[tuple[int, np.ndarray]] = []  # (group, term numbers) of documents
        self.words = self.size = 0
        self.postings: list[tuple[np.ndarray, ...]] = []

    def add(self, lang: str, source: str, text: str) -> None:
        group, before = self.groups[lang, source], len(self.terms)
        parts = [np.fromiter(map(self.terms.__getitem__, words), dtype=np.int64, count=len(words))
                 for words in terms_of(text)]
        if len(self.terms) > before:  # their text is at most the document's
            self.size += (len(self.terms) - before) * ENTRY_BYTES + len(text)
        if len(parts) > 1:  # a very long text: its distinct terms by themselves
            ids, n = added(*map(np.concatenate, zip(*[np.unique(p, return_counts=True) for p in parts])))
            self._post(group << 32 | ids, n, np.ones_like(n))
        elif parts and len(parts[0]):
            self.waiting.append((group, parts[0]))
            self.words += len(parts[0])
            if self.words >= WORDS:
                self.count()

    def _post(self, *arrays: np.ndarray) -> None:
        self.postings.append(arrays)
        self.size += POSTING_BYTES * len(arrays[0])

    def count(self) -> None:
        """Count the waiting documents' terms: first per document, then per group."""
        if self.waiting:
            lengths = [len(ids) for _, ids in self.waiting]
            doc = np.repeat(np.arange(len(lengths)), lengths)
            keys, n = np.unique(doc << 32 | np.concatenate([ids for _, ids in self.waiting]), return_counts=True)
            group = np.array([g for g, _ in self.waiting])[keys >> 32]
            self._post(*added(group << 32 | keys & 0xFFFFFFFF, n, np.ones_like(n)))
        self.waiting, self.words = [], 0

    def runs(self, shards: int) -> Iterator[tuple]:
        """Rows of ``RUN``: the postings in term order per hash shard and
        language, in pieces."""
        self.count()
        if not self.postings:
            return
        keys, counts, docs = added(*map(np.concatenate, zip(*self.postings)))
        self.postings = []
        terms, groups = list(self.terms), list(self.groups)
        group, term = keys >> 32, keys & 0xFFFFFFFF
        langs = Numbers()
        lang = np.array([langs[name] for name, _ in groups])[group]
        shard = np.array([zlib.crc32(t) % shards for t in terms])[term]
        rank = np.empty(len(terms), dtype=np.int64)
        rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
        order = np.lexsort((group, rank[term], lang, shard))
        group, term, lang, shard, counts, docs = (x[order] for x in (group, term, lang, shard, counts, docs))
        new = np.concatenate(([True], (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])))
        firsts = np.flatnonzero(new)  # the first posting of every entry
        place = (shard << 32 | lang)[firsts]
        cuts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        names = list(langs)
        for a, b in zip(cuts, [*cuts[1:], len(firsts)]):
            for at in range(a, b, PIECE):
                end = min(at + PIECE, b)
                lo, hi = firsts[at], firsts[end] if end < len(firsts) else len(term)
                own = [terms[t] for t in term[firsts[at:end]].tolist()]
                used, source = np.unique(group[lo:hi], return_inverse=True)
                yield (int(shard[lo]), names[lang[lo]], own[0], b" ".join(own),
                       np.diff(np.append(firsts[at:end], hi)).astype("<i4").tobytes(),
                       [groups[g][1] for g in used.tolist()], source.astype("<i4").tobytes(),
                       counts[lo:hi].astype("<i8").tobytes(), docs[lo:hi].astype("<i8").tobytes())


RUN = ("shard int, lang string, first binary, terms binary, sizes binary, sources array<string>, "
       "source binary, counts binary, docs binary")


@dataclass
class Piece:
    """A piece of a run, read up to the entry ``at``."""
    terms: list[bytes]
    sizes: np.ndarray
    source: np.ndarray
    counts: np.ndarray
    docs: np.ndarray
    at: int = 0

    def take(self, end: int, place: list[int]) -> tuple[np.ndarray, ...]:
        """(place << 32 | source, counts, docs) of the postings of the entries
        up to ``end``, whose terms have the given places."""
        lo, hi = int(self.sizes[:self.at].sum()), int(self.sizes[:end].sum())
        spread = np.repeat(np.array(place, dtype=np.int64), self.sizes[self.at:end])
        self.at = end
        return spread << 32 | self.source[lo:hi], self.counts[lo:hi], self.docs[lo:hi]


def merged(rows: Iterator[tuple], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``TERMS`` from rows of ``RUN`` that come by shard, language and
    first term.  Pieces are opened as they come; a heap merges them up to the
    first term of the next one, once enough is open."""
    place, sources, open_ = None, Numbers(), []

    def due(bound: bytes | None) -> Iterator[pa.RecordBatch]:
        nonlocal open_
        ends = [len(p.terms) if bound is None else bisect_left(p.terms, bound, p.at) for p in open_]
        heads = [zip(p.terms[p.at:end], repeat(k)) for k, (p, end) in enumerate(zip(open_, ends))]
        terms: list[bytes] = []
        places: list[list[int]] = [[] for _ in open_]
        last = None
        for t, k in heapq.merge(*heads):
            if t != last:
                terms.append(t)
                last = t
            places[k].append(len(terms) - 1)
        if terms:
            taken = [p.take(end, own) for p, end, own in zip(open_, ends, places)]
            yield from _kept(place[1], terms, list(sources), added(*map(np.concatenate, zip(*taken))), min_docs)
        open_ = [p for p in open_ if p.at < len(p.terms)]

    for shard, lang, first, terms, sizes, names, source, counts, docs in rows:
        if place != (shard, lang):
            yield from due(None)
            place, sources = (shard, lang), Numbers()
        elif sum(len(p.terms) - p.at for p in open_) >= ROUND:
            yield from due(first)
        number = np.array([sources[s] for s in names], dtype=np.int64)
        open_.append(Piece(terms.split(b" "), np.frombuffer(sizes, "<i4"), number[np.frombuffer(source, "<i4")],
                           np.frombuffer(counts, "<i8"), np.frombuffer(docs, "<i8")))
    yield from due(None)


TERMS = "lang string, term string, docs bigint, total bigint, sources array<string>, counts array<bigint>"


def _kept(lang: str, terms: list[bytes], sources: list[str], sums: tuple[np.ndarray, ...],
          min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``TERMS`` for the terms that enough documents hold."""
    keys, counts, docs = sums
    term = keys >> 32
    starts = np.searchsorted(term, np.arange(len(terms) + 1))
    total, held = (np.add.reduceat(x, starts[:-1]) for x in (counts, docs))
    keep = np.flatnonzero(held >= min_docs)
    for at in range(0, len(keep), 4096):
        own = keep[at:at + 4096]
        sizes = starts[own + 1] - starts[own]
        ends = np.cumsum(sizes)
        rows = np.repeat(starts[own] - (ends - sizes), sizes) + np.arange(ends[-1])
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(own)), pa.array([terms[k].decode() for k in own.tolist()]),
            pa.array(held[own]), pa.array(total[own]),
            pa.ListArray.from_arrays(offsets, pa.array(sources).take(pa.array(keys[rows] & 0xFFFFFFFF))),
            pa.ListArray.from_arrays(offsets, pa.array(counts[rows]))],
            names=["lang", "term", "docs", "total", "sources", "counts"])


def _batches(rows: Iterator[tuple], schema: pa.Schema, n: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == n:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)],
                                      schema=schema)


def labelled(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, text with null as the empty text."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def frequencies(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                *, min_docs: int = MIN_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, term, docs, total, sources, counts): the terms that at least
    ``min_docs`` rows of their language hold, and their occurrences in every
    source that has one.  Rows are documents, repeated ones too.  Null
    language, source or text: the empty text; texts of any length are read
    whole, an empty one has no term.  Other columns are not read."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("first", pa.binary()), ("terms", pa.binary()),
                     ("sizes", pa.binary()), ("sources", pa.list_(pa.string())),
                     *[(c, pa.binary()) for c in ("source", "counts", "docs")]])

    def index(batches):
        block = Block()
        for batch in batches:
            langs, sources, texts = batch.columns
            for k in range(len(batch)):
                block.add(langs[k].as_py(), sources[k].as_py(), texts[k].as_py())
                if block.size >= block_bytes:
                    yield from _batches(block.runs(shards), run, 64)
                    block = Block()
        yield from _batches(block.runs(shards), run, 64)

    def merge(batches):
        yield from merged((tuple(c[k].as_py() for c in batch.columns) for batch in batches
                           for k in range(len(batch))), min_docs)

    runs = labelled(docs, text_col, lang_col, source_col).mapInArrow(index, RUN)
    return (runs.repartition("shard").sortWithinPartitions("shard", "lang", "first")
            .mapInArrow(merge, TERMS))


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact; null if there
    are no terms."""
    wide = lambda c: c.cast("decimal(38,0)")
    whole = F.call_function("div", wide(count + 1) * F.lit(SCALE), wide(F.nullif(total + terms, F.lit(0))))
    return whole.cast("bigint") + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q), exact: the square stays below 2^63."""
    return F.call_function("div", (p - q) * (p - q), q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class PairSums:
    """Sums per pair of sources, added up in arrays of bounded size."""

    def __init__(self):
        self.numbers = Numbers()
        self.sums = (np.zeros(0, dtype=np.int64),) * 2

    def terms(self, names: np.ndarray, sizes: np.ndarray, p: np.ndarray, zero: np.ndarray) -> None:
        """The corrections of some terms for all pairs of the sources that hold
        them: ``sizes`` sources each, given by number, p and p without a count."""
        starts = np.cumsum(sizes) - sizes
        first = np.repeat(starts, sizes)  # of the term that a source stands in
        many = np.repeat(sizes, sizes)
        total = np.cumsum(many)
        at = 0
        while at < len(many):  # a stripe of sources, each with all of its partners
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CELLS)))
            a = np.repeat(np.arange(at, end), many[at:end])
            own = np.cumsum(many[at:end])
            b = np.repeat(first[at:end] - (own - many[at:end]), many[at:end]) + np.arange(own[-1])
            pa_, pb, za, zb = p[a], p[b], zero[a], zero[b]
            value = _distance(pa_, pb) - _distance(pa_, zb) - _distance(za, pb) + _distance(za, zb)
            new = added(names[a] << 32 | names[b], value)
            self.sums = added(*map(np.concatenate, zip(self.sums, new)))
            at = end

    def rows(self) -> Iterator[tuple[str, str, str, int]]:
        names = list(self.numbers)
        for key, value in zip(*(x.tolist() for x in self.sums)):
            (lang, a), (_, b) = names[key >> 32], names[key & 0xFFFFFFFF]
            if a != b:
                yield lang, a, b, value
        self.__init__()


def shared_terms(rows: DataFrame) -> DataFrame:
    """(lang, source, item, value): corrections of pairs for the terms that
    both sources hold, from (lang, held: source, p, zero) rows."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def correct(batches):
        sums = PairSums()
        for batch in batches:
            langs, held = batch.columns
            if not len(batch):
                continue
            sizes = held.value_lengths().to_numpy()
            source, p, zero = held.flatten().flatten()
            lang, source = langs.dictionary_encode(), source.dictionary_encode()
            pair = np.repeat(lang.indices.to_numpy(), sizes).astype(np.int64) << 32 | source.indices.to_numpy()
            there, place = np.unique(pair, return_inverse=True)
            number = np.array([sums.numbers[lang.dictionary[k >> 32].as_py(), source.dictionary[k & 0xFFFFFFFF].as_py()]
                               for k in there.tolist()])
            sums.terms(number[place], sizes.astype(np.int64), p.to_numpy(), zero.to_numpy())
            if len(sums.sums[0]) > PAIRS:
                yield from _batches(sums.rows(), schema)
        yield from _batches(sums.rows(), schema)

    return rows.select("lang", "held").mapInArrow(correct, "lang string, source string, item string, value bigint")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *,
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Divergence of every source of a language from each other source, and
    the terms that set it apart from its language.

    Returns (lang, source, part, item, value, rank).  Part ``pair``: ``item`` is
    another source of the language and ``value`` the sum of
    floor((p - q)^2 / q) over the language's kept terms (0 if there is none),
    p the source's and q the item's smoothed probability, in whole billionths.
    Part ``term``: ``item`` is a term of the source with p above the language's
    q; the first ``top_terms`` of a source.  Ranks are by falling value, then
    by item in byte order.

    Null language, source or text count as the empty text, so sources without
    a name are one source.  A source without a kept term has pairs and no
    terms; a source alone in its language has no pairs; no rows give no rows.
    Repeated rows are documents of their own.  Other columns are not read.
    Pairs of sources are the result's size: all arithmetic is exact.
    """
    freq = written(frequencies(docs, text_col, lang_col, source_col, min_docs=min_docs,
                               block_bytes=block_bytes), "frequencies")
    entries = freq.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "total", F.col("e.sources").alias("source"), F.col("e.counts").alias("count"))
    per_source = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    per_lang = freq.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    there = labelled(docs, text_col, lang_col, source_col).select("lang", "source").distinct()
    none = F.lit(0).cast("long")
    groups = there.join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, none).alias(c) for c in ("n", "v", "n_lang")])
    # a side of its own: small, it is broadcast by size, else AQE splits the other
    groups = written(groups.withColumn("zero", probability(none, F.col("n"), F.col("v"))), "sources")

    rated = entries.join(groups, ["lang", "source"]).withColumn(
        "p", probability(F.col("count"), F.col("n"), F.col("v")))
    rated = written(rated.select("lang", "source", "term", "p", "zero", probability(
        F.col("total"), F.col("n_lang"), F.col("v")).alias("q")), "rated-terms")

    # value of a pair = terms that both lack + what either has + what both have
    a, b = (groups.select("lang", F.col("source").alias(s), F.col("zero").alias(z), "v")
            for s, z in (("source", "za"), ("item", "zb")))
    pairs = a.join(b.drop("v"), "lang").where("source <> item").withColumn(
        "value", F.coalesce(F.col("v") * distance(F.col("za"), F.col("zb")), none))
    levels = rated.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("m"))
    own = F.col("m") * (distance(F.col("p"), F.col("zb")) - distance(F.col("zero"), F.col("zb")))
    other = F.col("m") * (distance(F.col("zb"), F.col("p")) - distance(F.col("zb"), F.col("zero")))
    one_has = (levels.join(b.drop("v"), "lang").where("source <> item")
               .groupBy("lang", "source", "item").agg(
                   F.sum(own.cast("decimal(38,0)")).alias("own"), F.sum(other.cast("decimal(38,0)")).alias("other"))
               .select(F.explode(F.array(
                   F.struct("lang", "source", "item", F.col("own").alias("value")),
                   F.struct("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                            F.col("other").alias("value")))).alias("r")).select("r.*"))
    both_have = shared_terms(rated.groupBy("lang", "term").agg(
        F.collect_list(F.struct("source", "p", "zero")).alias("held")))
    summed = reduce(DataFrame.unionByName, [
        x.select("lang", "source", "item", F.col("value").cast("decimal(38,0)").alias("value"))
        for x in (pairs, one_has, both_have)])
    summed = summed.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                           F.row_number().over(order).alias("rank"))

    told = rated.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                       distance(F.col("p"), F.col("q")).alias("value"))
    # ranks are cut in every task before the shuffle
    return ranked(summed, "pair").unionByName(ranked(told, "term").where(F.col("rank") <= top_terms))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
           FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT s.lang, s.source, coalesce(sum(c.c), 0)::HUGEINT AS n
      FROM s LEFT JOIN c ON c.lang = s.lang AND c.source = s.source GROUP BY ALL),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c,
             1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (n.n + v.v) AS p,
             1 + (1000000000::HUGEINT * (k.total + 1)) // (v.n + v.v) AS q
      FROM n JOIN v ON v.lang = n.lang JOIN k ON k.lang = n.lang
      LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
          FROM p WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                   ORDER BY value DESC, encode(item))::INTEGER AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 200
"""
