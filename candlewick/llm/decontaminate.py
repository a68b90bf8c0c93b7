"""Benchmark decontamination: BM25 retrieval of test items, then overlap.

The test items are the indexed side: postings of (item, BM25 impact) per word,
in item order, scaled so that a passage with all words of an item scores 1,
with the largest impact of every block of items.  Every passage of every
document is a query, in overlapping word windows.  Their length goes with the
item's own length alone (the next power of two), so whether an item is found
in a document does not hang on the other items.  A passage is pruned thrice:
by the words' maxima, by the block maxima of its postings, and in the blocks
that stay by block-max WAND: the cursors' block maxima add up to a pivot, the
first item that can reach the threshold, and postings before it are skipped.
All items above the threshold are then verified by the word n-grams of their
question and of their answer.  Items too short for both (under ``LEAST``
words) are reported so too, but drop a document only if they stand in it
whole, as one run; those of fewer words than an n-gram only if the document
says nothing else.

Documents are read once per shard of the benchmark and never shuffled.  A
shard is bounded in characters, and only shards travel to the tasks; a
benchmark of any size is some number of shards, which change no result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import fsum
from operator import itemgetter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.rows import row_function
from candlewick.session import written

K1, B = 1.2, 0.75
THRESHOLD = 0.6  # share of an item's own BM25 score
OVERLAP = 0.5  # share of the n-grams of question and of answer
NGRAM = 3
LEAST = 2 * NGRAM  # words of an item with a question and an answer of its own
LEAST_WIDTH = 8  # items of fewer words are looked for in windows for this many
BLOCK = 8  # items of a block
MAX_BLOCKS = 256  # a band of more items has larger blocks
SHARD_CHARS = 2_000_000
WINDOWS_AT_ONCE = 1024
SLACK = 1e-9  # of sums that are compared with the threshold
WORD = re.compile(r"\w+")

NAMES = ("item", "score", "question", "answer", "begin", "end")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The answer is the last sentence or line of three words or more, else
    the last quarter of the words; the question is all before it."""
    parts = [words_of(p) for p in re.split(r"\n+|(?<=[.!?])\s+", text)]
    for k in range(len(parts) - 1, 0, -1):
        answer = sum(parts[k:], [])
        if len(answer) >= NGRAM:
            question = sum(parts[:k], [])
            if len(question) >= NGRAM:
                return question, answer
    words = sum(parts, [])
    cut = len(words) - max(min(NGRAM, len(words)), len(words) // 4)
    return (words[:cut], words[cut:]) if cut >= NGRAM else (words, words)


def ngrams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(NGRAM, max(len(words), 1))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


class Vocabulary(dict):
    """Word -> term; -1 for other words."""

    def __missing__(self, word: str) -> int:
        return -1


def width_of(words: int) -> int:
    """Words of half a window in which items of so many words are looked for."""
    return max(LEAST_WIDTH, 1 << (words - 1).bit_length())


class Band:
    """Postings of the items of one width.  ``items``: (number, words, text,
    impacts by term), shortest first."""

    def __init__(self, width: int, items: list[tuple], terms: int):
        self.width = width
        self.ids = [i for i, *_ in items]
        self.parts = [tuple(map(ngrams, question_and_answer(t))) for _, _, t, _ in items]
        self.short = {k: w for k, (_, w, _, _) in enumerate(items) if len(w) < LEAST}
        self.block = max(BLOCK, -(-len(items) // MAX_BLOCKS))
        self.blocks = -(-len(items) // self.block)
        self.postings: dict[int, tuple[list[int], list[float]]] = {}
        for k, (*_, impacts) in enumerate(items):
            for t, x in impacts.items():
                at, of = self.postings.setdefault(t, ([], []))
                at.append(k)
                of.append(x)
        # block maxima: per term the blocks that it has postings in, in order
        self.maxima: dict[int, dict[int, float]] = {}
        for t, (at, of) in self.postings.items():
            top = self.maxima[t] = {}
            for k, x in zip(at, of):
                top[k // self.block] = max(x, top.get(k // self.block, 0.0))
        sizes = np.zeros(terms + 1, dtype=np.int64)
        sizes[[t + 1 for t in self.maxima]] = [len(m) for m in self.maxima.values()]
        self.first = np.cumsum(sizes)  # of a term's blocks in the next two
        own = [self.maxima.get(t, {}) for t in range(terms)]
        self.block_of = np.array([b for m in own for b in m], dtype=np.int64)
        self.block_max = np.array([x for m in own for x in m.values()])
        self.term_max = np.array([max(m.values(), default=0.0) for m in own])

    def passages(self, terms: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        """(begin, distinct terms, blocks that can hold a match) of the windows
        that have any.  Windows are two widths long and begin every width, so
        any span of an item's length lies in one."""
        n, step, limit = len(terms), self.width, THRESHOLD - SLACK
        begins = np.arange(0, max(n - step, 1), step)
        for at in range(0, len(begins), WINDOWS_AT_ONCE):
            first = begins[at:at + WINDOWS_AT_ONCE, None]
            place = first + np.arange(2 * step)
            inside = place < n
            place = np.minimum(place, n - 1)
            new = inside & (terms[place] >= 0) & (before[place] < first)
            window, column = np.nonzero(new)
            mine = terms[place[window, column]]
            known = self.term_max[mine] > 0
            window, mine = window[known], mine[known]
            reach = np.bincount(window, self.term_max[mine], minlength=len(first)) >= limit
            window, mine = window[reach[window]], mine[reach[window]]
            if not len(mine):
                continue
            # the block maxima of all terms of a window, added up per block
            sizes = self.first[mine + 1] - self.first[mine]
            ends = np.cumsum(sizes)
            entry = np.repeat(self.first[mine] - (ends - sizes), sizes) + np.arange(ends[-1])
            cell = np.repeat(window, sizes) * self.blocks + self.block_of[entry]
            sums = np.bincount(cell, self.block_max[entry], minlength=len(first) * self.blocks)
            open_ = np.flatnonzero(sums >= limit)
            for k in np.unique(open_ // self.blocks).tolist():
                lo, hi = np.searchsorted(window, (k, k + 1))
                yield (int(first[k, 0]), mine[lo:hi],
                       (open_[open_ // self.blocks == k] - k * self.blocks).tolist())

    def found(self, terms: list[int], blocks: list[int]) -> Iterator[tuple[int, float]]:
        """(item, score) of all items of some blocks that reach the threshold
        with these terms: block-max WAND."""
        limit = THRESHOLD - SLACK
        for b in blocks:
            end = min((b + 1) * self.block, len(self.ids))
            live = []  # cursors: [item, place, items, impacts, maximum in the block]
            for t in terms:
                if b in self.maxima[t]:
                    items, impacts = self.postings[t]
                    at = bisect_left(items, b * self.block)
                    live.append([items[at], at, items, impacts, self.maxima[t][b]])
            while live:
                live.sort(key=itemgetter(0))
                reach = 0.0
                for cursor in live:
                    reach += cursor[4]
                    if reach >= limit:
                        break
                else:
                    break  # what is left of the block stays below the threshold
                pivot = cursor[0]
                if live[0][0] == pivot:
                    here = [c for c in live if c[0] == pivot]
                    score = fsum(c[3][c[1]] for c in here)
                    if score >= limit:
                        yield pivot, score
                    pivot += 1
                for c in live:  # on to the pivot, or past it
                    if c[0] >= pivot:
                        break
                    c[1] = bisect_left(c[2], pivot, c[1])
                    c[0] = c[2][c[1]] if c[1] < len(c[2]) else end
                live = [c for c in live if c[0] < end]


class Index:
    """A shard of items, in bands of one width.  ``items``: (number, text) with
    at least one word each; ``df``: items by word and ``n``, ``mean_len``:
    number and mean length of the items, over all shards."""

    def __init__(self, items: list[tuple], df: dict[str, int], n: int, mean_len: float):
        self.terms = Vocabulary()
        widths: dict[int, list[tuple]] = {}
        for words, i, text in sorted(((words_of(t), i, t) for i, t in items), key=lambda r: (len(r[0]), r[1])):
            norm = K1 * (1 - B + B * len(words) / mean_len)
            impacts = {w: float(np.log1p((n - df[w] + 0.5) / (df[w] + 0.5))) * f * (K1 + 1) / (f + norm)
                       for w, f in Counter(words).items()}
            whole = fsum(impacts.values())
            widths.setdefault(width_of(len(words)), []).append((i, words, text, {
                self.terms.setdefault(w, len(self.terms)): x / whole for w, x in impacts.items()}))
        self.ids = [i for own in widths.values() for i, *_ in own]
        self.bands = [Band(w, own, len(self.terms)) for w, own in widths.items()]

    def matches(self, text: str) -> list[tuple]:
        """Verified items of a text (fields of ``NAMES``): score, question and
        answer overlap and the passage in words, the best passage of each item
        (the first of equals), by item."""
        return sorted(m for *_, m in self._best(words_of(text)))

    def drops(self, text: str) -> bool:
        """Whether a verified item is long enough, or stands in the text so,
        that the text is to go."""
        words = words_of(text)
        return any(_tells(band.short.get(k), words) for band, k, _ in self._best(words))

    def _best(self, words: list[str]) -> list[tuple]:
        """(band, place in it, match) of the verified items."""
        if not words:
            return []
        terms = np.fromiter(map(self.terms.__getitem__, words), dtype=np.int64, count=len(words))
        order = np.argsort(terms, kind="stable")
        before = np.full(len(terms), -1)  # the place where a word stood last
        same = terms[order[1:]] == terms[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        out = []
        for band in self.bands:
            best: dict[int, tuple] = {}
            for begin, mine, blocks in band.passages(terms, before):
                end = min(begin + 2 * band.width, len(words))
                grams = None
                for k, score in band.found(mine.tolist(), blocks):
                    if grams is None:
                        grams = {n: set(zip(*(words[begin + i:end] for i in range(n))))
                                 for n in range(1, NGRAM + 1)}
                    q, a = (len(p & grams[len(next(iter(p)))]) / len(p) for p in band.parts[k])
                    if min(q, a) >= OVERLAP and (k not in best or (score, q + a) > best[k][0]):
                        best[k] = ((score, q + a), (band.ids[k], min(score, 1.0), q, a, begin, end))
            out += [(band, k, m) for k, (_, m) in best.items()]
        return out


def _tells(own: list[str] | None, words: list[str]) -> bool:
    """Whether a short item (its words; None for others) tells on a text."""
    if own is None or own == words:
        return True
    return len(own) >= NGRAM and f" {' '.join(own)} " in f" {' '.join(words)} "


class Indexes:
    """The indexes of the shards in turn: each is built as it is asked for and
    not kept, so the driver holds one shard."""

    def __init__(self, counted: DataFrame, shards: list[int], n: int, mean_len: float):
        self.counted, self.shards, self.n, self.mean_len = counted, shards, n, mean_len
        self.df = (counted.select(F.explode(F.array_distinct("words")).alias("word"))
                   .groupBy("word").agg(F.count("*").alias("df"))) if shards else None

    def __len__(self) -> int:
        return len(self.shards)

    def __iter__(self) -> Iterator[Index]:
        return map(self.build, self.shards)

    def build(self, shard: int) -> Index:
        own = self.counted.where(F.col("shard") == shard)
        mine = own.select(F.explode("words").alias("word")).distinct().join(self.df, "word").collect()
        rows = own.select("item", "text").collect()
        return Index([tuple(r) for r in rows], {r["word"]: r["df"] for r in mine}, self.n, self.mean_len)


def build_indexes(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", *,
                  shard_chars: int = SHARD_CHARS) -> Indexes:
    """One index per shard.  Items without an id or a word are left out.
    Word statistics are over all items; each shard collects only its own
    items and the counts of its own words, when its index is asked for."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    items = items.where(F.col("item").isNotNull() & F.col("text").rlike(r"(?U)\w"))

    words = row_function(lambda: words_of, "array<string>")
    counted = written(items.withColumn("words", words("text")), "test-items")
    n, chars, length = counted.agg(F.count("*"), F.sum(F.char_length("text")),
                                   F.sum(F.size("words"))).first()
    if not n:
        return Indexes(counted, [], 0, 0)
    shards = -(-chars // shard_chars)
    counted = counted.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards)))
    there = sorted(r["shard"] for r in counted.select("shard").distinct().collect())
    return Indexes(counted, there, n, length / n)


def match_type(kind: T.DataType) -> str:
    """Of the matches of a text, for items numbered by ``kind``."""
    return (f"array<struct<item:{kind.simpleString()},score:double,question:double,answer:double,"
            "begin:bigint,end:bigint>>")


def matches_of(text: Column, index: Index, kind: T.DataType) -> Column:
    """Array of the verified test items of a text (fields of ``NAMES``); empty
    for null and empty texts."""
    def match():
        return lambda t: [dict(zip(NAMES, m)) for m in index.matches(t)]

    return row_function(match, match_type(kind))(F.coalesce(text, F.lit("")))


def dropped(text: Column, index: Index) -> Column:
    """Whether a text shows a test item that drops it; null and empty do not."""
    return row_function(lambda: index.drops, "boolean")(F.coalesce(text, F.lit("")))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", *, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(document, test item) pairs with ``score``, ``question`` and ``answer``
    overlap and the passage (``begin``, ``end`` in words) that shows them.

    Null and empty texts match nothing; very long ones are looked through
    whole.  Items that say the same are all reported, of passages that tie the
    first; rows that repeat a document repeat its pairs.  Item ids may be of any
    type; items without an id or a word match nothing.  No documents or no
    items give no rows.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = benchmark.schema[item_col].dataType
    found = [rows.limit(0).select("id", F.array().cast(match_type(kind)).alias("m"))]
    # a pass per shard: tasks and driver hold one index at a time, so the
    # matches of a shard are written before the next index is built
    indexes = build_indexes(benchmark, item_col, item_text_col, shard_chars=shard_chars)
    left = len(indexes)
    for index in indexes:  # enumerate() would hold the last one
        left -= 1
        shown = rows.select("id", matches_of(F.col("text"), index, kind).alias("m")).where(F.size("m") > 0)
        found.append(written(shown, "matches") if left else shown)
        del index, shown
    found = reduce(DataFrame.unionByName, found)
    return (found.select("id", F.explode("m").alias("m"))
            .select(F.col("id").alias(id_col), F.col("m.item").alias(item_col), "m.score",
                    "m.question", "m.answer", "m.begin", "m.end"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *,
                      shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The rows of ``docs`` (all columns) that show no test item: one pass per
    shard, written in between.  Items under ``LEAST`` words count only as one
    whole run, those under ``NGRAM`` only as the whole text."""
    indexes = build_indexes(benchmark, shard_chars=shard_chars)
    left = len(indexes)
    for index in indexes:
        left -= 1
        docs = docs.where(~dropped(F.col(text_col), index))
        if left:
            docs = written(docs, "clean-so-far")
        del index
    return docs


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    out = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                       spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "item_id", F.round("score", 6).alias("score"), "question", "answer")
