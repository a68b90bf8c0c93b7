"""N-gram Jaccard join: a MinHash LSH forest and exact verification.

Texts are sets of word n-grams.  Texts with the same words are one class
before anything is compared.  A class has one label per tree of the forest:
a sequence of MinHash values.  Classes that share a label prefix in a tree
are candidates.  The prefix matched is the full label shortened until links
at the threshold itself are found with the target recall, so the chance of a
link does not hang on what other links there are; a shorter prefix finds all
that a longer one finds, so one round at that length is the whole search, and
values beyond it are not computed.  Candidates are verified by their exact
n-gram sets.

Nothing emits all pairs of a group.  A prefix node goes to tasks in blocks
(every pair of blocks is a unit), no more than make a square grid of the tasks
unless their n-grams ask for it, and a unit is compared tile by tile and returns
one row per member: its links, their number and the least class it is linked
to.  So a hot node is spread over all tasks, and a class is sent once per block
of its node, about the root of the tasks in number.  Equal nodes of
different trees are verified once, and a pair that meets in several trees
counts in the first of them.  Classes that linked are merged by a distributed
component search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.rows import packed, row_function, unpacked
from candlewick.session import written

NGRAM = 5
THRESHOLD = 0.8
TREES, LABEL = 10, 8  # trees of the forest, values of a full label (two bytes each)
RECALL = 0.99
BLOCK = 256  # classes of a block, unless that makes more units than tasks
BLOCK_GRAMS = 1 << 21  # n-grams of a block, at most about
TILE = 256  # classes of either side that are compared at once
GRAMS_AT_ONCE = 4096
SHINGLES_AT_ONCE = 2048
WORD_CACHE = 200_000


class WordHashes(dict):
    """Word -> 64-bit hash; the words met first stay, up to a bound."""

    def __missing__(self, word: str) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = h
        return h


def shingles(words: list[str], hashes: WordHashes, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; a text of fewer
    words is one n-gram, one without words has none."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(n, len(w))
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k:len(w) - n + 1 + k]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(h ^ (h >> np.uint64(32)))


def label(grams: np.ndarray, trees: int = TREES, values: int = LABEL) -> bytes:
    """MinHash values of all trees, two bytes each, tree by tree."""
    rng = np.random.default_rng(20240101)
    a = rng.integers(0, 1 << 32, trees * values, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, trees * values, dtype=np.uint32)
    x = (grams >> np.uint64(32)).astype(np.uint32) ^ grams.astype(np.uint32)
    low = np.full(trees * values, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), SHINGLES_AT_ONCE):
        part = (x[at:at + SHINGLES_AT_ONCE, None] ^ b) * a
        part ^= part >> np.uint32(16)
        np.minimum(low, (part * np.uint32(0x85EBCA6B)).min(axis=0), out=low)
    return ((low * np.uint32(0xC2B2AE35)) >> np.uint32(16)).astype(">u2").tobytes()


def found_chance(similarity, depth: int, trees: int = TREES):
    """Chance that two sets share a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def longest_prefix(similarity: float, recall: float, trees: int, values: int) -> int:
    """The full label shortened until links of ``similarity`` reach ``recall``."""
    depth = values
    while depth > 1 and found_chance(similarity, depth, trees) < recall:
        depth -= 1
    return depth


def signatures(docs: DataFrame, id_col: str, text_col: str, *, n: int = NGRAM,
               trees: int = TREES, values: int = LABEL) -> DataFrame:
    """(id, th, ckey, label, size) of every row: the hash of the text, the
    128-bit key of its words (null without words), the label of its n-grams
    and their number."""
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                       F.coalesce(text_col, F.lit("")).alias("text"))

    def sign():
        import xxhash

        hashes = WordHashes()

        def one(text):
            words = text.lower().split()
            if not words:
                return {"ckey": None, "label": None, "size": None}
            grams = shingles(words, hashes, n)
            return {"ckey": xxhash.xxh3_128_digest("\n".join(words)), "label": label(grams, trees, values),
                    "size": len(grams)}

        return one

    signed = row_function(sign, "struct<ckey:binary,label:binary,size:bigint>")
    return base.withColumn("s", signed("text")).select("id", "th", "s.*")


def candidate_units(classes: DataFrame, trees: int, values: int, block: int, block_grams: int, grid: int) -> DataFrame:
    """(bucket, bi, bj, tree, ckey, block, copies): classes by pair of blocks
    of every node of company, that is of equal labels in a tree.  Labels stay
    behind; only classes of a node with company are looked up again."""
    nodes = classes.select("ckey", "copies", "size", F.posexplode(F.array(*[
        F.xxhash64(F.lit(t), F.substring("label", 1 + 2 * values * t, 2 * values))
        for t in range(trees)])).alias("tree", "bucket"))
    size = (nodes.groupBy("bucket", "tree").agg(
        F.count("*").alias("n"), F.sum("size").alias("grams"), F.bit_xor(F.xxhash64("ckey")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "ckey")).alias("y")).where("n > 1"))
    blocks = F.greatest(F.least(F.ceil(F.col("n") / block), F.lit(grid)),
                        F.least(F.col("n"), F.ceil(F.col("grams") / block_grams)))
    once = (size.groupBy("n", "grams", "x", "y").agg(F.min(F.struct("tree", "bucket")).alias("b"))
            .select(F.col("b.bucket").alias("k_bucket"), F.col("b.tree").alias("k_tree"),
                    blocks.cast("int").alias("blocks")))
    units = (nodes.join(once, (F.col("bucket") == F.col("k_bucket")) & (F.col("tree") == F.col("k_tree")))
             .withColumn("block", F.pmod(F.xxhash64(F.lit(2), "ckey"), F.col("blocks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (units.select("bucket", "tree", "ckey", "block", "copies", other.alias("o"))
            .select("bucket", F.least("block", "o").alias("bi"), F.greatest("block", "o").alias("bj"),
                    "tree", "ckey", "block", "copies"))


def _tiles(block: np.ndarray, same_block: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members of both sides of the tiles: all pairs of one block (a tile with
    itself first), or of two different ones."""
    cut = lambda own: [own[at:at + TILE] for at in range(0, len(own), TILE)]
    low = block.min()
    a = cut(np.flatnonzero(block == low))
    if same_block:
        yield from ((x, y) for k, x in enumerate(a) for y in a[k:])
    else:
        b = cut(np.flatnonzero(block != low))
        yield from ((x, y) for x in a for y in b)


def compare(tree: int, same_block: bool, block: np.ndarray, labels: np.ndarray,
            grams: list[np.ndarray], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the links in a unit, tile by tile: pairs of different blocks
    (of one block if the unit is that), first met in ``tree``.  ``labels``:
    (members, trees, values)."""
    size = np.array([len(g) for g in grams])
    _, flat, times = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    ends = np.cumsum(size)
    # numbers of the n-grams that more than one member has
    own = [g[times[g] > 1] for g in np.split(flat, ends[:-1])]
    for a, b in _tiles(block, same_block):
        both = np.zeros((len(a), len(b)), dtype=np.float32)
        ga, gb = (np.concatenate([own[k] for k in x]) for x in (a, b))
        oa, ob = (np.repeat(np.arange(len(x)), [len(own[k]) for k in x]) for x in (a, b))
        common = np.intersect1d(ga, gb)
        for side in range(0, len(common), GRAMS_AT_ONCE):
            some = common[side:side + GRAMS_AT_ONCE]
            has = []
            for g, o, n in ((ga, oa, len(a)), (gb, ob, len(b))):
                at = np.searchsorted(some, g)
                there = some[np.minimum(at, len(some) - 1)] == g
                m = np.zeros((n, len(some)), dtype=np.float32)
                m[o[there], at[there]] = 1
                has.append(m)
            both += has[0] @ has[1].T
        union = size[a][:, None] + size[b][None, :] - both
        pairs = both >= threshold * union - 1e-6
        if a[0] == b[0]:
            pairs &= np.triu(np.ones_like(pairs), 1)
        x, y = np.nonzero(pairs)
        i, j = a[x], b[y]
        met = (labels[i] == labels[j]).all(axis=2)
        first = met[:, tree] & ~met[:, :tree].any(axis=1)
        yield i[first], j[first]


class Roots:
    """The least member of each group of linked members, link by link."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            parent = np.arange(len(self.root))
            np.minimum.at(parent, high, low)  # a root goes to the least that it met
            while (parent[parent] != parent).any():
                parent = parent[parent]
            self.root = parent[self.root]


def verify(units: DataFrame, *, threshold: float, trees: int, values: int) -> DataFrame:
    """One row per class and unit with a link: ckey, root (least class it is
    joined to in the unit), links (documents) and texts (classes)."""
    cols = ["ckey", "root", "links", "texts"]

    def run(unit: list[tuple]) -> pd.DataFrame | None:
        unit.sort(key=lambda r: r[4])
        grams = [np.frombuffer(r[8], dtype="<u8") for r in unit]
        labels = np.stack([np.frombuffer(r[7], dtype=">u2") for r in unit]).reshape(-1, trees, values)
        m, copies = len(unit), np.array([r[6] for r in unit], dtype=np.int64)
        links, texts, roots = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64), Roots(m)
        for i, j in compare(unit[0][3], unit[0][1] == unit[0][2], np.array([r[5] for r in unit]),
                            labels, grams, threshold):
            for x, y in ((i, j), (j, i)):
                np.add.at(links, x, copies[y])
                texts += np.bincount(x, minlength=m)
            roots.join(i, j)
        has = np.flatnonzero(texts)
        if not len(has):
            return None
        return pd.DataFrame({
            "ckey": [unit[k][4] for k in has], "root": [unit[roots.root[k]][4] for k in has],
            "links": links[has], "texts": texts[has]}, columns=cols)

    def all_units(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rows, out = None, [], []
        for f in frames:
            for r in f.itertuples(index=False, name=None):
                if r[:3] != key:
                    if len(rows) > 1 and (x := run(rows)) is not None:
                        out.append(x)
                    key, rows = r[:3], []
                rows.append(r)
            if out:
                yield pd.concat(out)
                out = []
        if len(rows) > 1 and (x := run(rows)) is not None:
            yield x

    return (units.select("bucket", "bi", "bj", "tree", "ckey", "block", "copies", "label", "grams")
            .repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj")
            .mapInPandas(all_units, "ckey binary, root binary, links bigint, texts bigint"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component of the edges (u, v).

    Rounds of contraction: every node takes its least neighbour's place, in
    the edges and in the answers, until no edge is left.  Nodes are hashes,
    so the rounds are of the order of the logarithm of the longest path."""
    edges = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    edges = written(edges.distinct(), "edges")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    answer = written(nodes.select("node", F.col("node").alias("root")), "roots")
    while not edges.isEmpty():
        step = written(edges.select("u", F.col("v").alias("m")).union(edges.select("v", "u"))
                       .groupBy("u").agg(F.least(F.col("u"), F.min("m")).alias("m"))
                       .withColumnRenamed("u", "x"), "step")
        answer = written(answer.join(step, F.col("root") == F.col("x"), "left")
                         .select("node", F.coalesce("m", "root").alias("root")), "roots")
        edges = (edges.join(step, F.col("u") == F.col("x")).select(F.col("m").alias("u"), "v")
                 .join(step, F.col("v") == F.col("x")).select("u", F.col("m").alias("v")))
        edges = written(edges.where("u <> v").select(F.least("u", "v").alias("u"),
                                                     F.greatest("u", "v").alias("v")).distinct(), "edges")
    return answer


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Classes of near duplicates: Jaccard similarity of the word n-gram sets
    (lower-cased, split at white space) of ``threshold`` or more.

    Returns one row per input row: ``id_col``, ``th`` (hash of the text),
    ``class_id`` (the least id joined to it by links), ``n_links`` (rows
    linked to it, copies included) and ``n_texts`` (different texts linked).
    Null and empty texts and texts without a word link to nothing: their
    class is their own id.  Texts shorter than n words are one n-gram.  Rows
    that repeat an id are rows of their own, linked as copies.  A null id is
    never a class id unless all of a class are null.  Other columns are not
    read.
    """
    found = _classified(docs, id_col, text_col, **kw)
    kind = found.schema["id"].dataType.simpleString()
    has = F.col("ckey").isNotNull()
    return found.select(
        F.col("id").alias(id_col), "th",
        F.when(has, F.col("best.id")).otherwise(F.col("id")).cast(kind).alias("class_id"),
        F.when(has, F.col("links") + F.col("copies") - 1).otherwise(F.lit(0)).alias("n_links"),
        F.when(has, F.col("texts")).otherwise(F.lit(0)).alias("n_texts"))


def _classified(docs: DataFrame, id_col: str, text_col: str, *, n: int = NGRAM,
                threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES,
                values: int = LABEL, block: int = BLOCK, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """One row per input row: ``id``, ``th``, ``ckey`` (of its text; null
    without a word) and, of its class, ``best`` (its first row: by id, nulls
    last, then text hash), ``links``, ``texts`` and ``copies``."""
    values = longest_prefix(threshold, recall, trees, values)
    sig = written(signatures(docs, id_col, text_col, n=n, trees=trees, values=values), "signatures")
    classes = written(sig.where("ckey IS NOT NULL").groupBy("ckey").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("first"),
        F.count("*").alias("copies"), F.first("label").alias("label"), F.first("size").alias("size"),
        F.min("th").alias("rep_th")), "classes")

    def gram_set():
        hashes = WordHashes()
        return lambda text: shingles(text.lower().split(), hashes, n).tobytes()

    gram_sets = row_function(gram_set, "binary")
    # the n-grams of every class that has company, from one text of each (that
    # of its least text hash)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = candidate_units(classes, trees, values, block, block_grams, math.isqrt(2 * tasks) + 1)
    reps = (classes.join(units.select("ckey").distinct(), "ckey", "left_semi")
            .select("ckey", "rep_th", "label"))
    texts = (docs.select(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
             .join(reps, F.col("th") == F.col("rep_th"))
             .select("ckey", "label", "text").dropDuplicates(["ckey"]))
    grams = written(texts.select(F.col("ckey").alias("g_key"), "label", gram_sets("text").alias("grams")),
                    "n-grams")
    linked = written(verify(units.join(grams, F.col("ckey") == F.col("g_key")),
                            threshold=threshold, trees=trees, values=values), "links")
    roots = components(linked.select(F.col("ckey").alias("u"), F.col("root").alias("v")))
    counts = linked.groupBy("ckey").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    merged = (classes.select("ckey", "first", "copies")
              .join(roots, F.col("ckey") == F.col("node"), "left")
              .select("ckey", "first", "copies", F.coalesce("root", "ckey").alias("root")))
    least = written(merged.groupBy("root").agg(F.min("first").alias("best")), "class-ids")
    table = (merged.join(least, "root").join(counts.withColumnRenamed("ckey", "l_key"),
                                             F.col("ckey") == F.col("l_key"), "left")
             .select(F.col("ckey").alias("t_key"), "best", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("texts", F.lit(0)).alias("texts"), "copies"))
    table = written(table, "class-table")
    return sig.join(table, F.col("ckey") == F.col("t_key"), "left").drop("t_key", "label", "size")


# The characters that Python's split() takes for white space.
NO_SPACE = "[^\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one row of each class: that of the least id
    (a row without an id only if all are), of rows with that id the one of the
    least text hash, of equal ones any.  Rows without a word are in no class:
    all stay."""
    found = _classified(docs, id_col, text_col)
    first = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("th") == F.col("best.th"))
    # one hash of the id, null or not: the join and the distinct rows share a shuffle
    number = lambda c: F.xxhash64(F.col(c).isNull(), F.col(c))
    gone = (found.where(F.col("ckey").isNotNull() & ~first)
            .select(number("id").alias("g_id"), F.col("th").alias("g_th")).distinct())
    rows = packed(docs, rid=number(id_col), th=F.xxhash64(text_col),
                  tie=F.when(~F.coalesce(F.col(text_col), F.lit("")).rlike(NO_SPACE), F.monotonically_increasing_id()))
    left = rows.join(gone, (F.col("rid") == F.col("g_id")) & (F.col("th") == F.col("g_th")), "left_anti")
    return unpacked(left.dropDuplicates(["rid", "th", "tie"]))


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("th")


OP4_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'),
                                               lambda x: x <> '') AS ws FROM documents),
t AS (SELECT doc_id, ws, min(doc_id) OVER (PARTITION BY ws) AS rep, count(*) OVER (PARTITION BY ws) AS copies
      FROM w WHERE len(ws) > 0),
g AS (SELECT DISTINCT rep, unnest(CASE WHEN len(ws) < {NGRAM} THEN [array_to_string(ws, ' ')] ELSE
             list_transform(range(1, len(ws) - {NGRAM - 2}), lambda i: array_to_string(ws[i:i + {NGRAM - 1}], ' ')) END) AS x
      FROM t WHERE doc_id = rep),
n AS (SELECT rep, count(*) AS n FROM g GROUP BY rep),
p AS (SELECT a.rep AS u, b.rep AS v, count(*) AS c FROM g a JOIN g b ON a.x = b.x AND a.rep <> b.rep GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n a ON a.rep = u JOIN n b ON b.rep = v WHERE c >= {THRESHOLD} * (a.n + b.n - c) - 1e-9),
r(u, v) AS (SELECT rep, rep FROM n UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
k AS (SELECT u, min(v) AS class_id FROM r GROUP BY u),
c AS (SELECT DISTINCT rep, copies FROM t),
s AS (SELECT u, sum(copies)::BIGINT AS links, count(*) AS texts FROM l JOIN c ON c.rep = l.v GROUP BY u)
SELECT w.doc_id, coalesce(class_id, w.doc_id) AS class_id,
       coalesce(links, 0) + coalesce(copies, 1) - 1 AS n_links, coalesce(texts, 0) AS n_texts
FROM w LEFT JOIN t USING (doc_id) LEFT JOIN k ON k.u = t.rep LEFT JOIN s ON s.u = t.rep
"""
