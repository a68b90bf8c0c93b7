"""Line dedup: drop lines that many documents share.

Lines are exploded with their position, hashed by their normalised form and
counted by distinct document; documents are put together again from the
positions that stay.  Only (id, text hash, position, line hash) is shuffled
for the counts, never the lines themselves.  A line that a third of all
documents hold is combined map-side before the count and meets its join
partner as one row, so a skewed join can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.rows import packed
from candlewick.session import written

# The white space and letters of a line key.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.btrim(F.translate(line, UPPER, LOWER), F.lit(SPACE))


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def shared_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                     min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(d_id, d_th, drop): positions of the lines to drop, by id and text hash.

    Rows of equal id and text have equal lines, so the pair stands for them.
    """
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                       F.col(text_col).alias("text"))
    keyed = (base.select("id", "th", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
             .select("id", "th", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= min_chars)
             .select("id", "th", "pos", F.xxhash64("key").alias("a"),
                     F.xxhash64(F.lit(1), "key").alias("b")))
    keyed = written(keyed, "line-keys")
    shared = (keyed.where("id IS NOT NULL").select("a", "b", "id").distinct()
              .groupBy("a", "b").agg(F.count("*").alias("n"), F.max("id").alias("keep"))
              .where(F.col("n") >= min_docs).select("a", "b", "keep"))
    shared = written(shared, "shared-lines")  # a side of its own, so AQE can split a common line
    return (keyed.join(shared, ["a", "b"]).where("id IS NULL OR id <> keep")
            .groupBy("id", "th").agg(F.collect_list("pos").alias("drop"))
            .select(F.col("id").alias("d_id"), F.col("th").alias("d_th"), "drop"))


def _reassembled(rows: DataFrame, drops: DataFrame) -> DataFrame:
    """``rows`` (with ``id``, ``th``, ``text``) with ``n_lines``, ``n_dropped``
    and ``kept_text``."""
    rows = rows.join(drops, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("th") == F.col("d_th")),
                     "left")
    rows = (rows.withColumn("lines", lines_of(F.col("text")))
            .withColumn("stay", F.when(F.col("drop").isNotNull(), F.array_except(
                F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop")))))
    kept = F.array_join(F.transform("stay", lambda p: F.get("lines", p)), "\n")
    return rows.select(
        *[c for c in rows.columns if c in ("row", "id")],
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("stay"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept)
         .alias("kept_text"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines whose key (>= ``min_chars`` code points) is found in at
    least ``min_docs`` documents, except in the document of the largest id.

    Returns one row per input row: ``id_col``, ``n_lines`` (before),
    ``n_dropped`` and ``kept_text``.  Null or empty text: one empty line.
    Rows that repeat an id count as one document.  A null id counts as no
    document and is never the largest; such rows lose shared lines.  Keys
    are compared by a 128-bit hash.  Other columns are not read.
    """
    drops = shared_positions(docs, id_col, text_col, min_chars=min_chars, min_docs=min_docs)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                       F.col(text_col).alias("text"))
    return _reassembled(rows, drops).withColumnRenamed("id", id_col)


def replace_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  length_col: str = "n_chars") -> DataFrame:
    """``docs`` (all columns, all rows) with the text and its length after
    ``dedup_lines``."""
    rows = packed(docs, id=F.col(id_col), th=F.xxhash64(text_col), text=F.col(text_col))
    done = _reassembled(rows, shared_positions(docs, id_col, text_col))
    new = {text_col: F.col("kept_text"), length_col: F.char_length("kept_text").cast("long")}
    return done.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = """
WITH l AS (
  SELECT doc_id, pos, line,
         trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
s AS (SELECT k, max(doc_id) AS keep FROM l WHERE length(k) >= 20
      GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, s.k IS NOT NULL AND l.doc_id <> s.keep AS gone FROM l LEFT JOIN s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
