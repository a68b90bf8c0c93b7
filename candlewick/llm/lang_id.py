"""Language identification: mixtures of languages by EM.

Training counts character trigrams (hashed into a fixed number of buckets)
of every labelled training text per language: tasks count with numpy and
send one row per (language, bucket), summed by Spark.  A document is a
mixture of languages; EM estimates its proportions from the trigram
likelihoods, and the language set is the one of the best penalised
likelihood, found by dropping the weakest language while that helps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.rows import row_function

BUCKETS = 1 << 15
SMOOTHING = 0.5
MAX_LANGUAGES = 1000  # the model is MAX_LANGUAGES x BUCKETS floats at most; more is an error
EM_STEPS = 20
EM_TOLERANCE = 1e-3
PENALTY = 3.0  # times ln(trigrams) per language; trigrams overlap, so 3 of them are one datum
FLUSH_LANGUAGES = 64


def letter_table() -> np.ndarray:
    """For each code point: itself if it is a letter, else a blank."""
    return np.fromiter((i if chr(i).isalpha() else 32 for i in range(0x110000)),
                       dtype=np.uint32, count=0x110000)


def trigrams(text: str, letters: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams of the lower-cased text, every run of
    non-letters as one blank; empty if the text has no letter."""
    codes = letters[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"),
                                  dtype=np.uint32)]
    blank = codes == 32
    codes = codes[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]
    if len(codes) < 3:
        return np.empty(0, dtype=np.int64)
    h = codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA77) \
        ^ codes[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang"):
    """(languages, log likelihoods): trigram counts over all rows with a
    language.  Collected as one row per (language, bucket), so the size of
    the model is bounded by the number of languages, not by the data."""
    base = (labelled.where(F.col(lang_col).isNotNull())
            .select(F.col(lang_col).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, held = letter_table(), {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, v in held.items():
                bucket = np.flatnonzero(v)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(bucket), pa.string()),
                    "bucket": pa.array(bucket, pa.int32()), "n": pa.array(v[bucket], pa.int64())})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                lang = lang.as_py()
                if lang not in held:
                    if len(held) >= FLUSH_LANGUAGES:
                        yield from flush()
                    held[lang] = np.zeros(BUCKETS, dtype=np.int64)
                held[lang] += np.bincount(trigrams(text.as_py(), letters), minlength=BUCKETS)
        yield from flush()

    counts = (base.mapInArrow(count, "lang string, bucket int, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    per = counts.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    rows = per.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((len(rows), BUCKETS), SMOOTHING)
    for i, r in enumerate(rows):
        np.add.at(table[i], r["b"], r["n"])
    return [r["lang"] for r in rows], np.log(table / table.sum(axis=1, keepdims=True))


def _em(p: np.ndarray, c: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """(proportions, log likelihood) of a mixture; ``p``: trigram x language."""
    total = c.sum()
    for _ in range(EM_STEPS):
        mix = p @ w
        new = w * ((c / mix) @ p) / total
        done = np.abs(new - w).max() < EM_TOLERANCE
        w = new
        if done:
            break
    return w, float(c @ np.log(p @ w))


def mixture(grams: np.ndarray, loglik: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(languages, proportions) of the best language set of a document."""
    g, c = np.unique(grams, return_counts=True)
    lp = loglik[:, g].T
    top = lp.max(axis=1, keepdims=True)
    p, c = np.exp(lp - top), c.astype(np.float64)
    # the penalty is on the likelihood of the text relative to the shared factor exp(top)
    price = PENALTY * math.log(max(int(c.sum()), 2))
    single = c @ (lp - top)
    first = int(single.argmax())
    best = (np.array([first]), np.ones(1), float(single[first]) - price)
    chosen = np.arange(p.shape[1])
    w = np.full(len(chosen), 1 / len(chosen))
    while len(chosen) > 1:
        w, ll = _em(p[:, chosen], c, w)
        if ll - price * len(chosen) > best[2]:
            best = (chosen, w, ll - price * len(chosen))
        strong = w > max(w.min(), 1e-3)
        if not strong.any():
            strong = np.arange(len(w)) == int(w.argmax())
        chosen, w = chosen[strong], w[strong] / w[strong].sum()
    return best[0], best[1]


def identify(docs: DataFrame, languages: list[str], loglik: np.ndarray, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Language of every text by a trained model.

    Returns one row per input row: ``id_col``, ``lang_pred`` (the language of
    the largest proportion, ties to the first by name; ``und`` for null
    texts, texts without a letter or an empty model), ``score`` (that
    proportion; 0 for ``und``), ``languages`` and ``proportions`` (the
    selected set, largest first).  Repeated rows give repeated results;
    other columns are not read.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    model = loglik.astype(np.float32)

    def guess():
        letters, lp = letter_table(), model.astype(np.float64)

        def one(text):
            grams = trigrams(text, letters)
            if not len(grams) or not languages:
                return {"lang_pred": "und", "score": 0.0, "languages": [], "proportions": []}
            which, w = mixture(grams, lp)
            order = np.argsort(-w, kind="stable")
            names = [languages[k] for k in which[order]]
            return {"lang_pred": names[0], "score": min(1.0, float(w[order[0]])), "languages": names,
                    "proportions": w[order].tolist()}

        return one

    guessed = row_function(guess, "struct<lang_pred:string,score:double,languages:array<string>,"
                                  "proportions:array<double>>")
    return (base.withColumn("g", guessed("text"))
            .select(F.col("id").alias(id_col), "g.lang_pred", "g.score", "g.languages", "g.proportions"))


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training; one without an id is
    neither held out nor trained on."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    languages, loglik = train(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    out = identify(docs, languages, loglik)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                      F.array_join("languages", ",").alias("languages"))
