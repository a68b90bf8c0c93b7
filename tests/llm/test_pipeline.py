"""The pipeline against a plain Python version of its stages."""

import hashlib
from collections import Counter

import corpus_pipeline
from candlewick.llm import quality
from candlewick.session import ensure_checkpoint_dir
from candlewick.sources import fs
from tests.conftest import SF_SMALL
from tests.llm.test_native_ops import brute_dedup, brute_signals
from tests.llm.test_python_ops import brute_classes, brute_matches, plain, table


def test_pipeline(spark):
    docs = table("documents", "doc_id, text, lang")
    assert len({i for i, *_ in docs}) == len(docs)
    kept = []
    for i, t, lang in docs:  # the labels here are too few to certify a cutoff
        n, _, _, _, covered, *_ = brute_signals(t)
        if n >= quality.MIN_WORDS and 100 * covered <= quality.MAX_REPEAT_PCT * n:
            kept.append((i, t))
    rows = [(i, t) for (i, _, _, t) in brute_dedup(kept)]
    least = {r[0]: r[1] for r in brute_classes(rows)}
    rows = [(i, t) for i, t in rows if least[i] == i]
    items = table("benchmark", "item_id, text")
    rows = [(i, t) for i, t in rows if not brute_matches(t, items)]
    assert 0 < len(rows) < len(kept) < len(docs)
    base = ensure_checkpoint_dir(spark)
    there = set(fs.subfolders(spark, base, ""))
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    left = set(fs.subfolders(spark, base, "")) - there
    assert [x.rsplit("/", 1)[1].rsplit("-", 1)[0] for x in left] == ["pipeline-bpe"]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256) for r in out) == Counter(
        (i, len(plain(t)) // 4, plain(t), sha(plain(t)), sha(t.encode())) for i, t in rows)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).schema == docs.schema, name


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null and empty texts, null and repeated ids, repeated rows, a very long
    text, columns with names that stages use themselves: against the plain
    stages, through run()."""
    docs = [(i, t) for i, t in table("documents", "doc_id, text")[:60]]
    words = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    items = table("benchmark", "item_id, text")[:20] + [(None, "no id"), (900, None)]
    docs += [(1000, None), (1001, ""), (None, words(1, 40)), (None, words(1, 40).upper()), (1002, words(1, 40)),
             (1003, words(2, 40)), (1003, words(2, 40)), (1003, words(3, 40)), (None, words(4, 40)), (None, None),
             (1004, words(5, 60_000)), (1005, words(6, 30) + " " + items[0][1]), docs[0], docs[1]]
    path = str(tmp_path / "sf")
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", k, "y") for k, (i, t) in enumerate(docs)],
                          "doc_id long, text string, lang string, source string, n_chars long, id string, th long, row string"
                          ).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1002, 1, 0), (None, 1, 0), (1003, None, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    kept = []
    for i, t in docs:
        n, _, _, _, covered, *_ = brute_signals(t)
        if n >= 10 and 100 * covered <= 20 * n:
            kept.append((i, t))
    rows = [r for r, n in brute_dedup(kept).items() for _ in range(n)]
    found = brute_classes([(k, t) for k, (i, _, _, t) in enumerate(rows)])
    root, classes = {k: c for k, c, *_ in found}, {}
    for k, (i, _, _, t) in enumerate(rows):
        classes.setdefault(root[k], []).append((i is None, i or 0, t))
    want = Counter()
    for members in classes.values():
        none, i, _ = min(members, key=lambda m: m[:2])
        texts = {t for n, j, t in members if (n, j) == (none, i)}
        want[None if none else i, frozenset(t for t in texts if not brute_matches(t, items))] += 1
    out = corpus_pipeline.run(spark, path).collect()
    got = Counter(r.doc_id for r in out)
    expected = Counter(i for (i, texts), n in want.items() if texts for _ in range(n))
    assert got == expected and got[None] == 1 and got[1003] == 2 and 1005 not in got and 1002 in got and 1004 in got
    digests = {hashlib.sha256(t.encode()).hexdigest() for _, texts in want for t in texts}
    assert {r.decoded_sha256 for r in out} <= digests
