"""Whitening, chat formatting and the source divergence audit: brute-force
versions from the definitions, round trips and edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import bpe, chat, divergence, whitening
from tests.conftest import SF_SMALL
from tests.llm.test_native_ops import docs_of

EXTENDED = np.finfo(np.longdouble).eps < 1e-18


# --- whitening


def grid(v):
    return [math.floor(64 * float(c)) + 1_000_000 for c in v]


def brute_moments(vectors):
    """n, sums and the exact covariance as fractions."""
    xs = [grid(v) for v in vectors]
    n, d = len(xs), len(xs[0])
    sums = [sum(x[j] for x in xs) for j in range(d)]
    ys = [[n * x[j] - sums[j] for j in range(d)] for x in xs]
    cov = [[Fraction(sum(y[i] * y[j] for y in ys), n ** 3) for j in range(d)] for i in range(d)]
    return n, sums, ys, cov


def whitened_rows(spark, rows, **kw):
    emb = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return whitening.whiten(emb, **kw).collect()


def test_whitening_of_the_given_vectors(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_SMALL}/embeddings.parquet'").fetchall()
    n, sums, ys, cov = brute_moments([v for _, v in rows])
    values, vectors = np.linalg.eigh(np.array(cov, dtype=float))
    values, vectors = values[::-1], vectors[:, ::-1]
    got = whitening.op11_whiten(spark, SF_SMALL).toPandas()
    assert len(got) == 32 * n and set(got.n) == {n} and sorted(set(got.component)) == list(range(1, 33))
    want = {i: sum(z * z for z in y) for (i, _), y in zip(rows, ys)}
    assert dict(zip(got.vec_id, got.deviation)) == want
    trace = float(sum(cov[i][i] for i in range(len(cov))))
    share = got.groupby("component").explained.agg(["min", "max"])
    assert (share["min"] == share["max"]).all()
    assert np.allclose(share["min"], values[:32] / trace, rtol=1e-10)
    w = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    plain = (np.array(ys, dtype=float) / n) @ vectors[:, :32] / np.sqrt(values[:32])
    assert np.allclose(w * np.sign((w * plain).sum(0)), plain, atol=1e-8)
    c = w - w.mean(0)
    assert np.abs(c.T @ c / n - np.eye(32)).max() < 1e-10
    assert set(got.identity_error) == {got.identity_error[0]} and got.identity_error[0] < 1e-10


def orthogonal(rng, d):
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ ((np.eye(d) - q.T @ q) / 2)
    return q


@pytest.mark.skipif(not EXTENDED, reason="no extended precision on this machine")
@pytest.mark.parametrize("values, off", [
    (np.arange(1, 41), 1e-16),  # apart
    (np.r_[1 + 1e-9 * np.arange(8), 2 + 1e-10 * np.arange(8), np.arange(3, 13)], 1e-7),  # clusters: float64 is off by 1e-6
    (np.r_[1 + 1e-3 * np.arange(8), 1e6], 1e-9)])
def test_refined_eigenvectors(values, off):
    rng = np.random.default_rng(7)
    q = orthogonal(rng, len(values))
    a = (q * values.astype(np.longdouble)) @ q.T
    got, x = whitening.eigenvectors((a + a.T) / 2)
    order = np.argsort(-values, kind="stable")
    assert np.abs(got - values[order]).max() < 1e-17 * len(values) * values.max()
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    q = q[:, order]
    assert np.abs(x - q * np.sign((q * x).sum(0))).max() < off


def test_refinement_gains_digits():
    """Started in float32 the iteration ends where float64 does not reach."""
    rng = np.random.default_rng(3)
    q = orthogonal(rng, 24)
    values = 1 + 1e-8 * np.arange(24)
    a = (q * values.astype(np.longdouble)) @ q.T
    a = (a + a.T) / 2
    _, start = np.linalg.eigh(a.astype(np.float32))
    _, double = np.linalg.eigh(a.astype(np.float64))
    _, x = whitening.eigenvectors(a)
    off = lambda v: float(np.abs(np.abs((v[:, ::-1] * q[:, ::-1]).sum(0)) - 1).max())
    assert off(start) > 1e-2
    if EXTENDED:
        assert off(x[:, ::-1]) < 1e-18 * 1e5 and off(x[:, ::-1]) <= off(double)


def test_repeated_and_missing_eigenvalues():
    rng = np.random.default_rng(5)
    q = orthogonal(rng, 16)
    values = np.r_[np.ones(10), np.zeros(5), 5.0]
    a = (q * values.astype(np.longdouble)) @ q.T
    got, x = whitening.eigenvectors((a + a.T) / 2)
    assert np.abs(got - np.sort(values)[::-1]).max() < 1e-15
    assert np.abs(a @ x - x * got).max() < 1e-15 and np.abs(x.T @ x - np.eye(16)).max() < 1e-15
    got, x = whitening.eigenvectors(np.zeros((3, 3), dtype=np.longdouble))
    assert (got == 0).all() and (x == np.eye(3)).all()
    assert whitening.extended([[10 ** 40, -1], [-1, 3]], 3)[0, 1] == np.longdouble(-1) / 3


def test_whitening_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 1.0, 0.5]), (2, [2.0, 1.0, 0.5]), (None, [0.0, -4.0, 1.0]), (5, [9.0, 9.0, 9.0])]
    bad = [(6, None), (7, []), (8, [1.0, None, 2.0]), (9, [nan, 1.0, 2.0]), (10, [1.0, -inf, 0.0]), (11, [1.0, 2.0])]
    out = whitened_rows(spark, good + bad)
    n, _, ys, cov = brute_moments([v for _, v in good])
    assert Counter((r.vec_id, r.n, r.deviation) for r in out) == Counter(
        (i, n, sum(z * z for z in y)) for (i, _), y in zip(good, ys))
    w = np.array([r.whitened for r in out], dtype=float)
    assert np.abs(w.T @ w / n - np.eye(3)).max() < 1e-9 and out[0].identity_error < 1e-9
    # flat directions are not whitened, and take no part in the error
    flat = whitened_rows(spark, [(i, [float(i), 5.0, float(i)]) for i in range(6)])
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in flat)
    assert flat[0].explained[0] == pytest.approx(1) and flat[0].identity_error < 1e-9
    # no variance at all; no vector at all; fewer components
    same = whitened_rows(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(0, [None] * 2, [None] * 2, None)] * 2
    assert whitened_rows(spark, bad[:5]) == [] and whitened_rows(spark, []) == []
    assert {len(r.whitened) for r in whitened_rows(spark, good, components=2)} == {2}
    # grid values by floor, far from zero and below it
    far = [(1, [1e6 + 0.51]), (2, [-1e6 - 0.51]), (3, [0.0])]
    _, _, ys, _ = brute_moments([np.float32(v).tolist() for _, v in far])
    assert {r.vec_id: r.deviation for r in whitened_rows(spark, far)} == {i: y[0] ** 2 for (i, _), y in zip(far, ys)}
    # columns of other names and clashing ones
    emb = spark.createDataFrame([(1, [1.0, 2.0], 3, "a"), (2, [0.0, 4.0], 3, "b"), (3, [5.0, 5.0], 3, "c")],
                                "n int, v array<double>, deviation int, id string")
    assert {r.id for r in whitening.whiten(emb, "id", "v").collect()} == {"a", "b", "c"}
    with pytest.raises(Exception, match="too large|too far"):
        whitened_rows(spark, [(1, [3e38]), (2, [1.0])])


# --- chat formatting


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.public_vocabulary()


SAYINGS = st.lists(st.sampled_from(list("<s>/[]INST\\ab \n") + ["é", "日", "🙂", "[/INST]", "</s>", "[\\INST]"]),
                   max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<s>"]), SAYINGS), max_size=6))
def test_rendered_turns_can_be_read(turns):
    text, spans = chat.render(turns)
    assert list(chat.parse(text)) == turns
    for _, said in turns:
        assert chat.unescape(chat.escape(said)) == said
        assert not any(c in chat.escape(said) for c in chat.CONTROL)
    raw = text.encode()
    learned = [chat.unescape(raw[a:b].decode()) for a, b in spans]
    assert learned == [t for r, t in turns if r == "assistant" and t]


def test_ids_are_those_of_the_library(vocabulary):
    ranks, pattern = vocabulary
    ids = {c: len(ranks) + k for k, c in enumerate(chat.CONTROL)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=ids)
    encoder = chat.Encoder(ranks, pattern, "test")
    turns = [("user", "Où est  la gare?\n"), ("assistant", " Là-bas 🙂 [INST] x"), ("assistant", "")]
    text, spans = chat.render(turns)
    got, ends = encoder.encode(text)
    assert got.tolist() == library.encode(text, allowed_special="all")
    assert ends[-1] == len(text.encode()) and encoder.decode(got) == text.encode()
    # every token by itself, against the search
    loss = chat.mask(ends, spans)
    begins = np.concatenate(([0], ends[:-1]))
    assert loss.tolist() == [int(any(a < y and x < b for a, b in spans)) for x, y in zip(begins, ends)]
    assert b"".join(encoder.decode(got[a:b]) for a, b in chat.runs(loss)).decode() == chat.escape(turns[1][1])


def test_mask_of_any_spans():
    rng = random.Random(4)
    for _ in range(200):
        ends = np.cumsum([rng.randint(1, 5) for _ in range(rng.randint(1, 40))])
        at = sorted(rng.sample(range(ends[-1] + 1), min(2 * rng.randint(0, 4), ends[-1] // 2 * 2)))
        spans = list(zip(at[::2], at[1::2]))
        begins = np.concatenate(([0], ends[:-1]))
        assert chat.mask(ends, spans).tolist() == [
            int(any(a < y and x < b for a, b in spans)) for x, y in zip(begins, ends)]


def brute_chat(rows):
    told = defaultdict(list)
    for c, t, r, x in rows:
        told[c].append((t is not None, t, r or "", x or ""))
    out = {}
    for c, turns in told.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        said = "".join(x for *_, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(said), sha(said))
    return out


@pytest.mark.parametrize("segment", [1, 60, chat.SEGMENT])
def test_conversations_and_their_cuts(spark, vocabulary, segment):
    ranks, pattern = vocabulary
    rows = [(1, 1, "assistant", "oui [INST]"), (1, 0, "user", "ça va?"), (1, 2, "assistant", None),
            (1, 2, None, "tie"), (1, 2, None, "tie"), (1, 3, "assistant", "\\[\\INST] <\\</s>"),
            (2, None, "assistant", "no turn"), (2, 5, "system", "x" * 300_000), (2, 6, "assistant", " " * 5000),
            (None, 0, "user", "nobody's"), (None, 1, "assistant", ""), (3, 0, None, None), (-1, 7, "assistant", "é" * 99)]
    convs = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                  "conv_id long, turn long, role string, text string, segment string, c int")
    made = chat.format_conversations(convs, ranks, pattern, segment=segment)
    out = {r.conv_id: r for r in chat.read_back(made, ranks, pattern).collect()}
    want = brute_chat(rows)
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in out.items()} == want
    parts = made.orderBy("conv_id", "segment").collect()
    whole = defaultdict(str)
    for p in parts:
        whole[p.conv_id] += p.formatted
        assert len(p.ids) == 4 * len(p.loss)
    assert {c: len(t) for c, t in whole.items()} == {c: r.formatted_chars for c, r in out.items()}
    assert all(t.startswith("<s>") and t.count("<s>") == 1 for t in whole.values())
    ids = defaultdict(bytes)
    for p in parts:
        ids[p.conv_id] += bytes(p.ids)
    encoder = chat.Encoder(ranks, pattern, "test")
    assert all(encoder.encode(whole[c])[0].tobytes() == ids[c] for c in whole)  # as if it were encoded once
    if segment == chat.SEGMENT:
        assert [p.segment for p in parts if p.conv_id == 1] == [0]
        assert [p.segment for p in parts if p.conv_id == 2] == [0, 1]
    none = chat.format_conversations(convs.limit(0), ranks, pattern)
    assert chat.read_back(none, ranks, pattern).collect() == []


def test_chat_of_the_given_conversations(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    got = chat.op12_chat_format(spark, SF_SMALL).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute_chat(
        rows + chat.PROBE)


# --- source divergence


def brute_audit(rows, top=200):
    words, docs = defaultdict(Counter), defaultdict(Counter)
    sources = defaultdict(set)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text.translate(lower))
        sources[lang].add(source)
        words[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, own in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        p, v = {}, len(kept)
        for s in own:
            n = sum(words[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10 ** 9 * (words[lang, s][t] + 1) // (n + v) for t in kept}
        n = sum(words[lang, s][t] for s in own for t in kept)
        q = {t: 1 + 10 ** 9 * (sum(words[lang, s][t] for s in own) + 1) // (n + v) for t in kept}
        for a in own:
            pairs = [(sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept), b) for b in own if b != a]
            terms = [((p[a][t] - q[t]) ** 2 // q[t], t) for t in kept if words[lang, a][t] and p[a][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, a, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])}
    return out


def audited(df):
    out = df.collect()
    assert len(out) == len(set(out))
    return {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in out}


def test_divergence_of_the_given_documents(spark):
    rows = duckdb.sql(f"SELECT text, lang, source FROM '{SF_SMALL}/documents.parquet'").fetchall()
    assert audited(divergence.op13_source_divergence(spark, SF_SMALL)) == brute_audit(rows)


def some_rows(seed=2):
    rng = random.Random(seed)
    words = ["a", "B", "b", "été", "ÉTÉ", "日本", "𝒳", "x1y", "don't"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "fr"]), rng.choice("stuv"))
            for _ in range(60)]
    rows += [(None, "en", "s"), ("", "de", "s"), ("a a a", None, None), ("a", "", ""), ("a, A", None, "t"),
             ("b", None, "t"), ("unknown word", "xx", "lonely"), ("z" * 100_000, "fr", "s"), ("12 _ -", "en", "empty")]
    return rows + rows[:5]


def test_divergence_edge_cases(spark):
    rows = some_rows()
    docs = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, p int, item string")
    want = brute_audit(rows)
    assert {("de", "s"), ("xx", "lonely")}.isdisjoint({r[:2] for r in want})
    assert audited(divergence.audit(docs)) == want
    # blocks that spill at every document, a report of two terms
    assert audited(divergence.audit(docs.repartition(5), block_bytes=1, top_terms=2)) == brute_audit(rows, 2)
    assert divergence.audit(docs.limit(0)).collect() == []


@pytest.mark.parametrize("piece, open_terms", [(3, 1), (3, 20), (2048, 1 << 18)])
def test_runs_are_merged_by_term(monkeypatch, piece, open_terms):
    monkeypatch.setattr(divergence, "PIECE", piece)
    monkeypatch.setattr(divergence, "ROUND", open_terms)
    monkeypatch.setattr(divergence, "WORDS", 20)
    monkeypatch.setattr(divergence, "PART", 200)
    rng = random.Random(8)
    want, pieces = defaultdict(lambda: [0, Counter()]), []
    for _ in range(9):
        block = divergence.Block()
        for _ in range(6):
            lang, source = rng.choice("ef"), rng.choice("stu")
            words = rng.choices([chr(97 + i) * rng.randint(1, 2) for i in range(12)], k=rng.choice([0, 9, 300]))
            block.add(lang, source, " ".join(words))
            for w in set(words):
                want[lang, w][0] += 1
            want[lang, "total"][1].update(words)
            for w in words:
                want[lang, w][1][source] += 1
        pieces += block.runs(4)
    del want["e", "total"], want["f", "total"]
    batches = list(divergence.merged(iter(sorted(pieces, key=lambda p: p[:3])), 2))
    got = [r for b in batches for r in b.to_pylist()]
    assert {(r["lang"], r["term"]): [r["docs"], dict(zip(r["sources"], r["counts"]))] for r in got} == {
        k: [n, dict(c)] for k, (n, c) in want.items() if n >= 2}
    assert all(r["total"] == sum(r["counts"]) for r in got) and len(got) == len({(r["lang"], r["term"]) for r in got})
    assert (len(batches) > 20) == (piece == 3 and open_terms == 1)


@pytest.mark.parametrize("cells", [1, 5, 1 << 20])
def test_pair_sums_in_stripes(monkeypatch, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)
    rng = random.Random(6)
    sums, want = divergence.PairSums(), Counter()
    f = lambda x, y: (x - y) ** 2 // y
    zero = {s: rng.randint(1, 5) for s in "abcde"}
    number = {s: sums.numbers["l", s] for s in zero}
    for _ in range(3):
        terms = [{s: rng.randint(1, 10 ** 9) for s in rng.sample("abcde", rng.randint(1, 5))} for _ in range(4)]
        flat = [(number[s], p, zero[s]) for t in terms for s, p in t.items()]
        names, p, z = map(np.array, zip(*flat))
        sums.terms(names, np.array([len(t) for t in terms]), p, z)
        for t in terms:
            for a in t:
                for b in t:
                    want["l", a, b] += f(t[a], t[b]) - f(t[a], zero[b]) - f(zero[a], t[b]) + f(zero[a], zero[b])
    assert {r[:3]: r[3] for r in sums.rows()} == {k: v for k, v in want.items() if k[1] != k[2]}
