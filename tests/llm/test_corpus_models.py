"""Language-model scores, the Merkle manifest and spelling variants."""

import collections
import functools
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import lm_score, merkle, queries, spelling
from ledgerline.llm.common import stored
from ledgerline.llm.shingles import mix, word_hashes
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def crc(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode())


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_spelling_variants"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


# --- language-model scores --------------------------------------------------------

def model_written_out(texts):
    """Counts of all training texts: (tokens, unigrams, bigrams)."""
    one, two = collections.Counter(), collections.Counter()
    for t in texts:
        tokens = [*cases.blank_words(t), None]
        one.update(tokens)
        two.update(zip(tokens, tokens[1:]))
    return sum(one.values()), one, two


def quantised(c):
    return float(lm_score.VALUE[np.searchsorted(lm_score.LEAST, c, "right")])


def reader(model):
    """The count that the model's filter gives for an n-gram, keyed word by word."""
    bits = lm_score.Filter.of({r["segment"]: r["bits"] for r in model.filter.collect()}, model.segments)

    def count(gram):
        key = None
        with np.errstate(over="ignore"):
            for k, w in enumerate(gram):
                h = np.uint64(lm_score.END) if w is None else word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[0][0]
                key = mix(h + np.uint64(1)) if k == 0 else mix(key * np.uint64(0x9E3779B97F4A7C15) + h + np.uint64(k + 1))
        return lm_score.VALUE[lm_score.levels_of(np.array([key]), bits)][0]

    return functools.cache(count)


def scores_written_out(text, n, one, count):
    tokens = [*cases.blank_words(text), None]
    v = len(one)
    base = sum(math.log10((one[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
    mass = sum(map(quantised, one.values()))
    total = 0.0
    for k, t in enumerate(tokens):
        p = (count((t,)) + 0.1) / (mass + 0.1 * (v + 1))
        if k:
            past = count((tokens[k - 1],))
            seen = min(count((tokens[k - 1], t)), past, count((t,)))
            p = (seen + lm_score.PRIOR * p) / (past + lm_score.PRIOR)
        total += math.log10(p)
    return len(tokens), sum(one[t] > 0 for t in tokens), base, total


@pytest.mark.parametrize("real", [False, True])
def test_scores_equal_those_written_out(spark, real, monkeypatch):
    monkeypatch.setattr(lm_score, "SLICE", 1 << 16)
    docs = (cases.real_documents(spark).filter("doc_id < 60") if real else cases.documents(spark)).repartition(3)
    rows = docs.select("doc_id", "text").collect()
    learn = [r["text"] for r in rows if r["doc_id"] is not None and crc(r["doc_id"]) % 10]
    n, one, two = model_written_out(learn)
    model = lm_score.train(stored(lm_score.tokenised(docs), "tokens"))
    count = reader(model)
    assert (model.tokens, model.distinct) == (n, len(one))
    assert all(count((w,)) >= quantised(c) for w, c in one.items()) and all(count(g) >= quantised(c) for g, c in two.items())
    assert np.mean([count(g) > quantised(c) for g, c in two.items()]) < 0.08
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["doc_id"] is not None and crc(r["doc_id"]) % 10 == 0,
                   *scores_written_out(r["text"], n, one, count)) for r in rows)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"],
                  r["train_tokens"]) for r in lm_score.score(docs).collect())
    assert [g[:4] for g in got] == [w[:4] for w in want] and {g[6] for g in got} == {n}
    assert np.allclose([g[4:6] for g in got], [w[4:6] for w in want], rtol=1e-11)


def test_filter_counts_are_never_too_low_and_rarely_too_high():
    rng = np.random.default_rng(1)
    rest = np.unique(rng.integers(0, 2**32, 200_000, dtype=np.uint64)).astype("<u4")
    n = np.ceil(rng.pareto(1.0, len(rest)) + 1e-9).astype(np.int64).clip(1, 10**9)
    bits = lm_score.Filter.of({0: lm_score.fill(rest, n)}, 1)
    levels, true = bits.levels(rest, np.zeros(len(rest), np.int64)), np.searchsorted(lm_score.LEAST, n, "right")
    assert (levels >= true).all() and (levels > true).mean() < 0.06 and (levels > true + 1).mean() < 0.006
    other = np.setdiff1d(rng.integers(0, 2**32, 200_000, dtype=np.uint64).astype("<u4"), rest)
    assert (bits.levels(other, np.zeros(len(other), np.int64)) > 0).mean() < 0.06


@pytest.mark.parametrize("order", [1, 2, 3])
def test_a_filter_that_is_not_broadcast_gives_the_same_scores(spark, order, monkeypatch):
    monkeypatch.setattr(lm_score, "SLICE", 1 << 14)
    monkeypatch.setattr(lm_score, "SEGMENT", 1 << 11)
    docs = cases.real_documents(spark).repartition(3)
    sent = cases.rows(lm_score.score(docs, order), "doc_id", "score", "base_score")
    asked = cases.rows(lm_score.score(docs, order, filter_bytes=0), "doc_id", "score", "base_score")
    assert sent == asked and len(sent) == docs.count()


def test_longer_contexts_predict_held_out_texts_better(spark):
    docs = cases.real_documents(spark, "/root/testdata/sf0.01")
    found = lm_score.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_scores_of_few_documents(spark):
    assert lm_score.score(cases.empty(spark)).collect() == []
    alone = next(i for i in range(1000) if crc(i) % 10 == 0)
    row = lm_score.score(spark.createDataFrame([(alone, "a b")], "doc_id bigint, text string")).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)
    blank = lm_score.score(spark.createDataFrame([(1, None), (2, " \n")], "doc_id bigint, text string")).collect()
    assert [r["n_tokens"] for r in blank] == [1, 1]


# --- Merkle manifest --------------------------------------------------------------

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    parts = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def tree(leaves):
    """(root, siblings left and right of each leaf's branch, level by level)."""
    paths = [[] for _ in leaves]
    under = [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        for i, at in enumerate(under):
            lo = i - i % 3
            for leaf in at:
                paths[leaf].append(("".join(leaves[lo:i]), "".join(leaves[i + 1:lo + 3])))
        leaves = [h("".join(leaves[k:k + 3])) for k in range(0, len(leaves), 3)]
        under = [sum(under[k:k + 3], []) for k in range(0, len(under), 3)]
    return leaves[0], paths


def manifest(rows):
    sources = collections.defaultdict(list)
    for r in rows:
        text = r["text"]
        now = text.replace("\n", "") if text is not None and r["doc_id"] is not None and crc(r["doc_id"]) % 2 == 0 else text
        sources[r["source"]].append((r["doc_id"], leaf_of(r, text), leaf_of(r, now)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        at = sorted(sources[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((at, *tree([x[1] for x in at])))
    root, above = tree([t[1] for t in trees])
    out = []
    for (at, sub, paths), top in zip(trees, above):
        for (doc, leaf, now), path in zip(at, paths):
            acc = now
            for left, right in path + top:
                acc = h(left + acc + right)
            out.append((doc, leaf, sub, root, h("".join(a + b for a, b in path + top)), acc, acc == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest_of_odd_documents(spark):
    docs = cases.documents(spark).withColumn("source", F.when(F.col("doc_id") == 3, None).when(
        F.col("doc_id") == 4, "é").when(F.col("doc_id") == 5, "\U0001f600").otherwise(F.col("source")))
    assert cases.rows(merkle.without_line_ends(docs), *COLUMNS) == manifest(docs.collect())


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [10, 1, 1, 28], [400, 4]])
def test_manifest_of_trees_of_many_sizes(spark, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "FAR", 2)  # salted joins
    rows = [(100 * s + i if i % 7 else s, f"s{s}", None, i, f"line\n{i % 5}") for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(4)
    assert cases.rows(merkle.without_line_ends(docs), *COLUMNS) == manifest(docs.collect())


def test_manifest_of_real_documents_and_of_none(spark):
    docs = cases.real_documents(spark)
    assert cases.rows(merkle.without_line_ends(docs), *COLUMNS) == manifest(docs.collect())
    assert merkle.without_line_ends(cases.empty(spark)).collect() == []
    assert merkle.verify(docs).filter("verified").count() == docs.count()


def test_a_large_set_of_sources_is_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_SOURCES", 0)
    docs = cases.documents(spark)
    assert cases.rows(merkle.without_line_ends(docs), *COLUMNS) == manifest(docs.collect())


# --- spelling variants ------------------------------------------------------------

def words_written_out(rows):
    found = collections.Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = cases.lower(run)
            if r["doc_id"] is not None:
                x = zlib.crc32(f"{r['doc_id']}:{run}".encode())
                if x % 31 == 0:
                    run = run[:x % len(run)] + run[x % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_written_out(rows):
    n = words_written_out(rows)
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def last(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], last(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def check_variants(docs):
    got = cases.rows(spelling.variants(docs), "word", "form", "root", "n", "n_near", "form_n")
    assert got == variants_written_out(docs.select("doc_id", "text").collect())
    return got


def test_variants_of_odd_and_of_real_documents(spark):
    check_variants(cases.documents(spark))
    check_variants(cases.real_documents(spark).limit(60))
    assert spelling.variants(cases.empty(spark)).collect() == []


def test_chains_ties_and_very_long_words(spark):
    rng = random.Random(5)
    times = {"abcdefgh": 3, "abcdefghi": 40, "abcdefghij": 500, "xbcdefghij": 500, "ABCDEFGHI": 2, "über÷×ÿxy": 2, "uber÷×ÿxy": 30,
             "aaaaaaa": 4, "aaaaaaaa": 50, "aaaaaaaaa": 600, "z" * 300: 2, "z" * 301: 25, "z" * 150 + "y" + "z" * 149: 3}
    for _ in range(150):  # words over two letters, of which many are near
        times["".join(rng.choices("ab", k=rng.randint(7, 9)))] = rng.randint(1, 40)
    tokens = [w for w, k in times.items() for _ in range(k)]
    rng.shuffle(tokens)
    rows = [(i, " 1".join(tokens[i::40])) for i in range(40)] + [(None, "abcdefghij abcdefghij")]
    got = check_variants(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert any(r[1] is not None and r[1] != r[2] for r in got)  # a chain of two forms


def test_chunks_of_long_and_short_words_meet():
    for size in (6, 7, 8, 40, 65, 200):
        base = np.arange(size, dtype=np.uint32)[None] + 97
        short = spelling.keys(base, size)
        for at in range(size + 1):
            longer = spelling.keys(np.insert(base, at, 5, axis=1), size)
            assert (longer == short).any()
            if at < size:
                other = base.copy()
                other[0, at] = 7
                assert (spelling.keys(other, size) == short).any()
