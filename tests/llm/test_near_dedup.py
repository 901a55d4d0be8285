"""Near duplicates against all pairs of exact sets."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import components as components_module
from ledgerline.llm import near_dedup, shingles
from ledgerline.llm.common import text_bytes
from ledgerline.llm.components import components
from tests.llm import cases


def shingle_set(text, width):
    w = cases.blank_words(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(pairs, width, percent):
    """{doc_id: (n, component)} by comparing all pairs."""
    sets = {d: shingle_set(t, width) for d, t in pairs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def family(seed=3):
    """Groups of copies, chains of edits and documents that share passages."""
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(400)}"
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(20, 300))]
        texts += [edited(base, rng.randrange(0, max(1, len(base) // 25)), rng) for _ in range(rng.randrange(1, 25))]
        chain = list(base)
        for _ in range(6):
            chain = edited(chain, max(1, len(base) // 40), rng).split()
            texts.append(" ".join(chain))
    passage = [word() for _ in range(60)]
    texts += [" ".join([*passage, *(word() for _ in range(rng.randrange(5, 120)))]) for _ in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
@pytest.mark.parametrize("which", ["odd", "family", "real"])
def test_components_match_all_pairs(spark, which, width, percent):
    if which == "real":
        docs = cases.real_documents(spark)
    else:
        docs = cases.documents(spark, cases.TEXTS if which == "odd" else family())
    known = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute({d: t for d, t in known if d is not None}.items(), width, percent)
    for r in near_dedup.near_duplicates(docs, near_dedup.Rule(width, percent)).collect():
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_bands_split_in_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 3)
    monkeypatch.setattr(near_dedup, "TEXT_ROWS", 4)
    docs = cases.documents(spark, family(5))
    want = brute({(r["doc_id"]): r["text"] for r in docs.collect() if r["doc_id"] is not None}.items(), 3, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           near_dedup.near_duplicates(docs, near_dedup.Rule(3, 85)).filter("doc_id IS NOT NULL").collect()}
    assert got == want


def test_one_of_each_group_stays_with_all_columns(spark):
    docs = cases.documents(spark)
    got = near_dedup.keep_one(docs)
    assert got.columns == docs.columns
    ids = {r["doc_id"] for r in got.collect()}
    assert {17, 20} <= ids and not {18, 19, 21} & ids and {0, 1, 2} <= ids and None in ids


def test_empty_table(spark):
    assert near_dedup.near_duplicates(cases.empty(spark)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 150)] + [(200, 200), (300, 301), (301, 302), (302, 300)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 150)}, 200: 200, 300: 300, 301: 300, 302: 300}


def test_components_drop_edges_that_are_done(spark, monkeypatch):
    """A round meets only the edges that still lie between components."""
    rng = random.Random(4)
    edges = [(a, b) for g in range(3) for a in range(g * 100, g * 100 + 40) for b in rng.sample(range(g * 100, g * 100 + 40), 20)]
    edges += [(900 + 2 * k + 1, 900 + 2 * k) for k in range(20)] + [(900 + 2 * k, 903 + 2 * k) for k in range(19)]
    counts, store = [], components_module.stored

    def counted(df, name):
        out = store(df, name)
        counts.extend([out.count()] if name == "cc-edges" else [])
        return out

    monkeypatch.setattr(components_module, "stored", counted)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: 900 if x >= 900 else x // 100 * 100 for e in edges for x in e}
    assert counts[0] == len({(min(e), max(e)) for e in edges}) and counts[-1] == 0 and sum(counts[1:]) < 100


@pytest.mark.parametrize("block", [7, 4096])
def test_clusters_of_a_large_group_take_few_edges(spark, monkeypatch, block):
    """One group in many bands gives edges by its rows, not by its bands; every near pair is connected."""
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**62, near_dedup.SKETCH_WORDS)
    other = base ^ np.int64(2**40 - 1)  # 320 differing bits: not near
    rows, nodes = [], 90
    for rep in range(nodes):
        sketch = [int(x) for x in (other if rep % 9 == 4 else base)]
        for band in {0, *rng.integers(1, 24, 12).tolist()}:
            rows.append((rep, band, rep // 3 * 3, 100 if rep % 10 else 40, sketch))
    rows += [(rep, 99, 1000 + rep, 100, [int(x) for x in other]) for rep in range(1000, 1003)] + [(1010, 98, 1010, 7, [0] * 8)]
    rule = near_dedup.Rule(3, 85)
    near = [(a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[2] != b[2] and 100 * min(a[3], b[3]) >= 85 * max(a[3], b[3])
            and sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(a[4], b[4], strict=True)) <= rule.most_bits]
    want = {}
    for a, b in near * 4:
        want[a] = want[b] = min(want.get(a, a), want.get(b, b))
    given = []
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_dedup, "components", lambda e: (given.append(e.distinct().count()), components(e))[1])
    table = spark.createDataFrame(rows, "rep bigint, band bigint, label bigint, n bigint, sketch array<bigint>").repartition(5)
    got = {r["node"]: r["cluster"] for r in near_dedup.clusters(table, rule).collect()}
    assert got == want and len(set(want.values())) == 4
    assert max(given) <= 3 * nodes


def test_shingle_sets_match_plain_sets(monkeypatch):
    rng = random.Random(1)
    texts = [t for t in cases.TEXTS if t is None or len(t) < 10_000]
    texts += ["".join(rng.choice("aB \n") for _ in range(rng.randrange(200))) for _ in range(100)]
    for block in (64, 1 << 20):
        monkeypatch.setattr(shingles, "BLOCK", block)
        h, at = shingles.shingle_sets(*text_bytes(pa.array(texts)), 3)
        mine = [set(h[at[i]:at[i + 1]].tolist()) for i in range(len(texts))]
        plain = [shingle_set(t, 3) for t in texts]
        for i in range(len(texts)):
            for j in range(len(texts)):
                assert len(mine[i] & mine[j]) == len(plain[i] & plain[j])


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    other = base.copy()
    other[:100] = rng.integers(0, 2**63, 100, dtype=np.uint64)  # similarity 1900 / 2100
    far = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    sk = near_dedup.odd_sketch(near_dedup.minhash(np.concatenate([base, other, far]), np.array([0, 2000, 4000, 6000])))
    bits = lambda a, b: int(np.bitwise_count(sk[a] ^ sk[b]).sum())
    most = near_dedup.Rule(3, 85).most_bits
    assert bits(0, 1) <= most < bits(0, 2)


def test_rule_keeps_the_chance_of_a_miss_low():
    for percent in (80, 85, 90):
        r = near_dedup.Rule(5, percent).rows
        assert (1 - (percent / 100) ** r) ** (near_dedup.SAMPLES // r) <= near_dedup.MISS


def test_a_doc_id_with_several_texts(spark):
    """Documents are connected through all their texts; no text loses all its copies."""
    texts = {k: " ".join(f"{k}{i}" for i in range(12)) for k in "ABCDE"}
    rows = [(5, "A"), (9, "A"), (9, "B"), (12, "B"), (20, "C"), (20, "D"), (7, "D"), (7, "E"), (3, "E"), (40, "C"), (9, "A")]
    docs = spark.createDataFrame([(i, texts[k]) for i, k in rows] + [(9, None), (30, "")], "doc_id bigint, text string").repartition(3)
    rule = near_dedup.Rule(width=3, percent=85)
    got = {(r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in near_dedup.near_duplicates(docs, rule).collect()}
    assert got == {(5, True, 5), (9, True, 5), (12, True, 5), (20, True, 3), (7, True, 3), (3, True, 3), (40, True, 3),
                   (9, False, 9), (30, False, 30)}
    kept = sorted((r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs, rule).filter("text LIKE '% %'").collect())
    assert kept == sorted([(5, texts["A"]), (9, texts["B"]), (20, texts["C"]), (7, texts["D"]), (3, texts["E"])])
