"""Decontamination and nearest neighbours."""

import duckdb
import numpy as np
import pytest

from ledgerline.llm import ann, decontaminate, queries
from tests.llm import cases


def benchmark(spark, texts):
    return spark.createDataFrame([(i, t, "z", "z") for i, t in enumerate(texts)], "item_id bigint, text string, gram string, samples string")


def brute(docs, items, width=5, percent=80):
    grams = lambda t: {tuple(w[i:i + width]) for w in [[x.lower() for x in cases.blank_words(t)]] for i in range(len(w) - width + 1)}
    out = {}
    for i, t in enumerate(items):
        g = grams(t)
        for d, text in docs:
            common = len(g & grams(text))
            if g and common * 100 >= len(g) * percent:
                out[d, i] = (len(g), common)
    return out


ITEMS = [None, "", "too short here", "same old words said again and again", cases.LONG[:2000], " ".join(f"w{i * i % 977}" for i in range(100, 160)),
         "same old words said again and then something quite other follows in the item",
         " ".join(f"w{i * i % 977}" for i in range(300, 340)) + " x y", "MIT license apache license mit license"]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_SHINGLES, 50])
def test_containment_against_all_pairs(spark, block):
    docs = cases.documents(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS)
    got = {(r["doc_id"], r["item_id"]): (r["n_item"], r["n_common"]) for r in
           decontaminate.containment_pairs(docs, benchmark(spark, ITEMS), block_shingles=block).collect()}
    assert got == want and want


def test_real_documents_match_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    want = sorted(con.sql("SELECT doc_id, item_id, n_item, n_common, containment FROM (" + queries.ORACLE["op8_decontamination"] + ")").fetchall())
    got = queries.op8_decontamination(spark, "/root/testdata/sf0.01")
    assert sorted(map(tuple, got.select("doc_id", "item_id", "n_item", "n_common", "containment").collect())) == want and want


def test_clean_keeps_the_others_with_all_columns(spark):
    docs = cases.documents(spark)
    got = decontaminate.clean(docs, benchmark(spark, ITEMS))
    assert got.columns == docs.columns
    gone = {d for d, _ in brute([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS) if d is not None}
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in docs.collect()} - gone
    assert decontaminate.clean(cases.empty(spark), benchmark(spark, ITEMS)).count() == 0
    assert decontaminate.clean(docs, benchmark(spark, ITEMS).limit(0)).count() == docs.count()


def truth(ids, x, every, k=10):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = sorted((d[j], ids[j]) for j in range(len(ids)) if ids[j] != ids[i])[:k]
        out[int(ids[i])] = order
    return out


def test_recall_and_exact_scores(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    raw = duckdb.sql(f"SELECT vec_id, embedding FROM '{path}' ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in raw]), np.array([r[1] for r in raw], float)
    want = truth(ids, x, 100)
    got: dict[int, list] = {}
    for r in ann.search(spark.read.parquet(path)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"], r["rank"]))
    assert got.keys() == want.keys()
    place = {v: i for i, v in enumerate(ids)}
    hits = 0
    for q, rows in got.items():
        assert [r[2] for r in rows] == list(range(1, 11)) and rows == sorted(rows)
        for s, v, _ in rows:
            assert v != q and abs(s - np.linalg.norm(x[place[q]] - x[place[v]])) < 1e-12
        hits += len({v for _, v, _ in rows} & {v for _, v in want[q]})
    assert hits / (10 * len(want)) >= 0.9


def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (6, [None, 1.0, 1.0]),
            (7, [1.0, 2.0]), (8, [0.0, 1.0, 2.5]), (9, [0.0, 1.0, 2.5]), (10, [5.0, 5.0, 5.0]), (100, [0.0, 1.0, 2.0]), (None, [1.0, 1.0, 1.0]),
            (8, [0.0, 1.0, 2.5]), (8, [9.0, 9.0, 9.0])]
    return spark.createDataFrame([(*r, "z", "z") for r in rows], "vec_id bigint, embedding array<float>, cell string, block string")


def test_odd_vectors(spark):
    got = [tuple(r) for r in ann.search(odd_vectors(spark)).orderBy("query_id", "rank").select("query_id", "rank", "vec_id").collect()]
    assert got == [(0, 1, 100), (0, 2, 8), (0, 3, 9), (0, 4, 10), (100, 1, 0), (100, 2, 8), (100, 3, 9), (100, 4, 10)]
    assert ann.search(odd_vectors(spark).limit(0)).count() == 0
    assert ann.search(odd_vectors(spark).filter("vec_id = 0")).count() == 0


def test_hot_cells_and_small_blocks(spark, monkeypatch):
    """A third of the rows are one vector; blocks and query parts are tiny."""
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 6)).astype(np.float32).astype(float)
    x[::3] = x[0]
    ids = np.arange(900)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<float>").repartition(4)
    want = truth(ids, x, 30)
    got: dict[int, list] = {}
    for r in ann.search(df, every=30).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = sum(len(set(got[q]) & {v for _, v in rows}) for q, rows in want.items())
    assert got.keys() == want.keys() and hits / (10 * len(want)) >= 0.9


def distinct_truth(rows, every, k=10):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    out = {}
    for q in sorted({i for i in ids.tolist() if i % every == 0}):
        best: dict[int, float] = {}
        for at in np.flatnonzero(ids == q):
            for j, d in zip(ids.tolist(), np.sqrt(((x - x[at]) ** 2).sum(1)).tolist()):
                if j != q:
                    best[j] = min(best.get(j, np.inf), d)
        out[q] = {j for _, j in sorted((d, j) for j, d in best.items())[:k]}
    return out


@pytest.mark.parametrize("case", ["one row", "near rows", "spread rows", "evenly"])
def test_repeated_ids_do_not_fill_the_places(spark, monkeypatch, case):
    """One vec_id holds a third of the table, as one row, close together or
    all over; or every vec_id has 30 rows close together."""
    monkeypatch.setattr(ann, "BLOCK", 256)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 6))
    if case == "evenly":
        rows = [(i, x[i] + rng.normal(size=6) * 1e-3 * (r > 0)) for i in range(100) for r in range(30)]
    else:
        width = {"one row": 0, "near rows": 0.05, "spread rows": 1}[case]
        rows = [(i, v) for i, v in enumerate(x)] + [(7, x[0] + rng.normal(size=6) * width) for _ in range(1000)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id bigint, embedding array<double>").repartition(4)
    want = distinct_truth(rows, 50 if case != "evenly" else 20)
    got: dict[int, list] = {}
    for r in ann.search(df, every=50 if case != "evenly" else 20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got.keys() == want.keys() and all(len(set(v)) == 10 == len(v) for v in got.values())
    assert sum(len(set(got[q]) & want[q]) for q in want) / (10 * len(want)) >= 0.9


def test_walk_counts_ids_in_one_cell_only():
    da, db, rows, ids = np.array([0.0, 1, 2, 3]), np.zeros(1), np.array([5, 0, 9, 4]), np.array([3, 0, 0, 4])
    assert ann.walk(da, db, rows, 3, ids) == [0] and ann.walk(da, db, rows, 4, ids) == [0, 2, 3]


def test_walk_visits_cells_in_order():
    rng = np.random.default_rng(2)
    da, db = rng.random(7), rng.random(5)
    counts = rng.integers(0, 4, 35)
    sums = (da[:, None] + db[None]).ravel()
    order = [int(c) for c in np.argsort(sums, kind="stable") if counts[c]]
    assert ann.walk(da, db, counts, 1e9) == order
    some = ann.walk(da, db, counts, 10)
    assert some == order[:len(some)] and counts[some].sum() >= 10 > counts[some[:-1]].sum()


def test_blocks_hold_near_cells(monkeypatch):
    """Every cell lies in one block (a hot one in several of its own), no block
    is overfull, and on clustered cells a walk touches few of them."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(100, 8))
    x = centres[rng.integers(0, 100, 12_000)] + 0.05 * rng.normal(size=(12_000, 8))
    index = ann.Index(ann.codebook(x[:, :4], 32), ann.codebook(x[:, 4:], 32))
    cells = index.cells(x)
    index.counts = np.bincount(cells, minlength=32 * 32)
    index.counts[cells[0]] += 1000
    first, parts = index.layout()
    assert parts[cells[0]] == -(-index.counts[cells[0]] // 64)
    load, owner = {}, {}
    for c in np.flatnonzero(index.counts):
        for b in range(first[c], first[c] + parts[c]):
            load[b] = load.get(b, 0) + index.counts[c] / parts[c]
            owner.setdefault(b, []).append(c)
    assert max(load.values()) <= 64 and sorted(load) == list(range(len(load)))
    assert all(len(cs) == 1 for cs in owner.values() if parts[cs[0]] > 1)
    da, db = index.halves(x[:200])
    visited = [len({first[c] for c in ann.walk(da[i], db[i], index.counts, 20)}) for i in range(200)]
    assert np.mean(visited) < 0.05 * len(load)


def test_share_read_falls_on_clustered_vectors(spark, monkeypatch):
    """Four times the vectors in the same clusters: a query touches a smaller
    share of the blocks, at the recall that is promised."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "CELL", 4)
    shares = []
    for n in (4000, 16_000):
        rng = np.random.default_rng(6)
        x = rng.normal(size=(200, 8))[rng.integers(0, 200, n)] + 0.05 * rng.normal(size=(n, 8))
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(4)
        seen, real = [], ann.compared
        monkeypatch.setattr(ann, "compared", lambda e, v, s, k: (seen.append((v, s.value)), real(e, v, s, k))[1])  # noqa: B023
        every = n // 200
        want = truth(np.arange(n), x, every)
        got: dict[int, set] = {}
        for r in ann.search(df, every=every).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        monkeypatch.setattr(ann, "compared", real)
        assert sum(len(got[q] & {v for _, v in rows}) for q, rows in want.items()) / (10 * len(want)) >= 0.9
        visited, (index, first, parts, _) = seen[0]
        shares.append(visited.count() / len(want) / int((first + parts)[index.counts > 0].max()))
    assert shares[1] < 0.5 * shares[0]
