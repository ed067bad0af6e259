from __future__ import annotations

import re

import numpy as np
import pytest

from spindlewave.llm import ann, components, embed_dedup, minhash, shingles
from spindlewave.llm.common import utf8
from tests.llm.conftest import odd_rows


def word_sets(text, width):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    found = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not found:
        return set()
    return {tuple(found[k : k + width]) for k in range(max(1, len(found) - width + 1))}


def groups(names, linked):
    """Smallest name reachable, by brute force."""
    root = {name: name for name in names}
    again = True
    while again:
        again = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                again = True
    return root


def duplicates_by_brute_force(rows, width, percent=80):
    sets = [(doc_id, word_sets(text, width)) for doc_id, text in rows]
    named = [(doc_id, s) for doc_id, s in sets if doc_id is not None]
    linked = [
        (a, b) for i, (a, x) in enumerate(named) for b, y in named[:i]
        if a == b or (x and y and 100 * len(x & y) >= percent * len(x | y))
    ]
    root = groups({doc_id for doc_id, _ in named}, linked)
    return sorted(
        ((doc_id, len(s), root.get(doc_id), doc_id == root.get(doc_id)) for doc_id, s in sets), key=str
    )


@pytest.mark.parametrize("width", [2, 5])
def test_shingle_sets(width):
    import pyarrow as pa

    texts = [r[1] for r in odd_rows()] + ["a b", "A  b\x0bc", " x", "y "]
    data, starts = utf8(pa.array(texts))
    members, cut = shingles.shingle_sets(data, starts, width)
    assert np.diff(cut).tolist() == [len(word_sets(text, width)) for text in texts]
    one, _ = shingles.shingle_sets(*utf8(pa.array(["A  b\x0bc"])), width)
    other, _ = shingles.shingle_sets(*utf8(pa.array(["a b c"])), width)
    assert (one == other).all()


def test_superminhash_estimates():
    random = np.random.default_rng(0)
    values = random.integers(1, 1 << 63, 4000).astype(np.uint64)
    size, errors = 240, []
    for _ in range(60):
        n = int(random.integers(5, 300))
        shared = int(random.integers(1, n + 1))
        a = np.sort(random.choice(values, 2 * n - shared, replace=False))
        random.shuffle(a)
        x, y = np.sort(a[:n]), np.sort(a[n - shared :])
        s, t = minhash.superminhash(np.concatenate([x, y]), np.array([0, n, 2 * n]), size)
        errors.append(float((s == t).mean()) - shared / (2 * n - shared))
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.035  # plain minhash: about 0.03 for large sets
    alone = minhash.superminhash(values[:1], np.array([0, 1]), size)
    assert sorted((alone[0] >> np.uint64(32)).tolist()) == list(range(size))  # one permutation


@pytest.mark.parametrize("width", [2, 5])
def test_odd_documents(odd_docs, no_docs, width):
    found = sorted((tuple(r) for r in minhash.near_duplicates(odd_docs, width).collect()), key=str)
    expected = duplicates_by_brute_force([(r[0], r[1]) for r in odd_rows()], width)
    expected = [(d, n, c, d == c if d is not None else True) for d, n, c, _ in expected]
    assert found == sorted(expected, key=str)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_groups_that_a_leader_does_not_hold_together(spark, monkeypatch):
    """Chains of copies, each a little further from the first, and many copies of each."""
    monkeypatch.setattr(minhash, "CELL", 2000)
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(6):
        text = random.choice(words, 60).tolist()
        for _ in range(40):
            text = list(text)
            for _ in range(int(random.integers(1, 5))):
                text[int(random.integers(60))] = str(random.choice(words))
            texts.append(" ".join(text))
    texts += texts[::7] + [" ".join(random.choice(words[:30], 12)) for _ in range(60)]
    rows = [(int(k), text) for k, text in zip(random.permutation(len(texts)), texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in minhash.near_duplicates(docs, 2).collect()), key=str)
    assert found == duplicates_by_brute_force(rows, 2)


def test_blocks():
    random = np.random.default_rng(0)
    sides = [[np.unique(random.integers(0, 40, 30).astype(np.uint64)) for _ in range(50)] for _ in range(2)]
    old, minhash.MATCHES = minhash.MATCHES, 100
    i, j = minhash.block_links(*sides, 60)
    minhash.MATCHES = old
    expected = {
        (a, b) for a, x in enumerate(sides[0]) for b, y in enumerate(sides[1])
        if 100 * len(np.intersect1d(x, y)) >= 60 * len(np.union1d(x, y))
    }
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == expected


def test_components(spark):
    random = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in random.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1100)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "u long, v long").repartition(7)).collect()}
    root = groups({x for link in links for x in link}, links)
    assert {x: found.get(x, x) for x in root} == root
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def vector_rows():
    random = np.random.default_rng(2)
    rows = [(k, random.normal(size=16).tolist()) for k in range(120)]
    for k in range(120, 300):  # groups around some vectors, some chained
        base = np.array(rows[int(random.integers(k - 20, k)) if k % 3 else k % 10][1])
        rows.append((k, (base * random.uniform(0.1, 9) + random.normal(size=16) * 0.02).tolist()))
    rows += [(400 + k, rows[k][1]) for k in range(0, 50, 5)]  # copies
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [None] + [1.0] * 15),
             (505, [float("inf")] * 16), (506, [1.0, 0.0]), (507, [2.0, 0.0]), (508, [1e300] * 16), (509, [1e300] * 16),
             (510, [1e-200] * 16), (3, rows[3][1]), (None, rows[3][1]), (-7, rows[8][1]), (511, [3.0])]
    return rows


def vectors(spark, rows):
    schema = "vec_id long, embedding array<double>, node string, data string, dim string, label int, rank string"
    return spark.createDataFrame([(*r, "n", None, "d", 1, "r") for r in rows], schema).repartition(3)


def usable(x):
    return x is not None and len(x) > 0 and None not in x and bool(np.isfinite(x).all()) and any(x)


@pytest.mark.parametrize("tile, group", [(40, 8), (6, 2), (2, 1)])
def test_near_vectors(spark, monkeypatch, tile, group):
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    monkeypatch.setattr(embed_dedup, "GROUP", group)
    monkeypatch.setattr(embed_dedup, "ROWS", 16)
    rows = vector_rows()
    units = [None if n is None or not usable(x) else np.array(x) / max(x, key=abs) for n, x in rows]
    units = [None if x is None else np.sign(rows[k][1][int(np.abs(x).argmax())]) * x / np.linalg.norm(x) for k, x in enumerate(units)]
    links = [
        (i, j) for i, x in enumerate(units) for j, y in enumerate(units)
        if i != j and x is not None and y is not None and len(x) == len(y) and x @ y >= 0.95
    ]
    names = {r[0] for r in rows if r[0] is not None}
    root = groups(names, [(rows[i][0], rows[j][0]) for i, j in links])
    expected = sorted(
        ((name, sum(i == k for i, _ in links), root.get(name), name is None or root[name] == name) for k, (name, _) in enumerate(rows)),
        key=str,
    )
    found = sorted((tuple(r) for r in embed_dedup.near_vectors(vectors(spark, rows)).collect()), key=str)
    assert found == expected
    assert embed_dedup.near_vectors(vectors(spark, rows).limit(0)).count() == 0


def neighbours_by_brute_force(rows, queries, k):
    there = [(n, np.array(x)) for n, x in rows if n is not None and usable(x) and len(x) == 16]
    expected = {}
    for name in queries:
        own = next((x for n, x in there if n == name), None)
        if own is not None:
            far = sorted({(float(np.sqrt(((x - own) ** 2).sum())), n) for n, x in there if n != name})
            expected[name] = [(n, s) for s, n in far[:k]]
    return expected


def test_search(spark, monkeypatch):
    rows = [r for r in vector_rows() if r[0] not in (508, 509, 510)]
    table = vectors(spark, rows)
    monkeypatch.setattr(ann, "CELL", 7)
    monkeypatch.setattr(ann, "QUERIES", 5)
    monkeypatch.setattr(ann, "LEAF", 16)
    found = {}
    result = ann.search(table, table.where("vec_id % 4 = 0"), k=5, recall=0.95)
    for r in result.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    expected = neighbours_by_brute_force(rows, [n for n, _ in rows if n is not None and n % 4 == 0], 5)
    assert set(found) == set(expected)
    hits = 0
    by_name = {n: np.array(x) for n, x in rows if n is not None and usable(x)}
    for name, mine in found.items():
        assert [s for _, s in mine] == sorted(s for _, s in mine)
        for n, s in mine:
            assert s == pytest.approx(float(np.sqrt(((by_name[n] - by_name[name]) ** 2).sum())), abs=1e-12)
        hits += len({n for n, _ in mine} & {n for n, _ in expected[name]})
    assert hits >= 0.9 * sum(map(len, expected.values()))
    everything = ann.search(table, table.where("vec_id % 4 = 0"), k=5, recall=1.1)  # all leaves
    again = {}
    for r in everything.orderBy("query_id", "rank").collect():
        again.setdefault(r["query_id"], []).append(r["vec_id"])
    assert again == {name: [n for n, _ in mine] for name, mine in expected.items()}


def test_search_of_few(spark):
    few = vectors(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0])])
    found = [tuple(r)[:3] for r in ann.search(few, few.where("vec_id = 2")).orderBy("rank").collect()]
    assert found == [(2, 1, 0), (2, 2, 1), (2, 3, 3)]  # all candidates, ties to the smaller id
    assert ann.search(few.limit(0), few).count() == 0
    alone = vectors(spark, [(0, [1.0, 0.0])])
    assert ann.search(alone, alone).count() == 0


def test_tree_orders_every_leaf():
    x = np.random.default_rng(0).normal(size=(3000, 8))
    tree = ann.fit_tree(x, 4, 50)
    leaf = tree.assign(x)
    assert sorted(tree.order(x[0])) == list(range(tree.leaves)) and set(leaf) <= set(range(tree.leaves))
    assert tree.order(x[0], 5) == tree.order(x[0])[:5]


def test_single_precision_travels_as_it_is(spark):
    random = np.random.default_rng(8)
    x = random.normal(size=(60, 8)).astype(np.float32)
    x[30:] = x[:30] * np.float32(1.5) + random.normal(size=(30, 8)).astype(np.float32) * np.float32(0.05)
    exact = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    near = [(k, [v * (1 + 1e-15) for v in row]) for k, row in exact]
    for rows in (exact, near):
        units = np.array([row for _, row in rows])
        units /= np.linalg.norm(units, axis=1)[:, None]
        expected = {k: int((units @ units[k] >= 0.95).sum()) - 1 for k, _ in rows}
        assert {r.vec_id: r.n_links for r in embed_dedup.near_vectors(vectors(spark, rows)).collect()} == expected
