"""Near-duplicates against all pairs compared outright."""

import re

import numpy as np
import pytest

from tidemill.llm import near_dups
from tidemill.llm.components import contract, extend

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, size, percent=80):
    """doc_id -> (set size, component) by comparing every pair."""
    sets, up = {}, {}
    for name, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
        k = min(size, len(words))
        sets[name] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()
        up[name] = name

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = sets[a], sets[b]
            if 0.75 * len(x) <= len(y) <= 1.4 * len(x) and x and y:
                shared = len(x & y)
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    low, high = sorted((find(a), find(b)))
                    up[high] = low
    return {n: (len(sets[n]), find(n)) for n in names}


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, size):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute(docs.select("doc_id", "text").collect(), size)
    got = near_dups.near_duplicates(docs, size=size).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_chain_in_one_bucket(spark):
    """Neighbours are alike, ends are not, and all share many keys."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for step in range(30):
        words = list(base)
        for i in range(4 * step, 4 * step + 4):
            base[i % 120] = f"x{step}_{i}"
        rows.append((step * 7, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2)
    got = near_dups.near_duplicates(docs, size=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {n: c for n, (_, c) in want.items()}
    assert len({c for _, c in want.values()}) < 30


def test_odd_rows(spark, odd_docs):
    got = near_dups.near_duplicates(odd_docs, size=2).toPandas()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got.dropna(subset=["doc_id"]).itertuples()}
    assert [by_id[i].component_id for i in (1, 2, 9)] == [1, 1, 1]
    assert [by_id[i].n_shingles for i in (3, 4, 6, 7)] == [0, 0, 0, 1]
    assert all(by_id[i].component_id == i and by_id[i].kept for i in (3, 4, 6))
    nameless = got[got["doc_id"].isna()].iloc[0]
    assert nameless["kept"] and nameless["component_id"] != nameless["component_id"]


def test_texts_of_one_id(spark):
    """Each text of an id has links of its own; each finds its group."""
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdefgh"]
    rows = [(1, t) for t in texts] + [(100 + i, t + " end") for i, t in enumerate(texts)]
    # Two texts of id 5 that are alike, one of which is linked with a smaller id.
    rows += [(3, texts[0] + " more"), (5, "p " * 3 + texts[0]), (5, "other words than all of those above")]
    # Alike, and of one id: one is kept.
    rows += [(7, " ".join(f"z{i}" for i in range(60)) + end) for end in ("", " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dups.near_duplicates(docs, size=2, hash_as="h")
    assert got.columns[-1] == "h"
    by = {(r["doc_id"], r["h"]): r for r in got.collect()}
    hashed = {(r["doc_id"], r["text"]): by[r["doc_id"], r["h"]] for r in docs.selectExpr("*", "xxhash64(text) as h").collect()}
    assert all(hashed[100 + i, t + " end"]["component_id"] == 1 for i, t in enumerate(texts))
    assert not any(hashed[100 + i, t + " end"]["kept"] for i, t in enumerate(texts))
    assert all(hashed[1, t]["component_id"] == 1 and hashed[1, t]["kept"] for t in texts)
    assert (hashed[5, rows[-4][1]]["component_id"], hashed[5, rows[-3][1]]["component_id"]) == (1, 5)
    assert sum(r["kept"] for (n, _), r in hashed.items() if n == 7) == 1


def test_no_rows(spark, odd_docs):
    assert near_dups.near_duplicates(odd_docs.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1000, 1200)]
    star = [(5, i) for i in range(6, 300)]
    links = spark.createDataFrame(path + star + [(7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in contract(links).collect()}
    assert {got[i] for i in range(1000, 1201)} == {1000}
    assert {got[i] for i in range(5, 300)} == {5}


def test_links_that_come_later(spark):
    """Components grown by batches of links are those of all links at once."""
    rng = np.random.Generator(np.random.PCG64(9))
    batches = [rng.integers(400, size=(n, 2)).tolist() for n in (150, 60, 1, 40)] + [[(3, 3)], []]
    up = list(range(400))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    components = None
    for batch in batches:
        components = extend(components, spark.createDataFrame(batch, "a long, b long"))
        for a, b in batch:
            low, high = sorted((find(a), find(b)))
            up[high] = low
        got = {r["node"]: r["component"] for r in components.collect()}
        assert all(got.get(i, i) == find(i) for i in range(400))
        assert components.count() == len(got)


def test_shared_counts_against_sets():
    rng = np.random.Generator(np.random.PCG64(5))
    sets = [np.unique(rng.integers(60, size=n).astype(np.uint64)) for n in (1, 3, 40, 80, 7, 20)]
    cuts = np.cumsum([0, *map(len, sets)])
    hub, other = (rng.integers(len(sets), size=50) for _ in range(2))
    got = near_dups.shared_counts(hub, other, np.concatenate(sets), cuts)
    assert got.tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(hub, other, strict=True)]
    assert len(near_dups.shared_counts(hub[:0], other[:0], np.concatenate(sets), cuts)) == 0


def test_cells_of_a_hub_and_of_many_pairs(spark, monkeypatch):
    """One text near hundreds of others, and cells so small that there are many."""
    monkeypatch.setattr(near_dups, "CELL_SHINGLES", 2000)
    base = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(base))]
    rows += [(i, " ".join(base[: i % 100] + [f"x{i}"] + base[i % 100 + 1 :])) for i in range(1, 150)]
    # Near by signature at most, some linked and some not.
    rows += [(1000 + i, " ".join(base[: 75 + i % 12] + [f"y{i}_{j}" for j in range(25 - i % 12)])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs, size=2).collect()}
    assert got == {n: c for n, (_, c) in brute(rows, 2).items()}


def test_changes_tell_what_is_shared():
    rng = np.random.Generator(np.random.PCG64(6))
    lists = [np.unique(rng.integers(50, size=n).astype(np.uint64)) for n in (0, 1, 9, 40, 3)]
    cuts = np.cumsum([0, *map(len, lists)])
    for own in lists:
        for rows in ([0, 1, 2, 3, 4], [3, 0, 3], []):
            got = near_dups.shared_with(own, np.array(rows, np.int64), np.concatenate(lists), cuts)
            assert got.tolist() == [len(np.intersect1d(own, lists[r])) for r in rows]
    assert near_dups.spanning(np.array([1, 2, 1, 5]), np.array([2, 3, 3, 6])).tolist() == [0, 1, 3]


def test_outliers_of_a_group_leave_their_block_as_links_alone(spark, monkeypatch):
    """Texts near a large group by signature, some linked past its pivots, some not."""
    seen = []
    kept = near_dups.stage
    monkeypatch.setattr(near_dups, "stage", lambda df, name: seen.append((name, kept(df, name))) or seen[-1][1])
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(150)]
    # A fifth and more is other text: apart from the group, but near it by signature.
    rows += [(1000 + i, " ".join(base[:i] + [f"y{i}_{j}" for j in range(20)] + base[i + 20 :])) for i in range(130)]
    # Some of these have a double with a small change.
    rows += [(2000 + i, rows[150 + i][1] + f" z{i}") for i in range(0, 130, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs, size=2).collect()}
    assert got == {n: c for n, (_, c) in brute(rows, 2).items()}
    assert len(set(got.values())) > 20
    # Pairs to be confirmed do not grow with the square of the group.
    assert max(df.count() for name, df in seen if name in ("near", "apart", "dealt", "hubs", "links")) < 2 * len(rows)
