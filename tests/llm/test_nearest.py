import numpy as np

from tidemill.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, id int, cell int, of int"


def test_recall_and_order(spark):
    sf = "/root/testdata/sf0.01"
    data = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.stack(data["embedding"]).astype(float), data["vec_id"].to_numpy()
    got = queries.op4_nearest(spark, sf).toPandas()
    assert set(got["query_id"]) == set(ids[ids % 20 == 0])
    hits = 0
    for name, group in got.groupby("query_id"):
        group = group.sort_values("rank")
        s = x @ x[ids == name][0]
        s[ids == name] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(group["vec_id"]))
        assert group["rank"].tolist() == list(range(1, 21)) and name not in set(group["vec_id"])
        own = dict(zip(ids, s, strict=True))
        assert np.allclose(group["score"], [own[v] for v in group["vec_id"]], atol=1e-12)
    assert hits / len(got) >= 0.9


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rows = [(i, [1.0, 2.0], 0, 0, 0) for i in range(30)] + [(5, [1.0, 2.0], 0, 0, 0)]
    rows += [(40, None, 0, 0, 0), (41, [0.0, 0.0], 0, 0, 0), (42, [1.0, None], 0, 0, 0), (43, [float("nan"), 1.0], 0, 0, 0)]
    rows += [(44, [float("inf"), 1.0], 0, 0, 0), (45, [1.0], 0, 0, 0), (46, [], 0, 0, 0), (None, [1.0, 2.0], 0, 0, 0), (47, [-1.0, -2.0], 0, 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = ann.search(df, df.filter("vec_id in (0, 7, 40, 41)"), k=20).toPandas().sort_values(["query_id", "rank"])
    assert set(got["query_id"]) == {0, 7}
    assert got[got["query_id"] == 7]["vec_id"].tolist() == [i for i in range(21) if i != 7]
    assert (got["score"] == 5.0).all()


def test_clusters_that_share_cells(spark):
    """All neighbours of a query lie in one bucket of each table."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(400, 8))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = (centres[:, None] + rng.normal(scale=1e-5, size=(400, 11, 8))).reshape(-1, 8)
    rows = [(i, v.tolist(), 0, 0, 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int, cell int, of int")
    got = ann.search(df, df.filter("vec_id % 11 = 0"), k=10, tables=ann.Tables(probes=30)).toPandas()
    assert (got["vec_id"] // 11 == got["query_id"] // 11).groupby(got["query_id"]).sum().eq(10).all()


def test_fewer_rows_than_wanted(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist(), 0, 0, 0) for i in range(6)], SCHEMA)
    got = ann.search(df, df).toPandas()
    assert got.groupby("query_id").size().tolist() == [5] * 6


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ann.search(df, df).count() == 0
    only = spark.createDataFrame([(1, [0.0], 0, 0, 0)], SCHEMA)
    assert ann.search(only, only).count() == 0


def test_probe_order_is_by_score():
    inside = np.array([0.1, 0.6, 0.45])
    got = list(ann.probe_order(inside, 27))
    score = lambda moves: sum((inside[j] if s < 0 else 1 - inside[j]) ** 2 for j, s in moves)
    scores = [score(m) for m in got]
    assert scores == sorted(scores) and got[0] == [] and len({tuple(sorted(m)) for m in got}) == 27
