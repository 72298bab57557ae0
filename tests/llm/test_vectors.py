"""Vector operators against brute force."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402

from strata.llm import mtree, projection  # noqa: E402

KINDS = ["float", "double"]


def vectors(seed=2, n=600, dims=16):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims))
    x[50:60] = x[0] + 0.02 * rng.standard_normal((10, dims))
    x[60:140] = x[1] + 0.15 * rng.standard_normal((80, dims))  # a crowd in which many but not all are linked
    x[140:150] = x[2]
    rows = [(i, [float(np.float32(v)) for v in r], i % 3) for i, r in enumerate(x)]
    rows += [(700, None, 0), (701, [0.0] * dims, 0), (702, [float("nan")] * dims, 1), (703, [1.0, None] + [0.0] * (dims - 2), 1), (704, [float("inf")] + [1.0] * (dims - 1), 1),
             (705, [], 0), (706, [1.0, 2.0], 0), (707, [2.0, 4.0], 0)]
    return rows


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


@pytest.mark.parametrize("kind", KINDS)
def test_near_vectors(spark, kind):
    rows = vectors()
    got = {r["vec_id"]: r for r in projection.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")).collect()}
    links = {i: set() for i, *_ in rows}
    good = [(i, np.array(v, np.float64)) for i, v, _ in rows if usable(v) and any(v)]
    for a, (i, x) in enumerate(good):
        for j, y in good[a + 1:]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                links[i].add(j)
                links[j].add(i)
    want = cases.components([i for i, *_ in rows], [(i, j) for i, s in links.items() for j in s])
    assert len(got) == len(rows)
    for i, s in links.items():
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(s), want[i], want[i] == i)


def test_windows_run_on_across_partitions(spark, monkeypatch):
    monkeypatch.setattr(projection, "ROWS", 300)
    test_near_vectors(spark, "float")


@pytest.mark.parametrize("hubs", [0, 256])
def test_star_wider_than_the_window(spark, monkeypatch, hubs):
    monkeypatch.setattr(projection, "HUBS", hubs)
    monkeypatch.setattr(projection, "RUN_BLOCK", 200)
    monkeypatch.setattr(projection, "WINDOW", 4)
    monkeypatch.setattr(projection.passes, "__defaults__", (4, projection.MISS))
    monkeypatch.setattr(projection.prefix_bits, "__defaults__", (4,))
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(64)
    side = rng.standard_normal((1500, 64))
    side -= np.outer(side @ centre / (centre @ centre), centre)  # copies at 0.91 to the centre, 0.83 to one another
    copies = 0.91 * centre / np.linalg.norm(centre) + np.sqrt(1 - 0.91**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    x = np.vstack([centre, copies, rng.standard_normal((1500, 64))])
    got = {r["vec_id"]: r for r in projection.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    held = sum(got[i]["component_id"] == 0 for i in range(1501))
    assert held >= (1501 if hubs else 1485) and got[0]["n_links"] == held - 1


@pytest.mark.parametrize("kind", KINDS)
def test_top_products(spark, kind, monkeypatch):
    monkeypatch.setattr(mtree, "SUBTREE", 64)
    monkeypatch.setattr(mtree, "PAGE", 8)
    rows = vectors(4)
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    got = mtree.top_products(table, table.where("vec_id % 10 = 0"), k=10).collect()
    ints = {i: np.floor(1024 * np.array(v, np.float64)).astype(np.int64) for i, v, _ in rows if usable(v)}
    want = set()
    for q in ints:
        if q % 10 == 0:
            best = sorted((-int(ints[q] @ x), i) for i, x in ints.items() if i != q and len(x) == len(ints[q]))[:10]
            want |= {(q, k, i, -s) for k, (s, i) in enumerate(best, 1)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want and len(got) == len(want)


def test_pruning_skips_pages():
    rng = np.random.default_rng(1)
    centres = rng.integers(-1000, 1000, (16, 8))
    x = np.repeat(centres, 64, axis=0) + rng.integers(-5, 6, (1024, 8))
    import pandas as pd
    top = float((x * x).sum(axis=1).max()) + 1
    pages = mtree._build(top)(pd.DataFrame({"tree": 1, "dims": 8, "vec_id": range(1024), "vec": [v.tobytes() for v in x.astype(np.int64)]}))
    tree = mtree._Tree(pages)
    seen = []
    tree.entries = [type("E", (), {"__getitem__": lambda s, k, p=p, e=e: (seen.append(p), e[k])[1]})() for p, e in enumerate(tree.entries)]
    got = sorted(tree.search(x[5].astype(np.int64), 5, 3, -np.inf, top), reverse=True)
    want = sorted(((int(x[5] @ v), -i) for i, v in enumerate(x) if i != 5), reverse=True)[:3]
    assert got == want and len(set(seen)) < len(pages)


@pytest.mark.parametrize("operator", [lambda t: projection.near_vectors(t), lambda t: mtree.top_products(t, t)])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_null_ids(spark):
    rows = [(None, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["kept"]) for r in projection.near_vectors(table).collect())
    assert got == [(0, 0, True), (1, 1, True), (2, 1, False)]
    assert mtree.top_products(table, table).count() == 2
