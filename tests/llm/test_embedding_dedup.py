import numpy as np
import pytest

from burnup.llm import embedding_dedup as E


def brute(rows, threshold=0.9):
    ok = [e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(x != 0 for x in e) for _, e in rows]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[x][1], np.float32).astype(float) for x in (i, j))
                link[i, j] = link[j, i] = a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold
    comp = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            m = min([comp[i], *(comp[j] for j in np.flatnonzero(link[i]))])
            if m != comp[i]:
                comp[i], changed = m, True
    return link.sum(1), comp


def data(seed=1, dim=24):
    r = np.random.default_rng(seed)
    base = r.standard_normal((120, dim))
    rows = [v for v in base]
    for v in base[:30]:
        for _ in range(r.integers(1, 9)):
            rows.append(v * r.uniform(0.5, 3) + r.standard_normal(dim) * r.uniform(0, 0.45))
    rows += [base[0]] * 40
    rows = [[float(np.float32(x)) for x in v] for v in rows]
    rows += [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] * dim, [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0]]
    order = r.permutation(len(rows))
    return [(int(i), rows[p]) for i, p in enumerate(order)]


@pytest.mark.parametrize("hot", [16, 4096])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(E.class_links, "__defaults__", (E.THRESHOLD, hot))
    rows = data()
    links, comp = brute(rows)
    df = spark.createDataFrame([(i, e, 3, "x") for i, e in rows], "vec_id long, embedding array<float>, label int, n_links string").repartition(5)
    got = {x.vec_id: x for x in E.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    right = sum(got[i].n_links for i, _ in rows) / links.sum()
    assert right >= 0.99 and all(got[i].n_links <= links[i] for i, _ in rows)  # none below the threshold
    assert np.mean([got[i].component_id == rows[comp[i]][0] for i, _ in rows]) > 0.99
    assert all(got[i].kept == (got[i].component_id == i) for i, _ in rows)


def test_nulls_repeats_empty(spark):
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([(4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [2.0, 0.01]), (None, [0.0, 1.0]), (9, [1e-300, 1e-300]), (8, [1e300, 1e300]), (None, None)], schema)
    got = sorted(((x.vec_id or 0, x.n_links, x.component_id or 0, x.kept) for x in E.near_duplicates(df).collect()))
    assert got == [(0, 0, 0, False), (0, 0, 0, False), (0, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (8, 1, 8, True), (9, 1, 8, False)]
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_number_of_tables():
    for classes in (1, 10_000, 10**9):
        planes, n = E.tables(classes)
        meet = (1 - np.arccos(0.9) / np.pi) ** planes
        assert 1 - (1 - meet) ** n >= E.RECALL
