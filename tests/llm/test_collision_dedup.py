import numpy as np
import pytest

from parcelkit.llm import collision_dedup as cd

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, pos int, c double"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], label, "x", 1, 2.)
                                  for i, v, label in rows], SCHEMA)


def brute(rows, threshold=0.93):
    """Every pair's cosine in double precision, components by spreading the smallest position."""
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(c is not None and np.isfinite(np.float32(c)) for c in v) and any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        unit.append(None if x is None else x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()))
    n = len(rows)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([root[i], *(root[j] for j in near[i])])
            changed |= low != root[i]
            root[i] = low
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def random_rows(seed, n, dims, labels=3):
    """Chains and groups around the threshold, exact copies, other vectors."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.6:
            _, base, label = rows[rng.integers(len(rows))]
            angle = 0 if kind < 0.15 else rng.uniform(0.3, 0.45) if kind < 0.4 else rng.uniform(0, 0.2)
            base = np.array(base)
            other = rng.normal(size=dims)
            other -= base * (other @ base) / (base @ base)
            v = base / np.linalg.norm(base) * np.cos(angle) + other / np.linalg.norm(other) * np.sin(angle)
            v = base if angle == 0 else v * rng.uniform(0.1, 50)
        else:
            v, label = rng.normal(size=dims), int(rng.integers(labels))
        rows.append((i, np.asarray(v, np.float32).tolist(), label))
    return rows


@pytest.mark.parametrize("dims", [3, 24, 64])
def test_links_equal_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(cd, "PART", 32)
    rows = random_rows(dims, 300, dims)
    assert got(cd.near_duplicates(frame(spark, rows).repartition(6))) == brute(rows)


def test_odd_vectors(spark):
    rows = random_rows(8, 60, 8, 1)
    same = rows[0][1]
    rows += [(100, same, None), (101, None, 0), (102, [], 0), (103, [0.] * 8, 0), (104, [None] * 8, 0), (105, [float("nan")] * 8, 0),
             (106, [float("inf")] + [0.] * 7, 0), (107, same[:4], 0), (7, same, 0), (7, same, 0), (None, same, 0), (None, None, None),
             (108, [-0.0] + [1.] * 7, 5), (109, [0.0] + [1.] * 7, 5), (110, [1e38] * 8, 5), (111, [1e-38] * 8, 5)]
    assert got(cd.near_duplicates(frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert got(cd.near_duplicates(frame(spark, []))) == []


def test_a_hot_group_returns_few_rows():
    import pandas as pd
    rng = np.random.default_rng(1)
    base = rng.normal(size=16)
    u = base + rng.normal(size=(600, 16)) * 0.01
    u /= np.linalg.norm(u, axis=1)[:, None]
    pdf = pd.DataFrame({"pos": np.arange(600), "copies": 1, "u": [x.tobytes() for x in u], "side": 0})
    out = cd._meet(pdf, 16, 0.93, *cd.calibrate(0.93))
    assert (out["links"] > 0).sum() == 600 and out["other"].notna().sum() == 599
    assert out["links"].max() == 599


def test_calibration_bounds_the_misses():
    for threshold in (0.8, 0.93, 0.99):
        width, least = cd.calibrate(threshold)
        rng = np.random.default_rng(2)
        gaps = np.abs(rng.standard_normal((20_000, cd.PROJECTIONS))) * np.sqrt(2 - 2 * threshold)
        assert ((gaps <= width).sum(1) < least).sum() == 0
