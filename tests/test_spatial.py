import math
import random

from marquee.operators.spatial import core_points, place_groups

R = 6_371_000.0


def metres(p, q):
    a, b, c, d = map(math.radians, (p[0], p[1], q[0], q[1]))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * R * math.asin(min(1.0, math.sqrt(h)))


def brute_groups(pts, eps, k):
    """Index-order density expansion."""
    n = len(pts)
    near = [[j for j in range(n) if metres(pts[i], pts[j]) <= eps] for i in range(n)]
    core = [len(x) >= k for x in near]
    label = [-1] * n
    nxt = 0
    for i in range(n):
        if not core[i] or label[i] != -1:
            continue
        stack = [i]
        label[i] = nxt
        while stack:
            u = stack.pop()
            if not core[u]:
                continue
            for v in near[u]:
                if label[v] == -1:
                    label[v] = nxt
                    stack.append(v)
        nxt += 1
    return label


def rows_for(seed, n, lat0, lon0, spread):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        if out and rnd.random() < 0.15:
            out.append(rnd.choice(out))
        else:
            lon = lon0 + rnd.random() * spread
            out.append((lat0 + rnd.random() * spread, (lon + 180) % 360 - 180))
    return out


def test_place_groups_match_brute_force(spark):
    states = {
        "city": rows_for(1, 260, 40.5, -74.0, 0.06),
        "line": rows_for(2, 120, 0.0 - 0.01, 179.98, 0.04),
        "north": rows_for(3, 80, 69.0, 20.0, 0.05),
        "tiny": rows_for(4, 3, 10.0, 10.0, 0.0001),
    }
    rows, want, i = [], {}, 0
    for name, pts in states.items():
        for p, lab in zip(pts, brute_groups(pts, 500.0, 5)):
            rows.append((name, i, p[0], p[1]))
            want[i] = lab
            i += 1
    df = spark.createDataFrame(rows, "state string, id bigint, lat double, lon double")
    got = {r["id"]: r["spatial_label"] for r in place_groups(df, 500.0, 5).collect()}
    assert got == want
    assert len(set(want.values())) > 3


def test_dense_neighbour_cells_connect_without_pairs(spark):
    # Two dense blobs whose nearest points are just under / just over eps apart.
    step = 1 / 111_194.9
    blob = [(40.0 + 0.1 * i * step, -74.0) for i in range(60)]
    for gap, groups in ((499.0, 1), (501.0, 2)):
        top = blob[-1][0]
        other = [(top + (gap + 0.1 * i) * step, -74.0) for i in range(60)]
        pts = blob + other
        df = spark.createDataFrame([("s", i, a, b) for i, (a, b) in enumerate(pts)],
                                   "state string, id bigint, lat double, lon double")
        got = [r["spatial_label"] for r in place_groups(df, 500.0, 5).orderBy("id").collect()]
        assert got == brute_groups(pts, 500.0, 5)
        assert len(set(got)) == groups


def test_core_points(spark):
    pts = rows_for(9, 90, 40.5, 179.97, 0.06)
    df = spark.createDataFrame([("s", i, a, b) for i, (a, b) in enumerate(pts)],
                               "state string, id bigint, lat double, lon double")
    got = {r["id"] for r in core_points(df, 800.0, 4).filter("is_core").collect()}
    want = {i for i in range(90) if sum(metres(pts[i], q) <= 800.0 for q in pts) >= 4}
    assert got == want


def test_few_boxes_decide_dense_cells(spark, monkeypatch):
    """Halves join the cells of a dense sheet to their neighbours, so cells further apart need no boxes of their own."""
    from marquee.operators import spatial

    judged, cut = [], spatial.cut_lineage

    def counted(df):
        out = cut(df)
        if "high" in df.columns:
            judged.append(out.count())
        return out

    monkeypatch.setattr(spatial, "cut_lineage", counted)
    pts = [(40.0 + 0.0005 * i, -74.0 + 0.0005 * j) for i in range(60) for j in range(60)]
    df = spark.createDataFrame([("s", i, a, b) for i, (a, b) in enumerate(pts)], "state string, id bigint, lat double, lon double")
    assert {r["spatial_label"] for r in place_groups(df, 500.0, 5).collect()} == {0}
    assert sum(judged) < 30 * judged[0]
