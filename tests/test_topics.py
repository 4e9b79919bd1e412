import numpy as np
import pytest

from marquee.operators import topics
from marquee.operators.topics import candidate_edges, core_distances, metric_index, topic_groups
from marquee.operators.vectors import member_distances, normalise, rescue_noise


def brute_hdbscan(x, m, k):
    """Textbook HDBSCAN: full matrix, Kruskal tree, top-down condensing, excess of mass."""
    n = len(x)
    d = np.clip(1 - x @ x.T, 0, 2)
    np.fill_diagonal(d, 0)
    core = np.sort(d, axis=1)[:, min(k, n - 1)]
    edges = sorted((max(d[i, j], core[i], core[j]), i, j) for i in range(n) for j in range(i + 1, n))
    up = list(range(n))

    def find(u):
        while up[u] != u:
            u = up[u]
        return u

    tree = []
    for w, i, j in edges:
        a, b = find(i), find(j)
        if a != b:
            up[a] = b
            tree.append((w, i, j))

    def parts(nodes, es):
        adj = {u: [] for u in nodes}
        for _, i, j in es:
            adj[i].append(j)
            adj[j].append(i)
        seen, out = set(), []
        for s in nodes:
            if s in seen:
                continue
            comp, stack = set(), [s]
            while stack:
                u = stack.pop()
                if u not in comp:
                    comp.add(u)
                    stack.extend(adj[u])
            seen |= comp
            out.append(comp)
        return out

    def walk(nodes, es, birth):
        """(stability, chosen sets) of the cluster born with these nodes."""
        cur, own = set(nodes), 0.0
        es = sorted(es)
        while es:
            w = es[-1][0]
            lam = 1 / w
            es = es[:-1]
            ps = parts(cur, es)
            big = [p for p in ps if len(p) >= m]
            if len(big) == 2:
                own += len(cur) * (lam - birth)
                got = [walk(p, [e for e in es if e[1] in p], lam) for p in big]
                below = sum(g[0] for g in got)
                if below > own:
                    return below, [s for g in got for s in g[1]], True
                return own, [set(nodes)], True
            if not big:
                own += len(cur) * (lam - birth)
                return own, [set(nodes)], False
            own += (len(cur) - len(big[0])) * (lam - birth)
            cur = big[0]
            es = [e for e in es if e[1] in cur]
        return own, [set(nodes)], False

    # The root is never chosen: follow it to its first true split.
    cur, es = set(range(n)), sorted(tree)
    while es:
        w = es[-1][0]
        es = es[:-1]
        ps = [p for p in parts(cur, es) if len(p) >= m]
        if len(ps) == 2:
            groups = [s for p in ps for s in walk(p, [e for e in es if e[1] in p], 1 / w)[1]]
            return {frozenset(g) for g in groups}
        if not ps:
            return set()
        cur = ps[0]
        es = [e for e in es if e[1] in cur]
    return set()


def sample(seed, n, dims, centres):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dims))
    x = c[rng.integers(0, centres, n)] + rng.normal(scale=0.35, size=(n, dims)) * rng.uniform(0.4, 2.2, size=(n, 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, parts):
    rows, i, truth = [], 0, {}
    for state, x in parts.items():
        truth[state] = (i, x)
        for v in x:
            rows.append((state, i, [float(t) for t in v]))
            i += 1
    return spark.createDataFrame(rows, "state string, id bigint, embedding array<double>"), truth


def check(got, truth, m, k):
    for state, (at, x) in truth.items():
        mine = {}
        for r in got:
            if r["state"] == state and r["semantic_label"] >= 0:
                mine.setdefault(r["semantic_label"], set()).add(r["id"] - at)
        assert {frozenset(s) for s in mine.values()} == (brute_hdbscan(x, m, k) if len(x) >= m else set())
        firsts = [min(mine[lab]) for lab in sorted(mine)]
        assert firsts == sorted(firsts) and sorted(mine) == list(range(len(mine)))


def test_topic_groups_one_block(spark):
    df, truth = frame(spark, {"a": sample(1, 150, 8, 5), "b": sample(2, 90, 6, 4), "c": sample(3, 4, 6, 1)})
    got = topic_groups(df).collect()
    check(got, truth, 5, 5)
    assert any(r["semantic_label"] >= 0 for r in got)


def test_topic_groups_many_blocks_and_bands(spark):
    df, truth = frame(spark, {"a": sample(4, 120, 8, 5), "b": sample(5, 30, 6, 3)})
    got = topic_groups(df, block_rows=25, band_edges=30).collect()
    check(got, truth, 5, 5)


def test_member_distance_equals_pairwise_mean(spark):
    x = sample(6, 60, 8, 3)
    df, _ = frame(spark, {"a": x})
    got = [r["mean_distance"] for r in member_distances(normalise(df), ["state"]).orderBy("id").collect()]
    assert np.allclose(got, np.clip(1 - x @ x.T, 0, 2).mean(axis=1), atol=1e-12)


def test_rescue_takes_nearest_centroid_within_cap(spark):
    x = sample(7, 80, 8, 3)
    label = [i % 4 - 1 for i in range(80)]
    rows = [("s", i, [float(t) for t in v], lab) for i, (v, lab) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "state string, id bigint, embedding array<double>, semantic_label bigint")
    got = {r["id"]: r["semantic_label"] for r in rescue_noise(df, cap=0.8, block_rows=7).collect()}
    cents = []
    for c in range(3):
        v = x[[i for i in range(80) if label[i] == c]].mean(axis=0)
        cents.append(v / np.linalg.norm(v))
    d = 1 - x @ np.array(cents).T
    for i in range(80):
        want = label[i] if label[i] >= 0 else (int(d[i].argmin()) if d[i].min() <= 0.8 else -1)
        assert got[i] == want


@pytest.mark.parametrize("block_rows", [15, 40])
def test_blocks_that_are_far_apart_never_meet(spark, block_rows):
    """Core distances and tree weights equal the full matrix although most pairs of blocks are skipped."""
    rng = np.random.default_rng(8)
    c = rng.normal(size=(12, 6))
    x = c[rng.integers(0, 12, 600)] + rng.normal(scale=0.02, size=(600, 6))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([("g", i, [float(t) for t in v]) for i, v in enumerate(x)], "grp string, id bigint, vector array<double>")
    index = metric_index(rows, block_rows)
    core = {r["id"]: r["core"] for r in core_distances(index, 5).collect()}
    d = np.clip(1 - x @ x.T, 0, 2)
    np.fill_diagonal(d, 0)
    want = np.sort(d, axis=1)[:, 5]
    assert np.allclose([core[i] for i in range(600)], want, atol=1e-12)
    edges = candidate_edges(index, spark.createDataFrame(list(core.items()), "id bigint, core double")).collect()
    mutual = np.maximum(d, np.maximum(want[:, None], want[None, :]))

    def weights(es):
        up, out = list(range(600)), []
        for w, a, b in sorted(es):
            while up[a] != a:
                a = up[a]
            while up[b] != b:
                b = up[b]
            if a != b:
                up[a] = b
                out.append(w)
        return out

    assert np.allclose(weights([(r["w"], r["a"], r["b"]) for r in edges]), weights([(mutual[i, j], i, j) for i in range(600) for j in range(i)]))
    pairs, first = index.pairs.count(), index.pairs.filter("first").count()
    shares = {k: 1 - (first + met.count()) / pairs for k, met in index.met.items()}
    assert shares["core"] > 0.5, shares


def test_trees_are_thinned_in_parts_of_bounded_size(spark, monkeypatch):
    rng = np.random.default_rng(4)
    edges = [(g, int(a) + at, int(b) + at, float(w)) for g, at in (("x", 0), ("y", 100)) for a, b, w in
             zip(rng.integers(0, 40, 900), rng.integers(40, 80, 900), rng.integers(1, 6, 900))]
    df = spark.createDataFrame(edges, "grp string, a bigint, b bigint, w double")
    want = set()
    for g in ("x", "y"):
        root = {}

        def find(n):
            while root.get(n, n) != n:
                n = root[n]
            return n

        for w, a, b in sorted((w, a, b) for h, a, b, w in edges if h == g):
            if find(a) != find(b):
                root[find(a)] = find(b)
                want.add((g, a, b, w))
    rounds, calls = topics._spanning_rounds, []
    monkeypatch.setattr(topics, "_spanning_rounds", lambda e: calls.append(1) or rounds(e))
    assert {tuple(r) for r in topics.spanning_edges(df, 200).collect()} == want and not calls
    assert {tuple(r) for r in topics.spanning_edges(df, 30).collect()} == want and calls


def test_a_row_travels_to_few_tasks_however_many_blocks_meet(spark, monkeypatch):
    """Rows sent to tasks stay within the tiles of the group; each two tiles' pairs give the exact distances."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([("g", i, v.tolist()) for i, v in enumerate(x)], "grp string, id bigint, vector array<double>")
    monkeypatch.setattr(topics, "TILES", 3)
    index = metric_index(df, 8)
    blocks = index.pairs.filter("lo = hi").count()
    assert blocks > 60 and index.pairs.agg({"tile_hi": "max"}).head()[0] == 2

    def count(rows, pairs):
        return topics.pa.table({"rows": [len(rows)], "pairs": [len(pairs)]})

    sent = index.meet(index.pairs, index.rows, count, "rows bigint, pairs bigint").collect()
    assert len(sent) == 6 and sum(r.rows for r in sent) == 600 * 3 and sum(r.pairs for r in sent) == blocks * (blocks + 1) // 2
    got = {r.id: r.core for r in core_distances(index, 5).collect()}
    d = np.clip(1 - x @ x.T, 0, 2)
    np.fill_diagonal(d, np.inf)
    assert np.allclose([got[i] for i in range(600)], np.sort(d, axis=1)[:, 4], atol=1e-12)
