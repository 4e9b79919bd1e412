"""Topic groups: hierarchical density clustering (HDBSCAN) on cosine distance.

Published algorithm: Campello, Moulavi, Sander 2013; McInnes, Healy 2017.  Exact:
vectors meet as pairs of bounded blocks.  Blocks hold the rows nearest to one pivot, so by
the triangle inequality on chords two blocks are no nearer than their pivots less
their radii.  Blocks first meet themselves and the nearest others, which bounds each row's k
smallest distances and the heaviest edge of the group's spanning tree; pairs of blocks beyond
these bounds never meet.  Pairs are dealt to tasks by tiles, runs of blocks of which a group has a fixed number, so a row
travels to as many tasks however many pairs its block is in.  The pairs' own spanning trees together hold the tree of the
whole group, which is found from them and turned into groups by merging its edges from light to heavy.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.components import connected_components, stars
from marquee.operators.ranking import number_rows, top_per_group
from marquee.operators.vectors import BLOCK_ROWS, cosine_distance, distance_matrix, stack
from marquee.session import cut_lineage, stage

# Tree edges one task may hold; a group with more is merged in weight bands.
BAND_EDGES = 1_000_000
# Density of points at distance zero.
MAX_LAMBDA = 1e12


# Tiles of a group, and the rows that a tile has on average at most (larger groups have more tiles).
TILES, TILE_ROWS = 16, 65_536
# Distances that a task holds at once.
MATRIX_CELLS = 1 << 20
# Other blocks that a block meets first, and the slack of distances computed in different orders.
FIRST_NEAR, SLACK = 2, 1e-6


@dataclass
class MetricIndex:
    """Rows of groups in blocks around pivots; all staged.

    rows: ``grp, id, vector, block``; pairs: ``grp, lo, hi, bound`` (least chord between rows of the two
    blocks), ``first`` (whether the blocks meet first), ``tile_lo, tile_hi``; pivots: ``grp, block, centre_id``.
    """

    rows: DataFrame
    pairs: DataFrame
    pivots: DataFrame
    met: dict[str, DataFrame] = field(default_factory=dict)

    def meet(self, pairs: DataFrame, rows: DataFrame, kernel, schema: str) -> DataFrame:
        """What ``kernel`` makes of each two tiles' rows, sent once each, and the pairs of blocks that meet there."""
        tiles = ["grp", "tile_lo", "tile_hi"]
        # Both sides stem from the pairs; Spark tells their columns apart by new names.
        ends = pairs.select(*[F.col(c).alias(c) for c in tiles], F.explode(F.array("lo", "hi")).alias("block")).distinct()
        dealt = rows.join(ends, ["grp", "block"]).select(*[F.col(c).alias(c) for c in [*tiles, *rows.columns] if c != "grp"], F.col("grp").alias("grp"))
        return dealt.groupBy(*tiles).cogroup(pairs.select(*tiles, "lo", "hi").groupBy(*tiles)).applyInArrow(kernel, schema)


def _pivot_kernel(table: pa.Table) -> pa.Table:
    """Nearest pivot of each row, the smaller id on ties, and the chord to it."""
    is_pivot = table.column("is_pivot").to_numpy(zero_copy_only=False)
    rows, pivots = table.filter(pa.array(~is_pivot)), table.filter(pa.array(is_pivot))
    names = pivots.column("id").to_numpy()
    order = np.argsort(names, kind="stable")
    x, p = stack(rows.column("vector")), stack(pivots.column("vector"))[order]
    best, away = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
    step = max(1, MATRIX_CELLS // len(p))
    for at in range(0, len(x), step):
        d = distance_matrix(x[at:at + step], p)
        best[at:at + step], away[at:at + step] = d.argmin(axis=1), np.sqrt(2 * d.min(axis=1))
    return pa.table({"id": rows.column("id"), "pivot": pa.array(names[order][best], pa.int64()), "away": pa.array(away, pa.float64())})


def metric_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> MetricIndex:
    """Deal ``grp, id, vector`` to blocks of about ``block_rows`` rows around pivots drawn by hash."""
    rows = stage(rows.select("grp", "id", "vector"))
    drawn = F.pmod(F.xxhash64("id"), F.lit(block_rows).cast("bigint")) == 0
    firsts = rows.groupBy("grp").agg(F.min("id").alias("first"))
    pivots = stage(rows.join(firsts, "grp").filter(drawn | (F.col("id") == F.col("first"))).select("grp", "id", "vector"))
    # Pivots go to as many tasks as a group has tiles, which does not rise with its rows until tiles are full.
    many = stage(rows.groupBy("grp").agg(F.greatest(F.lit(TILES), F.ceil(F.count(F.lit(1)) / TILE_ROWS)).cast("int").alias("tiles")))
    dealt = rows.join(many, "grp").withColumn("block", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    tasks = many.select("grp", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("block"))
    both = dealt.select("grp", "block", "id", "vector", F.lit(False).alias("is_pivot")).unionByName(
        pivots.join(tasks, "grp").select("grp", "block", "id", "vector", F.lit(True).alias("is_pivot")))
    near = stage(both.groupBy("grp", "block").applyInArrow(_pivot_kernel, "id bigint, pivot bigint, away double"))
    # A pivot with many rows, equal ones perhaps, has several blocks.
    sizes = near.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    placed = rows.join(near, "id").join(sizes, "pivot").withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int"))
    placed = stage(placed.drop("parts"))
    found = placed.groupBy("grp", "pivot", "part").agg(F.max("away").alias("radius"))
    info = stage(number_rows(found, [F.col("pivot"), F.col("part")], "block", group="grp").withColumn("block", F.col("block").cast("int")))
    indexed = stage(placed.join(info.select("pivot", "part", "block"), ["pivot", "part"]).select("grp", "id", "vector", "block"))
    known = info.join(pivots.select(F.col("id").alias("pivot"), F.col("vector").alias("centre")), "pivot")
    a = known.select("grp", F.col("block").alias("lo"), F.col("centre").alias("ca"), F.col("radius").alias("ra"))
    b = known.select("grp", F.col("block").alias("hi"), F.col("centre").alias("cb"), F.col("radius").alias("rb"))
    apart = F.sqrt(2 * cosine_distance(F.col("ca"), F.col("cb"))) - F.col("ra") - F.col("rb") - SLACK
    pairs = stage(a.join(b, "grp").filter("lo <= hi").select(
        "grp", "lo", "hi", F.when(F.col("lo") == F.col("hi"), 0.0).otherwise(F.greatest(apart, F.lit(0.0))).alias("bound")))
    ends = pairs.filter("lo < hi").select("grp", "lo", "hi", "bound", F.explode(F.array("lo", "hi")).alias("block"))
    nearest = top_per_group(ends, ["grp", "block"], [F.col("bound"), F.col("lo"), F.col("hi")], FIRST_NEAR).select(
        "grp", "lo", "hi", F.lit(True).alias("near")).distinct()
    many = many.join(info.groupBy("grp").agg(F.count(F.lit(1)).alias("blocks")), "grp")
    pairs = stage(pairs.join(nearest, ["grp", "lo", "hi"], "left").join(many, "grp").select(
        "grp", "lo", "hi", "bound", (F.col("near").isNotNull() | (F.col("lo") == F.col("hi"))).alias("first"),
        *[F.floor(F.col(end) * F.col("tiles") / F.col("blocks")).cast("int").alias(f"tile_{end}") for end in ("lo", "hi")]))
    return MetricIndex(indexed, pairs, info.groupBy("grp", "block").agg(F.min("pivot").alias("centre_id")))


def _by_block(rows: pa.Table) -> tuple[pa.Table, dict[int, slice]]:
    """The rows in order of their blocks, and where each block lies."""
    rows = rows.sort_by([("block", "ascending"), ("id", "ascending")])
    names, at, n = np.unique(rows.column("block").to_numpy(), return_index=True, return_counts=True)
    return rows, {b: slice(i, i + c) for b, i, c in zip(names.tolist(), at.tolist(), n.tolist())}


def _knn_kernel(k: int):
    """``(id, d)``: each row's ``k`` least distances among the pairs that are below its ``limit``."""

    def kernel(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        rows, spans = _by_block(rows)
        x, limit = stack(rows.column("vector")), rows.column("limit").to_numpy()
        # Sorted; a distance that is not below the last one changes nothing.
        best = np.repeat(limit[:, None], k, axis=1)

        def offer(mine: slice, d: np.ndarray) -> None:
            closer = np.flatnonzero(d.min(axis=1) < best[mine, -1])
            if len(closer):
                some, take = d[closer], min(k, d.shape[1])
                near = np.partition(some, take - 1, axis=1)[:, :take]
                best[mine.start + closer] = np.sort(np.concatenate((best[mine][closer], near), axis=1), axis=1)[:, :k]

        partners: dict[int, list[int]] = {}
        for lo, hi in zip(pairs.column("lo").to_pylist(), pairs.column("hi").to_pylist()):
            partners.setdefault(lo, []).append(hi)
        for lo, others in partners.items():
            mine = spans.get(lo)
            theirs = [spans[b] for b in others if b in spans and b != lo]
            if mine is None:
                continue
            if lo in others:
                d = distance_matrix(x[mine], x[mine])
                np.fill_diagonal(d, np.inf)
                offer(mine, d)
            while theirs:
                some, cells = [], 0
                while theirs and (not some or cells + (theirs[-1].stop - theirs[-1].start) * (mine.stop - mine.start) <= MATRIX_CELLS):
                    some.append(theirs.pop())
                    cells += (some[-1].stop - some[-1].start) * (mine.stop - mine.start)
                d = distance_matrix(x[mine], np.concatenate([x[s] for s in some]))
                offer(mine, d)
                at = 0
                for s in some:
                    offer(s, d[:, at:at + s.stop - s.start].T)
                    at += s.stop - s.start
        found = (best < limit[:, None]) & np.isfinite(best)
        ids = np.repeat(rows.column("id").to_numpy(), k).reshape(best.shape)
        return pa.table({"id": pa.array(ids[found], pa.int64()), "d": pa.array(best[found], pa.float64())})

    return kernel


def core_distances(index: MetricIndex, min_samples: int) -> DataFrame:
    """``(id, core)``: distance to the ``min_samples``-th nearest other row of the group; staged.

    A group with too few rows uses its furthest row.
    """
    def nearest(pairs: DataFrame, rows: DataFrame) -> DataFrame:
        # Each two tiles offer the k smallest of a row; the overall k smallest are kept map-side first.
        near = index.meet(pairs, rows, _knn_kernel(min_samples), "id bigint, d double")
        return top_per_group(near, ["id"], [F.col("d")], min_samples)

    first = stage(nearest(index.pairs.filter("first"), index.rows.withColumn("limit", F.lit(float("inf")))))
    # What a row has found so far bounds how far its k nearest are, and the largest of a block how far its rows look.
    seen = first.groupBy("id").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("n"))
    limited = stage(index.rows.join(seen, "id", "left").withColumn(
        "limit", F.when(F.col("n") == min_samples, F.col("d")).otherwise(F.lit(float("inf")))).drop("d", "n"))
    reach = limited.groupBy("grp", "block").agg(F.max(F.sqrt(2 * F.least("limit", F.lit(2.0)))).alias("reach"))
    looks = index.pairs.filter(~F.col("first"))
    for end in ("lo", "hi"):
        looks = looks.join(reach.select("grp", F.col("block").alias(end), F.col("reach").alias(f"reach_{end}")), ["grp", end])
    looks = stage(looks.filter(F.col("bound") <= F.greatest("reach_lo", "reach_hi")).select("grp", "lo", "hi", "tile_lo", "tile_hi"))
    index.met["core"] = looks
    best = top_per_group(first.unionByName(nearest(looks, limited)), ["id"], [F.col("d")], min_samples)
    return stage(best.groupBy("id").agg(F.max("d").alias("core")))


def prim_edges(ids: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spanning tree of a dense graph under the total order (weight, smaller id, larger id)."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    best = np.full(n, np.inf)
    tie = np.full(n, np.iinfo(np.int64).max)
    source = np.zeros(n, dtype=np.int64)
    open_ = np.ones(n, dtype=bool)
    a, b, w = [], [], []
    u = 0
    open_[0] = False
    for _ in range(n - 1):
        d = weights[u]
        key = np.minimum(rank, rank[u]) * n + np.maximum(rank, rank[u])
        better = open_ & ((d < best) | ((d == best) & (key < tie)))
        best[better], tie[better], source[better] = d[better], key[better], u
        low = np.where(open_, best, np.inf).min()
        ties = np.flatnonzero(open_ & (best == low))
        v = ties[tie[ties].argmin()]
        s = source[v]
        a.append(min(ids[s], ids[v]))
        b.append(max(ids[s], ids[v]))
        w.append(low)
        open_[v] = False
        u = v
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), np.array(w)


def _tree_kernel(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """The edges that two tiles' pairs of blocks have in their spanning trees, thinned together."""
    rows, spans = _by_block(rows)
    ids, core, x = rows.column("id").to_numpy(), rows.column("core").to_numpy(), stack(rows.column("vector"))
    found = [(np.array([], dtype=np.int64),) * 2 + (np.array([]),)]
    for lo, hi in zip(pairs.column("lo").to_pylist(), pairs.column("hi").to_pylist()):
        at = np.concatenate([np.arange(len(ids))[spans[b]] for b in dict.fromkeys((lo, hi)) if b in spans] or [found[0][0]])
        if len(at) > 1:
            d = np.maximum(distance_matrix(x[at], x[at]), np.maximum(core[at][:, None], core[at][None, :]))
            found.append(prim_edges(ids[at], d))
    a, b, w = (np.concatenate(c) for c in zip(*found))
    grp = pairs.column("grp").slice(0, 1).to_pylist() * len(a)
    out = pa.table({"grp": pa.array(grp, pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "w": pa.array(w, pa.float64())})
    return _thin_kernel(out) if len(a) else out


def candidate_edges(index: MetricIndex, core: DataFrame, band_edges: int = BAND_EDGES) -> DataFrame:
    """Edges ``(grp, a, b, w)`` under mutual reachability that hold each group's spanning tree; staged.

    The tree's heaviest edge is no heavier than that of any other connected graph: of the first pairs' trees, say,
    and the edges from one block's pivot to all others.  Pairs of blocks that are further apart than that do not meet.
    """
    rows = stage(index.rows.join(core, "id"))

    def trees(pairs: DataFrame) -> DataFrame:
        return index.meet(pairs, rows, _tree_kernel, "grp string, a bigint, b bigint, w double")

    first = stage(trees(index.pairs.filter("first")).distinct())
    open_ = index.pairs.filter(~F.col("first"))
    if not open_.head(1):
        return first
    centres = index.pivots.join(rows.select(F.col("id").alias("centre_id"), "vector", "core"), "centre_id")
    hub = centres.filter("block = 0").select("grp", F.col("centre_id").alias("hub"), F.col("vector").alias("hub_vector"), F.col("core").alias("hub_core"))
    star = centres.join(hub, "grp").filter("centre_id <> hub").select(
        "grp", F.least("hub", "centre_id").alias("a"), F.greatest("hub", "centre_id").alias("b"),
        F.greatest(cosine_distance(F.col("vector"), F.col("hub_vector")), "core", "hub_core").alias("w")).distinct()
    heaviest = spanning_edges(first.unionByName(star), band_edges).groupBy("grp").agg(F.max("w").alias("heaviest"))
    least = rows.groupBy("grp", "block").agg(F.min("core").alias("least"))
    for end in ("lo", "hi"):
        open_ = open_.join(least.select("grp", F.col("block").alias(end), F.col("least").alias(f"least_{end}")), ["grp", end])
    weight = F.greatest(F.col("bound") * F.col("bound") / 2, "least_lo", "least_hi")
    more = stage(open_.join(heaviest, "grp").filter(weight <= F.col("heaviest") + SLACK).select("grp", "lo", "hi", "tile_lo", "tile_hi"))
    index.met["tree"] = more
    return stage(first.unionByName(trees(more)).distinct())


def _thin_kernel(table: pa.Table) -> pa.Table:
    """The edges of a part that are in its own spanning forest under the order (w, a, b), by Boruvka rounds."""
    a, b, w = (table.column(c).to_numpy() for c in ("a", "b", "w"))
    order = np.lexsort((b, a, w))
    x, y = np.unique(np.concatenate((a[order], b[order])), return_inverse=True)[1].reshape(2, -1)
    at, label = np.arange(len(order)), np.arange(max(x.max(), y.max()) + 1)
    kept = []
    while True:
        cx, cy = label[x], label[y]
        open_ = cx != cy
        if not open_.any():
            break
        x, y, at, cx, cy = x[open_], y[open_], at[open_], cx[open_], cy[open_]
        # Rows stand in order, so the first one of a component is its lightest.
        least = np.full(len(label), len(at))
        np.minimum.at(least, cx, np.arange(len(at)))
        np.minimum.at(least, cy, np.arange(len(at)))
        picked = np.unique(least[least < len(at)])
        kept.append(at[picked])
        node, root = stars(cx[picked], cy[picked])
        to = np.arange(len(label))
        to[node] = root
        label = to[label]
    return table.select(["grp", "a", "b", "w"]).take(pa.array(order[np.concatenate(kept)] if kept else order[:0]))


def spanning_edges(edges: DataFrame, band: int = BAND_EDGES) -> DataFrame:
    """Spanning forest of ``(grp, a, b, w)`` under the order (w, a, b); staged.

    An edge that is not in the forest of some of the edges is not in that of all, so parts of about ``band`` edges are thinned in
    tasks of their own until a group is one part.  Groups that thinning no longer halves, those with more than about
    half a band of nodes, go on in rounds over the edges.
    """
    schema = "grp string, a bigint, b bigint, w double"
    rest, tree = edges.select("grp", "a", "b", "w"), None
    before = None
    while True:
        rest = stage(rest)
        sizes = rest.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
        if before is not None:
            sizes = sizes.join(before.select("grp", F.col("n").alias("was")), "grp").select(
                "grp", "n", (F.col("n") > band) & (F.col("n") * 2 > F.col("was")))
        else:
            sizes = sizes.select("grp", "n", F.lit(False))
        before = stage(sizes.toDF("grp", "n", "stuck"))
        if before.filter("stuck").head(1):
            stuck = _spanning_rounds(rest.join(before.filter("stuck"), "grp", "left_semi"))
            tree = stuck if tree is None else tree.union(stuck)
            rest, before = rest.join(before.filter("stuck"), "grp", "left_anti"), before.filter("not stuck")
        parts = rest.join(before.select("grp", F.ceil(F.col("n") / band).alias("parts")), "grp").withColumn(
            "part", F.pmod(F.xxhash64("a", "b"), F.col("parts")))
        last = not before.filter(F.col("n") > band).head(1)
        rest = parts.select("grp", "part", "a", "b", "w").groupBy("grp", "part").applyInArrow(_thin_kernel, schema)
        if last:
            return stage(rest if tree is None else tree.select("grp", "a", "b", "w").union(rest))


def _spanning_rounds(edges: DataFrame) -> DataFrame:
    """The same by Boruvka rounds as joins, for any number of nodes."""
    rest = cut_lineage(edges.select("grp", "a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb")))
    tree = None
    while rest.limit(1).count():
        edge = F.struct("w", "a", "b", "ca", "cb", "grp")
        ends = rest.select(F.explode(F.array(F.col("ca"), F.col("cb"))).alias("node"), edge.alias("e"))
        picked = cut_lineage(ends.groupBy("node").agg(F.min("e").alias("e")).select("e.*").distinct())
        tree = picked if tree is None else tree.union(picked)
        nodes = picked.select(F.explode(F.array("ca", "cb")).alias("node")).distinct()
        comp = cut_lineage(connected_components(
            nodes, picked.select(F.col("ca").alias("src"), F.col("cb").alias("dst"))))
        for end in ("ca", "cb"):
            rest = (rest.join(comp.withColumnRenamed("node", end), end)
                    .drop(end).withColumnRenamed("component", end))
        rest = cut_lineage(rest.filter("ca <> cb").select("grp", "a", "b", "w", "ca", "cb"))
    return tree.select("grp", "a", "b", "w")


class _Forest:
    """Light-to-heavy merging of tree edges with the running state of every component.

    A component below the minimum size only lists its nodes.  From there on it carries
    one cluster: ``raw`` sums density over the rows that left it, ``kids`` the best
    stability of the clusters below it.
    """

    def __init__(self, min_size: int):
        self.m = min_size
        self.up: dict[int, int] = {}
        self.size: dict[int, int] = {}
        self.cluster: dict[int, int] = {}
        self.raw: dict[int, float] = {}
        self.kids: dict[int, float] = {}
        self.loose: dict[int, list[int]] = {}
        self.joined: list[tuple[int, int]] = []
        self.closed: list[tuple[int, int, bool]] = []
        self.name: dict[int, int] = {}

    def add(self, node: int, size: int = 1, cluster: int = -1, raw: float = 0.0, kids: float = 0.0) -> None:
        if node in self.up:
            return
        self.up[node] = node
        self.size[node] = size
        self.name[node] = node
        if cluster >= 0:
            self.cluster[node], self.raw[node], self.kids[node] = cluster, raw, kids
        else:
            self.loose[node] = [node]

    def find(self, node: int) -> int:
        root = node
        while self.up[root] != root:
            root = self.up[root]
        while self.up[node] != root:
            self.up[node], node = root, self.up[node]
        return root

    def _close(self, node: int, parent: int, lam: float) -> float:
        own = self.raw[node] - self.size[node] * lam
        chosen = not self.kids[node] > own
        self.closed.append((self.cluster[node], parent, chosen))
        return own if chosen else self.kids[node]

    def merge(self, a: int, b: int, w: float, fresh: int) -> bool:
        """Join two components; ``fresh`` names the cluster this edge may start."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        lam = 1.0 / w if w > 1.0 / MAX_LAMBDA else MAX_LAMBDA
        if self.size[a] < self.size[b] or (a not in self.cluster and b in self.cluster):
            a, b = b, a
        total = self.size[a] + self.size[b]
        big_a, big_b = a in self.cluster, b in self.cluster
        if big_a and big_b:
            kids = self._close(a, fresh, lam) + self._close(b, fresh, lam)
            self.cluster[a], self.raw[a], self.kids[a] = fresh, total * lam, kids
            del self.cluster[b], self.raw[b], self.kids[b]
        elif big_a:
            self.raw[a] += self.size[b] * lam
            self.joined.extend((n, self.cluster[a]) for n in self.loose.pop(b))
        else:
            nodes = self.loose.pop(a) + self.loose.pop(b)
            if total >= self.m:
                self.cluster[a], self.raw[a], self.kids[a] = fresh, total * lam, 0.0
                self.joined.extend((n, fresh) for n in nodes)
            else:
                self.loose[a] = nodes
        self.up[b] = a
        self.size[a] = total
        self.name[a] = min(self.name[a], self.name[b])
        return True


def _tail_kernel(min_size: int):
    """Whole group in one task: rows ``(id, cluster)`` with -1 for noise."""

    def kernel(table: pa.Table) -> pa.Table:
        a, b, w = (table.column(c).to_numpy() for c in ("a", "b", "w"))
        forest = _Forest(min_size)
        for i in np.lexsort((b, a, w)):
            forest.add(int(a[i]))
            forest.add(int(b[i]))
            forest.merge(int(a[i]), int(b[i]), float(w[i]), len(forest.closed) + len(forest.joined) + 1)
        parent = {c: (p, chosen) for c, p, chosen in forest.closed}
        top: dict[int, int] = {}
        # Parents are named after their children, so walk from the newest down.
        for c in sorted(parent, reverse=True):
            p, chosen = parent[c]
            top[c] = top.get(p, -1) if top.get(p, -1) >= 0 else (c if chosen else -1)
        ids = [n for n, _ in forest.joined] + [n for nodes in forest.loose.values() for n in nodes]
        label = [top.get(c, -1) for _, c in forest.joined] + [-1] * (len(ids) - len(forest.joined))
        return pa.table({"id": pa.array(ids, pa.int64()), "cluster": pa.array(label, pa.int64())})

    return kernel



def _band_kernel(min_size: int):
    """One weight band of one group: edges and the state of the nodes they touch.

    Returns tagged rows: ``n`` new node states, ``m`` node -> new node, ``j`` node
    joined a cluster, ``c`` closed cluster with its parent and choice.
    """

    def kernel(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy(zero_copy_only=False)
        nodes = table.filter(pa.array(kind == "n")).to_pylist()
        edges = table.filter(pa.array(kind == "e"))
        forest = _Forest(min_size)
        for r in nodes:
            forest.add(r["x"], r["y"], r["z"], r["p"], r["q"])
        a, b, w, at = (edges.column(c).to_numpy() for c in ("x", "y", "p", "z"))
        for i in np.argsort(at, kind="stable"):
            forest.merge(int(a[i]), int(b[i]), float(w[i]), int(at[i]))
        out = []
        for n in list(forest.up):
            root = forest.find(n)
            if root == n:
                out.append(("n", forest.name[n], forest.size[n], forest.cluster.get(n, -1), forest.raw.get(n, 0.0),
                            forest.kids.get(n, 0.0)))
            out.append(("m", n, forest.name[root], 0, 0.0, 0.0))
        out += [("j", n, c, 0, 0.0, 0.0) for n, c in forest.joined]
        out += [("c", c, p, int(chosen), 0.0, 0.0) for c, p, chosen in forest.closed]
        grp = table.column("grp")[0].as_py()
        cols = list(zip(*out))
        return pa.table({"grp": pa.array([grp] * len(out), pa.string()),
                         "kind": pa.array(cols[0], pa.string()),
                         "x": pa.array(cols[1], pa.int64()), "y": pa.array(cols[2], pa.int64()),
                         "z": pa.array(cols[3], pa.int64()), "p": pa.array(cols[4], pa.float64()),
                         "q": pa.array(cols[5], pa.float64())})

    return kernel


_TAGGED = "grp string, kind string, x bigint, y bigint, z bigint, p double, q double"


def _merge_in_bands(tree: DataFrame, ids: DataFrame, min_size: int, band: int) -> DataFrame:
    """Exact grouping of trees too large for one task, ``band`` edges per group and step."""
    numbered = number_rows(tree, [F.col("w"), F.col("a"), F.col("b")], "at", group="grp")
    rest = cut_lineage(numbered.withColumns({"na": F.col("a"), "nb": F.col("b")})
                       .withColumn("band", F.floor(F.col("at") / band)))
    nodes = cut_lineage(ids.select("grp", F.col("id").alias("node"), F.lit(1).cast("bigint").alias("size"),
                                   F.lit(-1).cast("bigint").alias("cluster"), F.lit(0.0).alias("raw"),
                                   F.lit(0.0).alias("kids")))
    # A point waits in the node that carries it until that node joins a cluster.
    waiting = cut_lineage(ids.select("grp", "id", F.col("id").alias("node")))
    settled, closed = None, None
    step = 0
    while rest.limit(1).count():
        now = rest.filter(F.col("band") == step)
        touched = now.select("grp", F.explode(F.array("na", "nb")).alias("node")).distinct()
        work = now.select("grp", F.lit("e").alias("kind"), F.col("na").alias("x"), F.col("nb").alias("y"),
                          F.col("at").alias("z"), F.col("w").alias("p"), F.lit(0.0).alias("q")).unionByName(
            nodes.join(touched, ["grp", "node"], "left_semi").select(
                "grp", F.lit("n").alias("kind"), F.col("node").alias("x"), F.col("size").alias("y"),
                F.col("cluster").alias("z"), F.col("raw").alias("p"), F.col("kids").alias("q")))
        got = cut_lineage(work.groupBy("grp").applyInArrow(_band_kernel(min_size), _TAGGED))
        moved = got.filter("kind = 'm'").select("grp", F.col("x").alias("node"), F.col("y").alias("to"))
        joined = got.filter("kind = 'j'").select("grp", F.col("x").alias("node"), F.col("y").alias("cluster"))
        ended = got.filter("kind = 'c'").select("grp", F.col("x").alias("cluster"), F.col("y").alias("parent"),
                                                (F.col("z") == 1).alias("chosen"))
        new_nodes = got.filter("kind = 'n'").select("grp", F.col("x").alias("node"), F.col("y").alias("size"),
                                                    F.col("z").alias("cluster"), F.col("p").alias("raw"),
                                                    F.col("q").alias("kids"))
        nodes = cut_lineage(nodes.join(touched, ["grp", "node"], "left_anti").unionByName(new_nodes))
        done = cut_lineage(waiting.join(joined, ["grp", "node"]).select("grp", "id", "cluster"))
        settled = done if settled is None else settled.union(done)
        waiting = cut_lineage(waiting.join(joined, ["grp", "node"], "left_anti").join(moved, ["grp", "node"], "left")
                              .select("grp", "id", F.coalesce("to", "node").alias("node")))
        closed = ended if closed is None else closed.union(ended)
        rest = rest.filter(F.col("band") > step)
        for end in ("na", "nb"):
            rest = (rest.join(moved.withColumnRenamed("node", end), ["grp", end], "left")
                    .withColumn(end, F.coalesce("to", end)).drop("to"))
        rest = cut_lineage(rest)
        step += 1
    tops = _topmost_chosen(closed)
    return (settled.join(tops, ["grp", "cluster"], "left")
            .select("grp", "id", F.coalesce("top", F.lit(-1).cast("bigint")).alias("cluster"))
            .union(waiting.select("grp", "id", F.lit(-1).cast("bigint"))))


def _topmost_chosen(closed: DataFrame) -> DataFrame:
    """``(grp, cluster, top)``: the highest chosen cluster on the way up, by pointer doubling."""
    state = cut_lineage(closed.select("grp", "cluster", F.col("parent").alias("jump"),
                                      F.when(F.col("chosen"), F.col("cluster")).alias("top")))
    while True:
        above = state.select("grp", F.col("cluster").alias("jump"), F.col("jump").alias("next"),
                             F.col("top").alias("higher"))
        joined = cut_lineage(state.join(above, ["grp", "jump"], "left"))
        again = joined.filter(F.col("next").isNotNull()).limit(1).count()
        state = joined.select("grp", "cluster", F.coalesce("next", "jump").alias("jump"),
                              F.coalesce("higher", "top").alias("top"))
        if not again:
            return state.select("grp", "cluster", "top")


def topic_groups(df: DataFrame, group: str = "state", id_col: str = "id", vector: str = "embedding",
                 min_cluster_size: int = 5, min_samples: int | None = None, block_rows: int = BLOCK_ROWS,
                 band_edges: int = BAND_EDGES) -> DataFrame:
    """Add ``semantic_label`` (-1 = noise) to rows with unit vectors.

    Ids are unique numbers.  Groups of a state are numbered by their smallest id.
    A state with fewer rows than ``min_cluster_size`` is all noise.
    """
    k = min_samples or min_cluster_size
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_cluster_size)
    rows = (df.join(sizes.select(group), group, "left_semi")
            .select(F.col(group).cast("string").alias("grp"), F.col(id_col).cast("bigint").alias("id"),
                    F.col(vector).alias("vector")))
    index = metric_index(rows, block_rows)
    tree = spanning_edges(candidate_edges(index, core_distances(index, k), band_edges), band_edges)
    counts = stage(tree.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
    small = tree.join(counts.filter(F.col("n") <= band_edges), "grp", "left_semi")
    found = small.groupBy("grp").applyInArrow(_with_group(_tail_kernel(min_cluster_size)),
                                              "grp string, id bigint, cluster bigint")
    large = counts.filter(F.col("n") > band_edges).select("grp")
    if large.head(1):
        found = found.union(_merge_in_bands(tree.join(large, "grp", "left_semi"), index.rows.join(large, "grp", "left_semi").select("grp", "id"),
                                            min_cluster_size, band_edges))
    found = cut_lineage(found.filter("cluster >= 0"))
    firsts = found.groupBy("grp", "cluster").agg(F.min("id").alias("first"))
    names = number_rows(firsts, [F.col("first")], "semantic_label", group="grp").select(
        "grp", "cluster", "semantic_label")
    labels = found.join(names, ["grp", "cluster"]).select(F.col("id").alias(id_col), "semantic_label")
    return (df.join(labels, id_col, "left")
            .withColumn("semantic_label", F.coalesce("semantic_label", F.lit(-1).cast("bigint"))))


def _with_group(kernel):
    def run(table: pa.Table) -> pa.Table:
        out = kernel(table)
        grp = pa.array([table.column("grp")[0].as_py()] * len(out), pa.string())
        return out.add_column(0, "grp", grp)

    return run
