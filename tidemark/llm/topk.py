"""Exact top-k search by inner product with cover trees on both sides.

Pivots are the top of a cover tree over a bounded sample; every vector is
dealt to its nearest pivot, and the vectors of a pivot to tiles of bounded
size.  Every tile has a cover tree: the children of a node are a net of its
points at half its scale; where MAX_KIDS centres do not cover it at that
scale, they are some of its points, each with those next to it.  A node knows
its covering radius.  For a query node a and a data node b with
centres A, B and radii r, s, no inner product exceeds

    A.B + r |B| + s |A| + r s.

Tiles are the upper nodes.  Each query tile first meets the data tiles with
the greatest bounds and learns its queries' kth scores; a data tile is sent to
it after that only if the pair's bound reaches the worst of these, so pruned
pairs are never shuffled.  Inside a task a node pair whose bound is below the
worst kth score of the query node is dropped with all that lies below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import freed, importable, read, written

TILE = 2048        # data rows in a tile, on average
QUERY_TILE = 2048  # queries in a tile, on average
RUN = 16           # data tiles that pass a query tile in one task, on average
FIRST = 2          # data tiles that a query tile meets before the others are chosen
LEAF = 64          # points that are only split further where they cluster
MIN_LEAF = 8       # points that are not split further
MAX_KIDS = 32      # children of a node
SAMPLE = 4096      # vectors from which the pivots are taken
PIVOTS = 256       # pivots at most
CHUNK = 1024       # data points scored at once, once kth scores are good
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
NONE = LONG_MIN    # kth score of a query that has fewer answers yet


def net(points: np.ndarray, first: int, scale: float, most: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(centres, nearest centre of each point, distance to it): farthest
    points become centres until all lie within ``scale`` of one, or there
    are ``most``."""
    gap = np.sqrt(((points - points[first]) ** 2).sum(axis=1))
    owner, centres = np.zeros(len(points), dtype=np.int64), [first]
    while len(centres) < most and gap[far := int(gap.argmax())] > scale:
        new = np.sqrt(((points - points[far]) ** 2).sum(axis=1))
        closer = new < gap
        owner[closer], gap[closer] = len(centres), new[closer]
        centres.append(far)
    return centres, owner, gap


def upper(dots, r, s, a_norm, b_norm) -> np.ndarray:
    """What no inner product between two balls exceeds, with room for the
    rounding of every term that goes into it."""
    with np.errstate(over="ignore", invalid="ignore"):
        return dots + r * b_norm + s * a_norm + r * s + 1e-9 * (a_norm + r) * (b_norm + s) + 1e-6


class CoverTree:
    """Cover tree of the rows of ``x``.  ``order``: the rows, those of a node
    side by side; by node: ``lo``, ``hi`` (its range in ``order``), ``centre``
    (a row), ``radius``, ``kids`` (its children's numbers; none: a leaf)."""

    @np.errstate(over="ignore", invalid="ignore")
    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.arange(len(x))
        self.lo, self.hi, self.centre, self.radius, self.kids = [0], [len(x)], [], [], [[]]
        at = 0
        while at < len(self.lo):  # breadth first; children are appended
            self._split(at)
            at += 1
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.centre = np.array(self.centre)
        self.radius = np.array(self.radius)
        self.norm = np.sqrt((x[self.centre] ** 2).sum(axis=1)) if len(x) else np.zeros(1)

    def _split(self, at: int) -> None:
        rows = self.order[self.lo[at]:self.hi[at]]
        if not len(rows):
            self.centre.append(0)
            self.radius.append(0.0)
            return
        points = self.x[rows]
        # the root takes the point next to the mean, a child the net's point,
        # which lies first
        first = 0 if at else int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
        gap = np.sqrt(((points - points[first]) ** 2).sum(axis=1))
        self.centre.append(int(rows[first]))
        self.radius.append(float(gap.max()) * (1 + 1e-9))
        if len(rows) <= MIN_LEAF or not 0 < self.radius[at] < np.inf:
            return  # few points, equal ones, or beyond the doubles
        small = len(rows) <= LEAF
        centres, owner, gap = net(points, first, self.radius[at] / 2, len(rows) // 4 if small else MAX_KIDS)
        if gap.max() > self.radius[at] / 2:  # not clustered at this scale
            if small:
                return
            few = min(MAX_KIDS, len(rows) // LEAF + 1)
            centres = sorted({first, *np.linspace(0, len(rows) - 1, few).astype(int).tolist()})
            c = points[centres]
            owner = (points @ c.T - (c ** 2).sum(axis=1) / 2).argmax(axis=1)
            owner[centres] = np.arange(len(centres))  # equal points share a part
            if np.bincount(owner).max() == len(rows):
                return
        lead = np.ones(len(rows), dtype=np.int64)
        lead[centres] = 0
        by = np.lexsort((lead, owner))
        self.order[self.lo[at]:self.hi[at]] = rows[by]
        cuts = np.searchsorted(owner[by], np.arange(len(centres) + 1)) + self.lo[at]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a < b:
                self.kids[at].append(len(self.lo))
                self.lo.append(a)
                self.hi.append(b)
                self.kids.append([])


class Search:
    """The k best rows seen so far of every query of a tile.  Rows that are
    equal in id and vector are one, ``many`` times; ``kth`` are kth scores
    known from elsewhere (NONE: none)."""

    def __init__(self, ids: np.ndarray, many: np.ndarray, x: np.ndarray, k: int, kth: np.ndarray | None = None):
        self.tree, self.k = CoverTree(x), k
        order = self.tree.order
        self.ids, self.many, self.x, self.place = ids[order], many[order], x[order], order
        n = len(ids)
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]  # (-score, id, times), sorted
        self.kth = np.full(n, NONE, dtype=np.int64) if kth is None else kth[order]
        self.scored = 0  # inner products taken

    def worst(self, lo: int, hi: int) -> float:
        """No greater than the kth score of any query from lo to hi."""
        return float(np.nextafter(float(self.kth[lo:hi].min()), -np.inf))

    @np.errstate(over="ignore", invalid="ignore")
    def see(self, ids: np.ndarray, many: np.ndarray, x: np.ndarray) -> None:
        """Search a data tile."""
        if not len(ids) or not len(self.ids):
            return
        data, own = CoverTree(x), self.tree
        ids, many, x = ids[data.order], many[data.order], x[data.order]
        largest = float(np.abs(self.x).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
        kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else object
        if kind is object:
            exact = [np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape)
                     for m in (self.x, x)]
        else:
            exact = [self.x.astype(kind), x.astype(kind)]
        own_kids, data_kids = (np.array([len(k) for k in t.kids]) for t in (own, data))
        a, b = np.array([0]), np.array([0])
        pairs: dict[int, list[tuple[float, int]]] = {}
        while len(a):
            dots = np.einsum("ij,ij->i", own.x[own.centre[a]], data.x[data.centre[b]])
            bound = upper(dots, own.radius[a], data.radius[b], own.norm[a], data.norm[b])
            nodes, back = np.unique(a, return_inverse=True)
            worst = np.array([self.worst(own.lo[i], own.hi[i]) for i in nodes.tolist()])[back]
            go = ~(bound < worst)  # a bound beyond the doubles prunes nothing
            a, b, bound = a[go], b[go], bound[go]
            leaf = (own_kids[a] == 0) & (data_kids[b] == 0)
            for i, j, most in zip(a[leaf].tolist(), b[leaf].tolist(), bound[leaf].tolist(), strict=True):
                pairs.setdefault(i, []).append((most, j))
            a, b = a[~leaf], b[~leaf]
            down = (data_kids[b] == 0) | ((own_kids[a] > 0) & (own.radius[a] >= data.radius[b]))
            left, right = [], []
            for i, j, split in zip(a.tolist(), b.tolist(), down.tolist(), strict=True):
                if split:
                    left += own.kids[i]
                    right += [j] * len(own.kids[i])
                else:
                    right += data.kids[j]
                    left += [i] * len(data.kids[j])
            a, b = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
        for i, leaves in pairs.items():
            leaves.sort(reverse=True)
            at, lo, hi, some_first = 0, own.lo[i], own.hi[i], 2 * self.k
            while at < len(leaves):
                worst, rows, some_first = self.worst(lo, hi), [], min(CHUNK, 2 * some_first)
                while at < len(leaves) and sum(map(len, rows)) < some_first:
                    most, j = leaves[at]
                    if most < worst:  # nor do the rest reach it
                        at = len(leaves)
                        break
                    rows.append(np.arange(data.lo[j], data.hi[j]))
                    at += 1
                for part in range(0, sum(map(len, rows)), 4 * CHUNK):
                    some = np.concatenate(rows)[part:part + 4 * CHUNK]
                    for q in range(lo, hi, 512):
                        z = min(q + 512, hi)
                        self._keep(q, z, ids[some], many[some], x[some], exact[0][q:z] @ exact[1][some].T)

    def _keep(self, lo: int, hi: int, ids: np.ndarray, many: np.ndarray, x: np.ndarray, scores: np.ndarray) -> None:
        self.scored += scores.size
        if scores.dtype == object:
            scores = np.minimum(np.maximum(scores, LONG_MIN), LONG_MAX).astype(np.int64)
        else:
            least = np.full(hi - lo, -np.inf)
            if scores.shape[1] > 4 * self.k:
                # the kth best but one: the query's own row may be among them
                least = np.partition(scores, -self.k - 1, axis=1)[:, -self.k - 1]
            near = np.flatnonzero((scores >= least[:, None]).ravel())  # whole numbers below 2^53
            keep = np.full(scores.shape, False).ravel()
            keep[near] = scores.ravel()[near].astype(np.int64) >= np.repeat(self.kth[lo:hi], scores.shape[1])[near]
            return self._add(lo, keep.reshape(scores.shape), ids, many, x, scores)
        return self._add(lo, scores >= self.kth[lo:hi][:, None], ids, many, x, scores)

    def _add(self, lo: int, keep: np.ndarray, ids: np.ndarray, many: np.ndarray, x: np.ndarray, scores: np.ndarray) -> None:
        q, c = np.nonzero(keep)
        cuts = np.searchsorted(q, np.arange(len(keep) + 1))
        for i in np.unique(q).tolist():
            new = []
            for j in c[cuts[i]:cuts[i + 1]].tolist():
                times = int(many[j])
                if ids[j] == self.ids[lo + i] and np.array_equal(x[j], self.x[lo + i]):
                    times -= 1  # the query's own row
                if times > 0:
                    new.append((-int(scores[i, j]), int(ids[j]), min(times, self.k)))
            if not new:
                continue
            best = sorted(self.best[lo + i] + new)
            have = at = 0
            while at < len(best) and have < self.k:
                have += best[at][2]
                at += 1
            self.best[lo + i] = best[:at]
            if have >= self.k:
                self.kth[lo + i] = max(self.kth[lo + i], -best[at - 1][0])

    def rows(self) -> pa.RecordBatch:
        n = [len(x) for x in self.best]
        flat = [e for x in self.best for e in x]
        at = np.repeat(np.arange(len(n)), n)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[at].astype(np.int64)), pa.array(self.place[at].astype(np.int32)),
             pa.array([e[1] for e in flat], pa.int64()), pa.array([-e[0] for e in flat], pa.int64()),
             pa.array([e[2] for e in flat], pa.int32())], names=["query_id", "place", "vec_id", "score", "times"])


def _tile(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, many = (batch.column(c)[row].values.to_numpy() for c in ("ids", "many"))
    flat = batch.column("flat")[row].values
    return ids, many, flat.to_numpy().reshape(len(ids), batch.column("dim")[row].as_py())


def pivots_of(sample: list[list[float]], most: int) -> dict[int, np.ndarray]:
    """By length of the vectors: the top of a cover tree of the sample, at
    most ``most`` centres."""
    out = {}
    for dim in {len(v) for v in sample}:
        x = np.array([v for v in sample if len(v) == dim], dtype=np.float64).reshape(-1, dim)
        with np.errstate(over="ignore", invalid="ignore"):
            first = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
            out[dim] = x[net(x, first, 0.0, most)[0]]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: float = 64.0, tile: int = TILE,
          query_tile: int = QUERY_TILE, run: int = RUN, sample: int = SAMPLE, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` the k
    rows of ``vectors`` of the greatest inner product, components turned to
    floor(``scale`` * x); ties go to the smaller id.  A query's own row, one
    with its id and vector, is not its answer; further rows with its id are,
    and rows that repeat an id, or a whole row, count each.  Fewer than k
    rows where there are fewer candidates.

    Vectors that are NULL or hold NULL or non-finite components, and rows
    with a NULL id, take no part.  Vectors of different lengths are not
    compared.  Scores are exact; one outside the range of long becomes its
    end.  Other columns are not looked at.  Empty tables give no rows.

    Pivots come from the ``sample`` rows of least hash; every row is dealt to
    its nearest one, whatever the sample.  A data tile goes to the query
    tiles whose worst kth score its bound reaches; a task holds one of each.
    A query's results of different runs are merged by a window over at most
    k rows a run, cut to k before the shuffle.
    """
    spark = vectors.sparkSession
    importable(spark)

    def floored(df: DataFrame) -> DataFrame:
        v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
        fine = F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                                                     & (F.abs(x) < F.lit(float("inf"))))
        # floor() gives a long and fails beyond it; doubles that large are whole
        big = F.lit(float(1 << 52))
        whole = lambda x: F.when(F.abs(x) >= big, x).otherwise(
            F.floor(F.when(F.abs(x) < big, x)).cast("double"))
        return (df.where(F.coalesce(fine, F.lit(False)))
                .select(F.col(id_col).cast("long").alias("id"),
                        F.transform(v, lambda x: whole(x * F.lit(float(scale)))).alias("v"))
                .groupBy("id", "v").agg(F.count(F.lit(1)).alias("many")))

    with freed(spark):
        data = floored(vectors)
        data = written(data.select("id", "many", "v", F.size("v").alias("dim")), "vectors")
        n_data = -(-max(1, data.count()) // tile)
        some = [r.v for r in data.orderBy(F.xxhash64("id", "v"), "id").limit(sample).select("v").collect()]
        centres = pivots_of(some, min(pivots, 2 * n_data))
        asked = floored(queries)
        asked = written(asked.select("id", "many", "v", F.size("v").alias("dim")), "queries")
        # every data tile meets every query tile in the worst case, so there
        # are no more query tiles than their size asks for
        few = min(pivots, -(-max(1, asked.count()) // query_tile))
        own_centres = {d: np.array([v for v in some if len(v) == d][:few], dtype=np.float64).reshape(-1, d)
                       for d in centres}
        data = _tiles(_dealt(data, centres), tile, "data-tiles")
        asked = _tiles(_dealt(asked, own_centres), query_tile, "query-tiles")
        pairs = written(_bounded(asked, data, own_centres, centres), "tile-pairs")
        by = Window.partitionBy("dim", "q").orderBy(F.desc("bound"), "d")
        first = pairs.withColumn("n", F.row_number().over(by)).where(F.col("n") <= FIRST)
        found = written(_searched(asked, data, first, k, run), "first-answers")
        # the queries' kth scores: those with fewer answers have none
        kth = (found.groupBy("dim", "q", "place").agg(
            F.when(F.sum("times") >= k, F.sort_array(F.flatten(F.collect_list(F.array_repeat("score", F.col("times")))),
                                                     asc=False)[k - 1]).alias("kth"))
            .groupBy("dim", "q").agg(F.map_from_entries(F.collect_list(F.struct("place", "kth"))).alias("known"))
            .select("dim", "q", "known"))
        asked = written(asked.join(kth, ["dim", "q"], "left").withColumn("kth", F.transform(
            "ids", lambda _, i: F.coalesce(F.try_element_at("known", i.cast("int")), F.lit(NONE)))).drop("known"), "asked")
        worst = asked.select("dim", "q", F.array_min("kth").alias("worst"))
        rest = (pairs.join(first.select("dim", "q", "d"), ["dim", "q", "d"], "left_anti").join(worst, ["dim", "q"])
                .where(~(F.col("bound") < F.col("worst").cast("double") * (1 - 1e-15 * F.signum(F.col("worst").cast("double"))))))
        found = written(found.unionByName(_searched(asked, data, rest, k, run)), "answers")
    order = Window.partitionBy("dim", "q", "place").orderBy(F.desc("score"), "vec_id")
    ranked = (found.withColumn("one", F.explode(F.sequence(F.lit(1), "times")))
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    times = asked.select("dim", "q", F.posexplode("many").alias("place", "rows")).where("rows > 1")
    return (ranked.join(times, ["dim", "q", "place"], "left")
            .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("rows", F.lit(1)))))
            .select("query_id", "rank", "vec_id", "score"))


def _dealt(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Every vector's nearest pivot and its distance; a length that the
    sample lacks has the origin as its pivot."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, v = b.column("dim").to_numpy(), b.column("v")
            flat, cuts = v.flatten().to_numpy(), np.cumsum(np.concatenate([[0], dims]))
            pivot, gap = np.zeros(b.num_rows, dtype=np.int32), np.zeros(b.num_rows)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                c = centres.get(int(dim), np.zeros((1, dim)))
                for lo in range(0, len(at), 1024):
                    some = at[lo:lo + 1024]
                    x = flat[cuts[some][:, None] + np.arange(dim)].reshape(len(some), dim)
                    with np.errstate(over="ignore", invalid="ignore"):
                        near = (x @ c.T) - (c ** 2).sum(axis=1) / 2
                        pivot[some] = np.where(np.isfinite(near).all(axis=1), near.argmax(axis=1), 0)
                        gap[some] = np.sqrt(((x - c[pivot[some]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pivot), pa.array(gap)],
                                             names=["id", "many", "v", "dim", "pivot", "gap"])
    return rows.mapInArrow(deal, "id long, many long, v array<double>, dim int, pivot int, gap double")


def _tiles(dealt: DataFrame, size: int, name: str) -> DataFrame:
    """(dim, pivot, part, radius, ids, many, flat, q/d): the vectors of a
    pivot in parts of about ``size`` rows."""
    dealt = written(dealt, name + "-dealt")
    parts = dealt.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))
    row = F.struct("id", "many", "v")
    packed = (dealt.join(parts, ["dim", "pivot"])
              .withColumn("part", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int"))
              .groupBy("dim", "pivot", "part")
              .agg(F.max("gap").alias("radius"), F.sort_array(F.collect_list(row)).alias("rows")))
    tile = "q" if name.startswith("query") else "d"
    return written(packed.select(
        "dim", "pivot", "radius", F.concat_ws(".", "pivot", "part").alias(tile), F.col("rows.id").alias("ids"),
        F.col("rows.many").alias("many"), F.flatten("rows.v").alias("flat")), name)


def _bounded(asked: DataFrame, data: DataFrame, own_centres: dict[int, np.ndarray],
             centres: dict[int, np.ndarray]) -> DataFrame:
    """(dim, q, d, bound) for the tiles of either side: a few numbers a pair."""
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, p, r, o, s = (b.column(i).to_numpy() for i in (0, 3, 4, 5, 6))
            out = np.zeros(b.num_rows)
            for dim in np.unique(dims):
                a, c = (m.get(int(dim), np.zeros((1, dim))) for m in (own_centres, centres))
                at = np.flatnonzero(dims == dim)
                with np.errstate(over="ignore", invalid="ignore"):
                    a_size, c_size = (np.sqrt((m ** 2).sum(axis=1)) for m in (a, c))
                    out[at] = upper((a @ c.T)[p[at], o[at]], r[at] * (1 + 1e-9), s[at] * (1 + 1e-9),
                                    a_size[p[at]], c_size[o[at]])
            out[np.isnan(out)] = np.inf
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out)], names=["dim", "q", "d", "bound"])
    own = asked.select("dim", "q", "pivot", "radius")
    other = data.select("dim", "d", F.col("pivot").alias("pivot_d"), F.col("radius").alias("radius_d"))
    return own.join(other, "dim").select("dim", "q", "d", "pivot", "radius", "pivot_d", "radius_d").mapInArrow(
        bound, "dim int, q string, d string, bound double")


def _searched(asked: DataFrame, data: DataFrame, pairs: DataFrame, k: int, run: int) -> DataFrame:
    """(dim, q, place, query_id, vec_id, score, times): answers of query
    tiles from the data tiles they are paired with."""
    runs = pairs.groupBy("dim", "q").agg(F.ceil(F.count(F.lit(1)) / run).cast("int").alias("runs"))
    pairs = pairs.join(runs, ["dim", "q"]).select(
        "dim", "q", "d", F.pmod(F.xxhash64("d"), F.col("runs")).cast("int").alias("run"), F.col("bound").alias("b"))
    kth = F.col("kth") if "kth" in asked.columns else F.lit(None).cast("array<long>")
    cols = ["dim", "q", "run", "b", "ids", "many", "flat", "kth"]
    own = (pairs.select("dim", "q", "run").distinct().join(asked, ["dim", "q"])
           .select("dim", "q", "run", F.lit(None).cast("double").alias("b"), "ids", "many", "flat", kth.alias("kth")))
    other = (pairs.join(data, ["dim", "d"]).withColumn("kth", F.lit(None).cast("array<long>")).select(*cols))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = None, None

        def answers():
            rows = now.rows()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows.num_rows, at[0], dtype=np.int32)), pa.array([at[1]] * rows.num_rows, pa.string()),
                 *rows.columns], names=["dim", "q", *rows.schema.names])
        for batch in batches:
            for row in range(batch.num_rows):
                key = tuple(batch.column(c)[row].as_py() for c in ("dim", "q", "run"))
                if batch.column("b")[row].as_py() is None:  # the query tile comes first
                    if now is not None:
                        yield answers()
                    known = batch.column("kth")[row]
                    at, now = key, Search(*_tile(batch, row), k, known.values.to_numpy() if known.is_valid else None)
                elif key == at:
                    now.see(*_tile(batch, row))
        if now is not None:
            yield answers()

    return (own.unionByName(other).repartition("dim", "q", "run")
            .sortWithinPartitions("dim", "q", "run", F.col("b").desc_nulls_first())
            .mapInArrow(search, "dim int, q string, query_id long, place int, vec_id long, score long, times int"))


K = 20
EVERY = 20


def op1_topk_search(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0), K)


OP1_SQL = f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.rid, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.rid <> q.rid AND len(c.v) = len(q.v)
  WHERE q.vec_id % {EVERY} = 0),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank,
         vec_id, score
  FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
