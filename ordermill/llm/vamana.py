"""Nearest neighbours by a robust-pruned directed graph in every shard.

Distinct vectors are dealt by hash into shards of about ``SHARD_ROWS``, whatever
the corpus holds. In a shard near copies stand behind one vector of the graph,
since hundreds of them at one distance would fill a beam and hide the rest; a
search scores all of a group that it may need. Each vector of the graph starts with a few random edges; then,
in two passes, a greedy search from a few entries proposes neighbours for it and
robust pruning keeps a diverse set: a candidate goes if a kept one is nearer to
it, by the factor ``ALPHA``, than the vector itself. Edges are added both ways
and pruned again where a vector gets too many. Searches run for many vectors at
a time as numpy arrays. Queries meet every shard in blocks of bounded size, by
a beam search over its graph; candidates are scored again in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise

NEIGHBOURS = 10
EVERY = 100              # queries are the rows whose id this divides
SHARD_ROWS = 8192
QUERY_ROWS = 16384       # of a block
DEGREE = 32
BEAM = 64                # candidates held while a graph is built
SEARCH_BEAM = 128        # and while it is searched
ALPHA = 1.2
ENTRIES = 32             # vectors that a search starts from
NEAR_COPY = 0.15         # of a shard's median distance
_TOGETHER = 512          # searches that run at a time


# --- a shard ---------------------------------------------------------------------

def _apart(x: np.ndarray, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of (n, m) numbered vectors to n vectors."""
    d = x[rows] - to[:, None, :]
    return np.einsum("nmd,nmd->nm", d, d)


def _unique(ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of candidates by distance, each once; the rest is -1 at infinity."""
    order = np.argsort(ids, axis=1, kind="stable")
    ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
    again = np.zeros(ids.shape, bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    again |= ids < 0
    d = np.where(again, np.inf, d)
    order = np.lexsort((ids, d), axis=1)
    ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
    return np.where(np.isinf(d), -1, ids), d


class Graph:
    """Vectors (float32, about their mean and scaled) and the edges of each,
    -1 where fewer.

    A search starts from the medoid, from vectors far apart and from random
    ones: a group of near copies that holds the medoid has few edges that lead
    out of it, and a beam that starts there alone would stay there.
    """

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray | None = None):
        self.scale = np.abs(vectors).max(initial=0) or 1.0
        self.mean = (vectors / self.scale).mean(axis=0)
        self.x = self.place(vectors)                      # squares of any finite component fit
        self.edges = edges
        self.starts = self.entries() if starts is None else starts

    def entries(self) -> np.ndarray:
        chosen = [int(np.einsum("nd,nd->n", self.x, self.x).argmin())]
        apart = np.full(len(self.x), np.inf, np.float32)
        for _ in range(ENTRIES // 2):
            gap = self.x - self.x[chosen[-1]]
            apart = np.minimum(apart, np.einsum("nd,nd->n", gap, gap))
            chosen.append(int(apart.argmax()))
        some = np.random.default_rng(len(self.x)).choice(len(self.x), min(len(self.x), ENTRIES // 2), replace=False)
        return np.unique(np.concatenate((chosen, some)))

    def place(self, vectors: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.ascontiguousarray(vectors / self.scale - self.mean, np.float32)

    def search(self, queries: np.ndarray, beam: int, trail: bool = False):
        """Beam search for many queries: (ids, distances) of the beam, nearest
        first, and with ``trail`` those of all vectors whose edges were
        followed, in the order of their visits."""
        q, n = len(queries), len(self.x)
        e = len(self.starts)
        beam = max(min(beam, n), e)
        ids = np.full((q, beam), -1)
        d = np.full((q, beam), np.inf, np.float32)
        open_ = np.zeros((q, beam), bool)
        ids[:, :e] = self.starts
        d[:, :e] = _apart(self.x, ids[:, :e], queries)
        open_[:, :e] = True
        seen = np.zeros((q, n), bool)
        seen[:, self.starts] = True
        visited: list = []
        live = np.arange(q)
        while len(live):
            best = np.where(open_[live], d[live], np.inf).argmin(axis=1)
            at = ids[live, best]
            if trail:
                step_ids, step_d = np.full(q, -1), np.full(q, np.inf, np.float32)
                step_ids[live], step_d[live] = at, d[live, best]
                visited.append((step_ids, step_d))
            open_[live, best] = False
            more = self.edges[at]
            fresh = (more >= 0) & ~seen[live[:, None], more]
            seen[np.repeat(live, fresh.sum(axis=1)), more[fresh]] = True
            far = np.where(fresh, _apart(self.x, more, queries[live]), np.inf).astype(np.float32)
            all_ids = np.concatenate((ids[live], np.where(fresh, more, -1)), axis=1)
            all_d = np.concatenate((d[live], far), axis=1)
            all_open = np.concatenate((open_[live], fresh), axis=1)
            order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            ids[live], d[live] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_d, order, 1)
            open_[live] = np.take_along_axis(all_open, order, 1)
            live = live[open_[live].any(axis=1)]
        if not trail:
            return ids, d
        return ids, d, np.stack([v[0] for v in visited], axis=1), np.stack([v[1] for v in visited], axis=1)

    def prune(self, own: np.ndarray, ids: np.ndarray, d: np.ndarray, degree: int, alpha: float) -> np.ndarray:
        """Robust pruning of the candidates of many vectors, nearest first."""
        ids, d = _unique(np.where(ids == own[:, None], -1, ids), d)
        width = int((ids >= 0).sum(axis=1).max(initial=0))
        ids, d = ids[:, :width], d[:, :width].copy()
        kept = np.full((len(own), degree), -1)
        vectors = self.x[ids]
        norms = np.einsum("nmd,nmd->nm", vectors, vectors)
        between = np.maximum(norms[:, :, None] + norms[:, None, :] - 2 * (vectors @ vectors.transpose(0, 2, 1)), 0)
        rows = np.arange(len(own))
        for k in range(degree):
            if not width:
                break
            best = d.argmin(axis=1)
            alive = np.isfinite(d[rows, best])
            if not alive.any():
                break
            kept[alive, k] = ids[rows, best][alive]
            # distances are squared, so is the factor
            d[alive[:, None] & (alpha * alpha * between[rows, best] <= d)] = np.inf
            d[rows, best] = np.inf
        return kept


def near_copies(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """The leader (position) of each vector, itself or an earlier vector within
    a radius, and that radius."""
    scale = np.abs(vectors).max(initial=0) or 1.0
    x = vectors / scale
    x = x - x.mean(axis=0)
    n = len(x)
    norms = np.einsum("nd,nd->n", x, x)

    def squares(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        return np.maximum(norms[rows][:, None] + norms[to] - 2 * (x[rows] @ x[to].T), 0)
    some = np.random.default_rng(n).choice(n, min(n, 256), replace=False)
    radius = NEAR_COPY * float(np.sqrt(np.median(squares(some, some))))
    leader, left, leaders = np.full(n, -1), np.arange(n), 0
    while len(left):                     # the first vectors left lead each other, then all the rest
        head = left[:_TOGETHER]
        close = squares(head, head) <= radius * radius
        own: list[int] = []
        for k in range(len(head)):
            led = [j for j in own if close[k, j]]
            leader[head[k]] = head[led[0]] if led else head[k]
            own += [] if led else [k]
        left = left[_TOGETHER:]
        if len(left):
            close = squares(left, head[own]) <= radius * radius
            led = close.any(axis=1)
            leader[left[led]] = head[own][close[led].argmax(axis=1)]
            left = left[~led]
    return leader, radius * scale


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> Graph:
    """The graph of a shard's distinct vectors, the same at every run."""
    n = len(vectors)
    rng = np.random.default_rng(n)
    edges = np.full((n, degree), -1)
    some = min(degree // 2, n - 1)
    if some:
        edges[:, :some] = (np.arange(n)[:, None] + rng.integers(1, n, (n, some))) % n
    graph = Graph(vectors, edges)
    x = graph.x
    for factor, width in ((1.0, beam // 2), (alpha, beam)):
        order = rng.permutation(n)
        for a in range(0, n, _TOGETHER):
            own = order[a:a + _TOGETHER]
            ids, d, trail, trail_d = graph.search(x[own], width, trail=True)
            old = graph.edges[own]
            old_d = np.where(old >= 0, _apart(x, old, x[own]), np.inf)
            graph.edges[own] = graph.prune(own, np.concatenate((ids, trail, old), axis=1),
                                           np.concatenate((d, trail_d, old_d), axis=1), degree, factor)
            _link_back(graph, own, degree, factor)
    return graph


def _link_back(graph: Graph, own: np.ndarray, degree: int, factor: float) -> None:
    """Edges from the new neighbours back to ``own``, pruned where they are
    too many; of a hub's proposals the nearest count."""
    new = graph.edges[own]
    at, k = np.nonzero(new >= 0)
    target, source = new[at, k], own[at]
    there = (graph.edges[target] == source[:, None]).any(axis=1)
    target, source = target[~there], source[~there]
    if not len(target):
        return
    gap = graph.x[target] - graph.x[source]
    order = np.lexsort((source, np.einsum("nd,nd->n", gap, gap), target))
    target, source = target[order], source[order]
    hubs, first, counts = np.unique(target, return_index=True, return_counts=True)
    rank = np.arange(len(target)) - np.repeat(first, counts)
    fits = rank < 2 * degree
    proposed = np.full((len(hubs), int(min(counts.max(), 2 * degree))), -1)
    proposed[np.repeat(np.arange(len(hubs)), counts)[fits], rank[fits]] = source[fits]
    ids = np.concatenate((graph.edges[hubs], proposed), axis=1)
    full = (ids >= 0).sum(axis=1) > degree
    left = np.argsort(ids[~full] < 0, axis=1, kind="stable")[:, :degree]
    graph.edges[hubs[~full]] = np.take_along_axis(ids[~full], left, 1)
    for a in range(0, int(full.sum()), _TOGETHER):
        some, rows = hubs[full][a:a + _TOGETHER], ids[full][a:a + _TOGETHER]
        d = np.where(rows >= 0, _apart(graph.x, rows, graph.x[some]), np.inf)
        graph.edges[some] = graph.prune(some, rows, d, degree, factor)


# --- tables ----------------------------------------------------------------------

def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, equal rows once."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & sound & F.exists(x, lambda c: c != 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: c + F.lit(0.0)).alias("v"))
            .distinct())


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _build_shard(degree: int, beam: int, alpha: float):
    def run(key, table):
        table = table.sort_by([("order", "ascending"), ("first", "ascending")])
        leader, radius = near_copies(_matrix(table["v"]))
        order = np.lexsort((np.arange(len(leader)), leader))           # a leader is the first of its group
        table = table.take(pa.array(order))
        v = _matrix(table["v"])
        groups = np.flatnonzero(leader[order] == order)
        graph = build(v[groups], degree, beam, alpha)
        ids = table["ids"].combine_chunks()

        def binary(values: np.ndarray, kind: str) -> pa.Array:
            return pa.array([values.astype(kind).tobytes()], pa.binary())
        return pa.table({
            "dimension": table["dimension"][:1], "shard": table["shard"][:1], "radius": pa.array([radius]),
            "starts": binary(graph.starts, "<i4"), "edges": binary(graph.edges, "<i4"), "groups": binary(groups, "<i4"),
            "vectors": binary(v, "<f8"), "ids": binary(ids.flatten().to_numpy(), "<i8"),
            "held": binary(np.diff(ids.offsets.to_numpy()), "<i4")})
    return run


_SHARD_COLUMNS = ("radius", "starts", "edges", "groups", "vectors", "ids", "held")
_SHARDS = ("dimension int, shard long, radius double, starts binary, edges binary, groups binary, vectors binary, "
           "ids binary, held binary")


def _spread(df: DataFrame, units: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over a fixed number of tasks: a shard takes
    long for its bytes, so few bytes must not be put together in one task."""
    most = max(4096, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(max(1, min(2 * units, most)), *keys)


def build_index(vectors: DataFrame, neighbours: int = NEIGHBOURS, shard_rows: int = SHARD_ROWS, degree: int = DEGREE,
                beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """A row per shard with its vectors and graph. ``vectors``: (vec_id, v).

    Of equal vectors the graph holds one, with the smallest ids that a query
    can ask for: ``neighbours`` and one more, as a query leaves itself out.
    """
    first = Window.partitionBy("v").orderBy("vec_id")
    some = vectors.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= neighbours + 1)
    nodes = materialise(some.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                        .withColumn("dimension", F.size("v")), "ann_nodes")
    sizes = nodes.groupBy("dimension").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))
    units = sizes.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0]
    nodes = nodes.join(sizes, "dimension").select(
        "dimension", F.pmod(F.xxhash64("v"), F.col("shards")).alias("shard"), "v", "ids",
        F.xxhash64("v", F.lit(1)).alias("order"), F.col("ids")[0].alias("first"))
    shards = _spread(nodes, units, "dimension", "shard").groupBy("dimension", "shard").applyInArrow(_build_shard(degree, beam, alpha), _SHARDS)
    return materialise(shards, "ann_shards")


def _search_shard(neighbours: int, beam: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("query", pa.int64())])

    def run(key, shards, queries):
        out = []
        if shards.num_rows and queries.num_rows:
            row = shards.to_pylist()[0]
            vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dimension"])
            edges, groups = np.frombuffer(row["edges"], "<i4"), np.frombuffer(row["groups"], "<i4")
            graph = Graph(vectors[groups], edges.reshape(len(groups), -1), np.frombuffer(row["starts"], "<i4"))
            sizes = np.diff(np.append(groups, len(vectors)))
            ids, held = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["held"], "<i4")
            at = np.cumsum(held) - held
            q, names, numbers = _matrix(queries["v"]), queries["vec_id"].to_numpy(), queries["query"].to_numpy()
            for a in range(0, len(q), _TOGETHER):
                some = q[a:a + _TOGETHER]
                found, far = graph.search(graph.place(some), beam)
                far = np.sqrt(far.astype(np.float64)) * graph.scale
                # a leader this far away may have a near copy among the nearest
                reach = far[:, min(neighbours, far.shape[1] - 1)][:, None] + 1.001 * row["radius"]
                for k in range(len(some)):
                    near = found[k][(found[k] >= 0) & (far[k] <= reach[k])]
                    rows = np.repeat(groups[near] - np.cumsum(sizes[near]) + sizes[near], sizes[near]) + np.arange(sizes[near].sum())
                    gap = vectors[rows] - some[k]
                    score = np.sqrt((gap * gap).sum(axis=1))
                    # a last place that several share goes to the smallest ids: none of them is cut
                    last = min(neighbours, len(score) - 1)
                    best = np.flatnonzero(score <= np.partition(score, last)[last])
                    hits = [(score[j], i) for j in best for r in [rows[j]] for i in ids[at[r]:at[r] + held[r]].tolist()
                            if not (i == names[a + k] and np.array_equal(vectors[r], some[k]))]
                    out += [(names[a + k], i, d, numbers[a + k]) for d, i in sorted(hits)[:neighbours]]
        return pa.Table.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)
    return run


def search_index(index: DataFrame, queries: DataFrame, neighbours: int = NEIGHBOURS, beam: int = SEARCH_BEAM,
                 query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest neighbours found.
    ``queries``: (vec_id, v). Every query meets every shard of its dimension,
    a block of queries and a shard at a time."""
    queries = materialise(queries.select("vec_id", "v", F.size("v").alias("dimension"),
                                         F.monotonically_increasing_id().alias("query")), "ann_queries")
    blocks = queries.groupBy("dimension").agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("blocks"))
    shards = index.select("dimension").groupBy("dimension").agg(F.count(F.lit(1)).alias("shards"))

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    asked = (queries.join(blocks, "dimension").join(shards, "dimension")
             .withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks"))).withColumn("shard", every(F.col("shards")))
             .select("dimension", "shard", "block", "query", "vec_id", "v"))
    # shards are numbered as they are, without gaps
    number = index.select("dimension", "shard").withColumn(
        "place", F.row_number().over(Window.partitionBy("dimension").orderBy("shard")) - 1)
    graphs = (index.join(number, ["dimension", "shard"]).join(blocks, "dimension").withColumn("block", every(F.col("blocks")))
              .withColumn("shard", F.col("place").cast("long")).select("dimension", "shard", "block", *_SHARD_COLUMNS))
    keys = ["dimension", "shard", "block"]
    units = shards.join(blocks, "dimension").agg(F.coalesce(F.sum(F.col("shards") * F.col("blocks")), F.lit(0))).first()[0]
    graphs, asked = _spread(graphs, units, *keys), _spread(asked, units, *keys)
    found = graphs.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        _search_shard(neighbours, beam), "query_id long, vec_id long, score double, query long")
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= neighbours)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest_neighbours(vectors: DataFrame, every: int = EVERY, neighbours: int = NEIGHBOURS, shard_rows: int = SHARD_ROWS,
                       degree: int = DEGREE, beam: int = SEARCH_BEAM) -> DataFrame:
    """For each row of ``vectors`` (``vec_id``, ``embedding``) whose id is
    divisible by ``every``, the nearest rows found: query_id, rank, vec_id,
    score (Euclidean distance in double precision), ties to the smaller id.

    Rows without an id, and vectors that are null, empty, zero or hold a null or
    non-finite component, take no part. Equal rows count once; of equal ids with
    different vectors each is a row of its own. Only vectors of one length are
    compared. A query with fewer candidates than ``neighbours`` gets them all;
    an empty table, or a lone vector, gives no rows. Other columns are not read.
    """
    rows = materialise(usable_vectors(vectors), "ann_vectors")
    index = build_index(rows, neighbours, shard_rows, degree)
    return search_index(index, rows.where(F.col("vec_id") % every == 0), neighbours, beam)
