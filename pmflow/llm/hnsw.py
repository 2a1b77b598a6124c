"""Approximate nearest neighbours (operator 10): a hierarchical navigable
small-world graph per shard, kept as flat neighbour arrays; every query block
searches every shard, and the shards' results are merged.

Rows are dealt to shards of about ``shard_rows`` at random but repeatably, each
shard's graph is built in one task, and written as one row of arrays. Queries
are packed in blocks of ``block_rows``; a (shard, block) pair is a task's work.
Equal vectors of a shard are one node that knows its smallest ids, as many as a
result can show, so a vector that fills a third of the table costs one node per
shard.

Graph: a node's level is drawn from a hash; on each level nodes join in order,
each linked with neighbours among the earlier ones (and them with it), chosen
for nearness and spread: a candidate is taken unless one already taken is
nearer to it. Search is greedy from the top and a beam of ``ef`` on the ground
level, many queries at a time.

Nearness is the largest inner product. Vectors get one more component so that
all have equal norm, which leaves their products with a query as they are. The
nodes of a shard are parted into bands of norms that differ by less than
``BAND``, each with a graph of its own, scaled by a power of two to a norm of
about one: next to a far larger norm, the products of the others would round to
one value, and beyond single precision's range they would be infinite. Every
band is searched; of one that fits the beam all nodes are found. Found vectors
are scored again in double precision on the original components; a score
beyond its range is infinite.

Null ids, and vectors that are null, empty, zero, or holding null or non-finite
components take no part. Vectors of each length have graphs of their own, and a
query is searched among those of its length. A query's own row is no candidate;
another row of the same id is. Repeated query rows each give their results.
Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pmflow.llm.common import bounded_batches, column, materialise

#: Rows of a shard, on average, and queries of a block.
SHARD_ROWS = 16_384
BLOCK_ROWS = 4_096
#: Links of a node on an upper level; on the ground level twice as many.
LINKS = 16
#: Candidates from which a node's links are chosen.
BUILD_CANDIDATES = 64
#: Beam of the search.
EF = 160
#: Nodes, or queries, that are worked on side by side.
STEP = 512
#: Norms of a graph's nodes differ by less than this factor.
BAND = 4.0


def _scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row divided by a power of two so that its largest component is
    between a half and one, and the powers' exponents."""
    power = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -power[:, None]), power


def _bands(vectors: np.ndarray) -> np.ndarray:
    """Each row's band, counted from the largest norm down."""
    v, power = _scaled(vectors)
    norm = power + np.log2(np.einsum("ij,ij->i", v, v)) / 2
    return ((norm.max() - norm) / np.log2(BAND)).astype(np.int64)


def _scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Products with a query; where a sum's parts leave the range, from scaled
    vectors, so that it is infinite only if it is too large itself."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = vectors @ query
        if not np.isfinite(out).all():
            v, power = _scaled(vectors)
            q, more = _scaled(query[None, :])
            out = np.where(np.isfinite(out), out, np.ldexp(v @ q[0], power + more))
    return out


def _choose(vectors: np.ndarray, candidates: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates (indices, nearest first, -1: none) those that
    are nearer to the row's node than to any candidate taken before; filled up
    with the nearest of the others. -1 pads."""
    n, width = candidates.shape
    there = candidates >= 0
    near = vectors[np.where(there, candidates, 0)]
    between = near @ near.transpose(0, 2, 1)
    taken = np.zeros((n, width), bool)
    for j in range(width):
        nearest = np.where(taken, between[:, j], -np.inf).max(axis=1)
        taken[:, j] = there[:, j] & (sims[:, j] > nearest) & (taken.sum(axis=1) < keep)
    order = np.argsort(np.where(taken, 0, np.where(there, 1, 2)) * width + np.arange(width), axis=1)[:, :keep]
    out = np.take_along_axis(candidates, order, 1)
    return np.pad(out, ((0, 0), (0, max(0, keep - out.shape[1]))), constant_values=-1)


def _link(vectors: np.ndarray, keep: int) -> np.ndarray:
    """Neighbour lists (n, keep) of one level's nodes in their order of
    joining: each is linked with chosen earlier ones; links go both ways, and
    a node with too many chooses again."""
    n = len(vectors)
    width = min(BUILD_CANDIDATES, max(n - 1, 1))
    source, target, value = [], [], []
    for a in range(0, n, STEP):
        b = min(a + STEP, n)
        sims = vectors[a:b] @ vectors[:b].T
        sims[np.arange(b)[None, :] >= np.arange(a, b)[:, None]] = -np.inf  # earlier ones only
        k = min(width, b)
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        s = np.take_along_axis(sims, top, 1)
        order = np.argsort(-s, axis=1, kind="stable")
        top, s = np.take_along_axis(top, order, 1), np.take_along_axis(s, order, 1)
        top[np.isinf(s)] = -1
        chosen = _choose(vectors, top, s, keep)
        rows, cols = np.nonzero(chosen >= 0)
        source.append(rows + a)
        target.append(chosen[rows, cols])
    source, target = np.concatenate(source), np.concatenate(target)
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    value = np.einsum("ij,ij->i", vectors[source], vectors[target])
    order = np.lexsort((-value, source))
    source, target, value = source[order], target[order], value[order]
    first = np.searchsorted(source, np.arange(n))
    place = np.arange(len(source)) - first[source]
    out = np.full((n, keep), -1, np.int32)
    width = max(width, keep)
    for a in range(0, n, STEP):
        b = min(a + STEP, n)
        lo, hi = first[a], first[b] if b < n else len(source)
        mine = slice(lo, hi)
        inside = place[mine] < width
        cand = np.full((b - a, width), -1, np.int64)
        sims = np.full((b - a, width), -np.inf, np.float32)
        cand[source[mine][inside] - a, place[mine][inside]] = target[mine][inside]
        sims[source[mine][inside] - a, place[mine][inside]] = value[mine][inside]
        few = (cand >= 0).sum(axis=1) <= keep
        out[a:b][few] = cand[few][:, :keep]
        if (~few).any():
            out[a:b][~few] = _choose(vectors, cand[~few], sims[~few], keep)
    return out


class Graph:
    """Nodes with their vectors (equal norm), and for each level the nodes on
    it and their flat neighbour array."""

    def __init__(self, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.levels = vectors, levels

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """The graph of one band's vectors."""
        n = len(vectors)
        v = np.ldexp(vectors, -np.frexp(np.abs(vectors).max())[1]).astype(np.float32)
        norm2 = np.einsum("ij,ij->i", v, v)
        v = np.concatenate([v, np.sqrt(np.maximum(norm2.max() - norm2, 0))[:, None]], 1)
        draw = np.random.default_rng(n).random(n)  # repeatable: a task that runs again builds the same
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(int), 8)
        levels = []
        for k in range(int(level.max()) + 1):
            nodes = np.flatnonzero(level >= k)
            local = _link(v[nodes], 2 * LINKS if k == 0 else LINKS)
            levels.append((nodes, np.where(local >= 0, nodes[local], -1).astype(np.int32)))
        return cls(v, levels)

    def search(self, queries: np.ndarray, ef: int) -> np.ndarray:
        """The nodes found for each query (rows; nearest first, -1: none)."""
        queries = _scaled(queries)[0].astype(np.float32) if len(queries) else queries
        find = self._search if len(self.vectors) > ef else self._all
        out = [find(queries[a:a + STEP], ef) for a in range(0, len(queries), STEP)]
        return np.concatenate(out) if out else np.zeros((0, ef), np.int64)

    def _all(self, q: np.ndarray, ef: int) -> np.ndarray:
        return np.argsort(-(q @ self.vectors[:, :-1].T), axis=1, kind="stable")

    def _search(self, q: np.ndarray, ef: int) -> np.ndarray:
        q = np.concatenate([q, np.zeros((len(q), 1), np.float32)], 1)
        each = np.arange(len(q))
        top = self.levels[-1][0]
        at = top[(q @ self.vectors[top].T).argmax(axis=1)]  # the top level is small
        for nodes, near in self.levels[-2:0:-1]:
            sim = np.einsum("ij,ij->i", q, self.vectors[at])
            while True:  # greedy: step on while a neighbour is nearer
                c = near[np.searchsorted(nodes, at)]
                s = np.where(c >= 0, np.einsum("ij,ikj->ik", q, self.vectors[c]), -np.inf)
                best = s.argmax(axis=1)
                better = s[each, best] > sim
                if not better.any():
                    break
                at = np.where(better, c[each, best], at)
                sim = np.where(better, s[each, best], sim)
        near = self.levels[0][1]
        n, width, spread = len(self.vectors), min(ef, len(self.vectors)), 4
        seen = np.zeros((len(q), n + 1), bool)  # the last column stands for "none"
        seen[:, n] = True
        seen[each, at] = True
        beam = np.full((len(q), width), n, np.int64)
        sims = np.full((len(q), width), -np.inf, np.float32)
        open_ = np.zeros((len(q), width), bool)
        beam[:, 0], sims[:, 0], open_[:, 0] = at, np.einsum("ij,ij->i", q, self.vectors[at]), True
        live = each
        while len(live):
            # the nearest of the beam that aren't expanded yet, a few at a time
            o = open_[live]
            rank = np.cumsum(o, axis=1)
            pick = o & (rank <= spread)
            r, c = np.nonzero(pick)
            open_[live[r], c] = False
            new = near[beam[live[r], c]].astype(np.int64)
            new = np.where(new < 0, n, new)
            grid = np.full((len(live), spread, near.shape[1]), n, np.int64)
            grid[r, rank[r, c] - 1] = new
            grid = np.sort(grid.reshape(len(live), -1), axis=1)
            grid[:, 1:][grid[:, 1:] == grid[:, :-1]] = n  # met twice
            grid[seen[live[:, None], grid]] = n
            rows, cols = np.nonzero(grid < n)
            seen[live[rows], grid[rows, cols]] = True
            s = np.full(grid.shape, -np.inf, np.float32)
            s[rows, cols] = np.einsum("ij,ij->i", q[live[rows]], self.vectors[grid[rows, cols]])
            all_sims = np.concatenate([sims[live], s], 1)
            order = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            order = np.take_along_axis(order, np.argsort(-np.take_along_axis(all_sims, order, 1), axis=1), 1)
            beam[live] = np.take_along_axis(np.concatenate([beam[live], grid], 1), order, 1)
            sims[live] = np.take_along_axis(all_sims, order, 1)
            is_new = np.concatenate([open_[live], grid < n], 1)
            open_[live] = np.take_along_axis(is_new, order, 1) & np.isfinite(sims[live])
            live = live[open_[live].any(axis=1)]
        return np.where(np.isfinite(sims), beam, -1)

    def pack(self) -> dict[str, bytes]:
        return {"nodes": b"".join(np.int64(len(x)).tobytes() + x.astype(np.int64).tobytes() for x, _ in self.levels),
                "near": b"".join(x.astype(np.int32).tobytes() for _, x in self.levels),
                "vectors": self.vectors.tobytes()}

    @classmethod
    def unpack(cls, packed: dict[str, bytes], dim: int) -> Graph:
        raw, near, at, used, levels = packed["nodes"], packed["near"], 0, 0, []
        while at < len(raw):
            n = int(np.frombuffer(raw, np.int64, 1, at)[0])
            nodes = np.frombuffer(raw, np.int64, n, at + 8)
            width = LINKS if levels else 2 * LINKS
            levels.append((nodes, np.frombuffer(near, np.int32, n * width, used).reshape(n, width)))
            at, used = at + 8 * (n + 1), used + 4 * n * width
        return cls(np.frombuffer(packed["vectors"], np.float32).reshape(-1, dim + 1), levels)


def _vectors(lists: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(lists.combine_chunks().flatten() if isinstance(lists, pa.ChunkedArray) else lists.flatten(),
                      np.float64).reshape(-1, dim)


def search(table: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20,
           ef: int = EF, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, ``key`` and score of the ``k`` nearest rows found for
    every row whose ``key`` is divisible by ``every``."""
    spark = table.sparkSession
    bounded_batches(spark)
    v = F.transform(column(vector), lambda x: x.cast("double"))
    rows = table.select(column(key).cast("long").alias("id"), v.alias("v")).where(
        "id is not null and v is not null and size(v) > 0"
        " and forall(v, x -> x is not null and not isnan(x) and abs(x) != double('infinity'))"
        " and exists(v, x -> x != 0)")
    rows = materialise(rows.select("id", "v", F.monotonically_increasing_id().alias("row")), "vectors")
    # a row per vector length: each length has graphs of its own, asked by its own queries
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % every == 0).alias("asked")).where("asked > 0").collect()
    schema = f"query_id long, rank int, {key} long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    shards = {r["dim"]: -(-r["n"] // shard_rows) for r in sizes}
    blocks = {r["dim"]: -(-r["asked"] // block_rows) for r in sizes}

    def of_dim(numbers: dict[int, int]):
        return F.element_at(F.create_map(*[F.lit(x) for item in numbers.items() for x in item]), F.col("dim"))
    rows = rows.withColumn("dim", F.size("v")).where(F.col("dim").isin(list(shards)))
    queries = rows.where(F.col("id") % every == 0)

    fields = ("nodes", "near", "vectors", "exact", "ids", "rows", "node")

    # one row per band of a shard: its graph, and ids and rows of each node's smallest ids
    def build(group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        ids, own = (np.asarray(group.column(c), np.int64) for c in ("id", "row"))
        vectors = _vectors(group.column("v"), dim) + 0.0  # no negative zero
        order = np.lexsort((own, ids))
        ids, own, vectors = ids[order], own[order], vectors[order]
        _, first, node = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
        node = node.reshape(-1)
        by = np.argsort(node, kind="stable")
        place = np.arange(len(by)) - np.searchsorted(node[by], node[by])
        by, place = by[place <= k], place[place <= k]  # k and the query's own
        vectors, ids, own, node = vectors[first], ids[by], own[by], node[by]
        bands, packed = _bands(vectors), []
        for band in np.unique(bands):
            nodes = np.flatnonzero(bands == band)
            its = bands[node] == band
            packed.append(Graph.build(vectors[nodes]).pack() | {
                "exact": vectors[nodes].tobytes(), "ids": ids[its].tobytes(), "rows": own[its].tobytes(),
                "node": np.searchsorted(nodes, node[its]).astype(np.int64).tobytes()})
        of = {c: pa.array([group.column(c)[0].as_py()] * len(packed), pa.int32()) for c in ("dim", "shard")}
        return pa.table({**of, **{c: pa.array([x[c] for x in packed], pa.binary()) for c in fields}})

    index_schema = "dim int, shard int, " + ", ".join(f"{c} binary" for c in fields)
    shard = F.pmod(F.xxhash64("row"), of_dim(shards)).cast("int")
    index = materialise(rows.withColumn("shard", shard).groupBy("dim", "shard").applyInArrow(build, index_schema),
                        "index")

    def block_of(group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        return pa.table({"dim": group.column("dim")[:1], "block": group.column("block")[:1],
                         "q_ids": pa.array([np.asarray(group.column("id"), np.int64).tobytes()], pa.binary()),
                         "q_rows": pa.array([np.asarray(group.column("row"), np.int64).tobytes()], pa.binary()),
                         "q": pa.array([_vectors(group.column("v"), dim).tobytes()], pa.binary())})

    block = F.pmod(F.xxhash64("row", F.lit(1)), of_dim(blocks)).cast("int")
    packed = materialise(queries.withColumn("block", block).groupBy("dim", "block").applyInArrow(
        block_of, "dim int, block int, q_ids binary, q_rows binary, q binary"), "queries")
    # a stated query set against all shards of its length, block by block
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), of_dim(blocks) - 1)))
    right = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), of_dim(shards) - 1)))

    def find(shard_of: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], []]
        for s in shard_of.to_pylist():
            dim = s["dim"]
            graph = Graph.unpack(s, dim)
            exact = np.frombuffer(s["exact"], np.float64).reshape(-1, dim)
            ids, own, node = (np.frombuffer(s[c], np.int64) for c in ("ids", "rows", "node"))
            for b in asked.to_pylist():
                q = np.frombuffer(b["q"], np.float64).reshape(-1, dim)
                hits = graph.search(q, max(ef, k + 1))
                for q_row, q_id, x, h in zip(np.frombuffer(b["q_rows"], np.int64).tolist(),
                                             np.frombuffer(b["q_ids"], np.int64).tolist(), q, hits):
                    h = h[h >= 0]
                    score = _scores(exact[h], x)
                    lo, hi = np.searchsorted(node, h), np.searchsorted(node, h, "right")
                    many = hi - lo
                    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
                    score = np.repeat(score, many)
                    other = own[at] != q_row
                    at, score = at[other], score[other]
                    best = np.lexsort((own[at], ids[at], -score))[:k]
                    found[0] += [(q_row, q_id)] * len(best)
                    found[1] += ids[at[best]].tolist()
                    found[2] += own[at[best]].tolist()
                    found[3] += score[best].tolist()
        return pa.table({"q_row": pa.array([a for a, _ in found[0]], pa.int64()),
                         "query_id": pa.array([b for _, b in found[0]], pa.int64()),
                         "id": pa.array(found[1], pa.int64()), "row": pa.array(found[2], pa.int64()),
                         "score": pa.array(found[3], pa.float64())})

    at = ("dim", "shard", "block")
    found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(
        find, "q_row long, query_id long, id long, row long, score double")
    w = Window.partitionBy("q_row").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score")
