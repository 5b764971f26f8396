"""Near-duplicate vectors by int8 tile products with error bounds (operator 11).

1. Vectors of equal components are one *class* (a 128-bit hash of them).
2. Each class is scaled to length one and quantised to int8 components. With
   u = s*q + e (s the scale, q the integers) and |e| <= err,
   u.w differs from s_u*s_w*(q_u.q_w) by at most err_u + err_w + err_u*err_w,
   so the integer product bounds the cosine from both sides.
3. A bounded number of classes (those of the least hashes) serve as pivots;
   a class resides in the cell of its nearest pivot, and visits those cells
   that may hold a partner: a unit vector at height a above the plane between
   two pivots has cosine sqrt(1 - a^2) at most with what lies below it. A pair
   of two cells is looked at in one of them, chosen by the parity of their
   numbers. Cells, and their visitors, are cut into blocks, and every block of
   residents meets every block of residents and of visitors in a tile of its
   own, so no task holds more than two blocks however many vectors look alike.
4. A tile multiplies the integers and keeps the classes with a pair that the
   bound leaves possible. Their vectors are joined to the tile again, only the
   possible pairs are computed in double precision, and the tile writes the
   link counts of its classes and a spanning forest of its links.
5. Counts are summed; large-star and small-star steps over the forests give
   the components.

All pairs that a pivot plane does not part are multiplied: the work is exact
and grows with the square of what lies close together (of the whole table if
its vectors have no clusters); nothing else does.

Defined cases: a vector that is NULL, empty or zero, or holds NULL, NaN or
infinite components links with nothing and is a component of its own; vectors
of different lengths never link; scale does not matter (components are first
multiplied by a power of two, so very large and very small ones neither
overflow nor vanish); repeated rows are vectors of their own that link with
each other; a row with NULL id counts as a link but names no component, and
is always kept; ties are broken by the smallest id; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import stage
from tickroll.llm.components import components

THRESHOLD = 0.95
CELL = 4096                    # classes of a cell on average
BLOCK = 4096                   # classes of a block
PIVOT_VALUES = 1 << 20         # components of all pivots together (8 MB in each task)
SLACK = 1e-9                   # added to every bound: far above the rounding of doubles
CHUNK = 512                    # rows of a tile multiplied at once
EXACT = 1 << 10                # dimensions whose int8 products float32 sums exactly (127^2 * 1024 < 2^24)

CLASSES = "vec_id long, fp binary, v binary"
PLACED = "fp binary, cell long, visits array<long>, q binary, scale double, err double"
TILE = ["cell", "a", "b"]


def usable(values: pa.ListArray) -> list[np.ndarray | None]:
    """The vectors as doubles of a common power of two; None for those that link with nothing."""
    if not len(values):
        return []
    flat = values.flatten()
    bad = np.zeros(len(flat) + 1, np.int64)
    x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    bad[1:] = np.cumsum(~np.isfinite(x))
    sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    found: list[np.ndarray | None] = []
    for start, end in zip(ends - sizes, ends):
        v = x[start:end]
        most = np.abs(v).max() if end > start and bad[end] == bad[start] else 0.0
        found.append(np.ldexp(v, -int(np.frexp(most)[1])) + 0.0 if most else None)
    return found


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 components, scales and error norms (rounded up) of unit vectors (rows)."""
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None])
    err = np.linalg.norm(u - q * scale[:, None], axis=1) + SLACK
    return q.astype(np.int8), scale, err


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer products of all rows, exact (float32 up to 1,024 dimensions, sums of such beyond)."""
    if left.shape[1] <= EXACT:
        return left.astype(np.float32) @ right.astype(np.float32).T
    total = np.zeros((len(left), len(right)))
    for d in range(0, left.shape[1], EXACT):
        total += left[:, d:d + EXACT].astype(np.float32) @ right[:, d:d + EXACT].astype(np.float32).T
    return total


def possible(left, right, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of ``left`` and ``right`` (each q, scale, err) whose cosine may reach the threshold."""
    (q, scale, err), (q2, scale2, err2) = left, right
    widest, largest = err2.max(), scale2.max()
    for at in range(0, len(q), CHUNK):
        here = slice(at, at + CHUNK)
        p = product(q[here], q2)
        least = (threshold - err[here] - widest - err[here] * widest) / scale[here]
        least = np.where(least > 0, least / largest, least / scale2.min()) - 1      # a first sieve, below every bound
        i, j = np.nonzero(p >= least.astype(p.dtype)[:, None])
        if len(i):
            bound = scale[at + i] * scale2[j] * p[i, j] + err[at + i] + err2[j] + err[at + i] * err2[j]
            keep = bound >= threshold - SLACK
            yield at + i[keep], j[keep]


def _classes(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = usable(batch.column("v"))
            said = [None if v is None else v.tobytes() for v in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), pa.array([None if s is None else xxhash.xxh3_128_digest(s) for s in said], pa.binary()),
                 pa.array(said, pa.binary())], names=["vec_id", "fp", "v"])

    rows = vectors.select(F.col(vec_id).cast("long").alias("d"), F.col(vector).cast("array<double>").alias("v"))
    return stage(rows.mapInArrow(run, CLASSES), "vectors-read")


def _units(rows: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    return v / np.linalg.norm(v, axis=1)[:, None]


def _by_length(rows: list[bytes]) -> Iterator[np.ndarray]:
    """Positions of the rows of each length."""
    sizes = np.array([len(r) for r in rows])
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def _place(classes: DataFrame, threshold: float) -> DataFrame:
    """Quantised classes with their cells and the cells that they visit."""
    n = classes.count()
    width = classes.agg(F.max(F.length("v"))).first()[0] or 8
    k = max(1, min(-(-n // CELL), PIVOT_VALUES * 8 // width))
    # one unit vector per pivot, by dimension: at most PIVOT_VALUES numbers
    chosen = [r["v"] for r in classes.orderBy("fp").limit(k).select("v").collect()]
    pivots, first = {}, 0
    for where in _by_length(chosen):
        pivots[len(chosen[where[0]])] = (first, _units([bytes(chosen[i]) for i in where]))
        first += len(where)
    height = np.sqrt(max(0.0, 1 - threshold * threshold)) if threshold > 0 else np.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                rows = part.column("v").to_pylist()
                for where in _by_length(rows):
                    u = _units([rows[i] for i in where])
                    q, scale, err = quantise(u)
                    if len(rows[where[0]]) in pivots:
                        base, p = pivots[len(rows[where[0]])]
                        near = u @ p.T
                        own = near.argmax(axis=1)
                        apart = np.sqrt(np.maximum(0, 2 - 2 * (p[own] @ p.T)) + SLACK)
                        over = near[np.arange(len(u)), own][:, None] - near
                        other = np.arange(len(p))[None, :]
                        goes = (own[:, None] < other) == ((own[:, None] + other) % 2 == 0)
                        goes &= (over <= height * apart + SLACK) & (other != own[:, None])
                        visits = [(base + np.flatnonzero(g)).tolist() for g in goes]
                        own = own + base
                    else:                      # no pivot of this length: one cell for all of them
                        own, visits = np.full(len(u), -len(rows[where[0]])), [[]] * len(u)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("fp").take(pa.array(where)), pa.array(own, pa.int64()), pa.array(visits, pa.list_(pa.int64())),
                         pa.array([x.tobytes() for x in q], pa.binary()), pa.array(scale), pa.array(err)],
                        names=["fp", "cell", "visits", "q", "scale", "err"])

    return stage(classes.select("fp", "v").mapInArrow(run, PLACED), "vectors-placed")


def _tiles(placed: DataFrame) -> DataFrame:
    """A row for each tile (cell, a, b) that a class takes part in, with its ``own`` block there."""
    values = ["fp", "q", "scale", "err"]
    residents = placed.select("cell", *values)
    visitors = placed.select(F.explode("visits").alias("cell"), *values)
    size = residents.groupBy("cell").agg(F.count(F.lit(1)).alias("r"))
    seen = visitors.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    blocks = stage(size.join(seen, "cell", "left").select(
        "cell", F.ceil(F.col("r") / BLOCK).cast("int").alias("rb"),
        F.ceil(F.coalesce("n", F.lit(0)) / BLOCK).cast("int").alias("vb")), "vectors-blocks")
    deal = lambda n: F.pmod(F.xxhash64("fp", "cell"), n).cast("int")
    home = (residents.join(blocks, "cell").withColumn("own", deal(F.col("rb")))
            .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("rb") + F.col("vb") - 1)))
            .select("cell", F.least("own", "_o").alias("a"), F.greatest("own", "_o").alias("b"), "own", *values))
    away = (visitors.join(blocks, "cell").withColumn("own", F.col("rb") + deal(F.col("vb")))
            .withColumn("a", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)))
            .select("cell", "a", F.col("own").alias("b"), "own", *values))
    return home.unionByName(away)


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two blocks of a tile, and whether they are the same."""
    own, a, b = t["own"].to_numpy(), t["a"][0].as_py(), t["b"][0].as_py()
    return np.flatnonzero(own == a), np.flatnonzero(own == b), a == b


def _meetings(tiles: DataFrame, threshold: float) -> DataFrame:
    """The classes of each tile that have a possible pair there."""
    def look(t: pa.Table) -> pa.Table:
        x, y, same = _sides(t)
        keep = np.zeros(t.num_rows, bool)
        if len(x) and len(y):
            q = np.frombuffer(b"".join(t["q"].to_pylist()), np.int8).reshape(t.num_rows, -1)
            scale, err = t["scale"].to_numpy(), t["err"].to_numpy()
            for i, j in possible((q[x], scale[x], err[x]), (q[y], scale[y], err[y]), threshold):
                if same:
                    i, j = i[i != j], j[i != j]
                keep[x[i]] = keep[y[j]] = True
        return t.select([*TILE, "own", "fp"]).filter(pa.array(keep))

    return stage(tiles.groupBy(*TILE).applyInArrow(look, "cell long, a int, b int, own int, fp binary"), "vectors-meetings")


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links of a tile."""
    unseen, edges = np.ones(len(linked), bool), []
    for root in np.flatnonzero(linked.any(axis=1)):
        todo = [int(root)] if unseen[root] else []
        unseen[root] = False
        while todo:
            at = todo.pop()
            new = np.flatnonzero(linked[at] & unseen)
            unseen[new] = False
            edges += [(at, int(x)) for x in new]
            todo += new.tolist()
    return edges


def _links(meetings: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of each tile: (a, links), the vectors that a class links with there, and (a, b), a spanning forest of the links."""
    def confirm(t: pa.Table) -> pa.Table:
        x, y, same = _sides(t)
        v = np.frombuffer(b"".join(t["v"].to_pylist()), np.float64).reshape(t.num_rows, -1)
        norm, size = np.linalg.norm(v, axis=1), t["size"].to_numpy()
        q, scale, err = quantise(v / norm[:, None])
        linked = np.zeros((t.num_rows, t.num_rows), bool)
        for i, j in possible((q[x], scale[x], err[x]), (q[y], scale[y], err[y]), threshold):
            cuts = np.flatnonzero(np.diff(i)) + 1
            for mine, others in zip(np.split(i, cuts), np.split(j, cuts)):      # the possible partners of one row
                if len(mine):
                    r, c = x[mine[0]], y[others]
                    linked[r, c[(v[c] @ v[r]) / (norm[c] * norm[r]) >= threshold]] = True
        linked |= linked.T
        np.fill_diagonal(linked, False)
        edges = _forest(linked)
        links = linked @ size
        some = np.flatnonzero(links)
        fp = t["fp"].to_pylist()
        return pa.table({"a": pa.array([fp[i] for i in some] + [fp[i] for i, _ in edges], pa.binary()),
                         "b": pa.array([None] * len(some) + [fp[j] for _, j in edges], pa.binary()),
                         "links": pa.array(links[some].tolist() + [0] * len(edges), pa.int64())})

    rows = meetings.join(classes.select("fp", "v", "size"), "fp").select(*TILE, "own", "fp", "v", "size")
    return stage(rows.groupBy(*TILE).applyInArrow(confirm, "a binary, b binary, links long"), "vectors-links")


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other vectors at a cosine of at least ``threshold``;
    ``component_id`` is the smallest id that links reach, the vector's own
    included; ``kept`` marks the vector of that id.
    """
    rows = _classes(vectors, vec_id, vector)
    classes = stage(rows.filter("fp is not null").groupBy("fp").agg(
        F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("first"), F.first("v").alias("v")), "vectors-classes")
    found = _links(_meetings(_tiles(_place(classes, threshold)), threshold), classes, threshold)
    counts = found.groupBy(F.col("a").alias("fp")).agg(F.sum("links").alias("links"))
    members = components(found.filter("b is not null").select("a", "b"), "a", "b")
    named = members.join(classes.select(F.col("fp").alias("node"), "first"), "node")
    roots = named.groupBy("root").agg(F.min("first").alias("least"))
    named = named.join(roots, "root").select(F.col("node").alias("fp"), "least")
    # written before the join: a class of very many copies is then split by Spark
    named = stage(classes.select("fp", "size", "first").join(counts, "fp", "left").join(named, "fp", "left").select(
        "fp", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("least", "first").alias("component_id")), "vectors-named")
    out = rows.select("vec_id", "fp").join(named, "fp", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("fp").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
