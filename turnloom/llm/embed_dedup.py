"""Embedding near-dedup by NN-descent.

Nodes are distinct vectors (copies cost one node). The neighbour graph starts from
sorted signatures: the signs of a vector along ``PLANES`` random directions, compared
from the first to the last, order the vectors of a label like the leaves of a random
tree, as deep as the label needs; the order is cut into runs, a few times with other
directions, by a range shuffle, so that no label, however large, is one task.
Then neighbours-of-neighbours joins refine it: every vector's neighbour list, with the
vectors, meets in one row (lists are bounded, long reverse lists are dealt into rows of
``LIST`` by salt), all pairs in the row are compared, and each vector keeps its best;
only pairs that beat the last place of a list, and links, leave the row.

Saturation: a vector whose whole list passes the threshold may have more links than the
list can hold. Its list is enlarged to its whole component of threshold links, compared
in tiles of ``TILE`` vectors; only counts leave a tile, never the pairs.

The rest: a link that no row compared is still missing if both its lists are full of
links. So the vectors are dealt into cells (a vector joins the smallest of the vectors it
is linked to, twice, which stays in its component), and each cell that holds a full list is
set against the cells of all other components: angles obey the triangle inequality, so two
cells whose centres are further apart than both radii and the threshold's angle hold no
link. What remains is compared vector by vector, in tiles. This is exact; if the audit is
still missed after the last round, every cell counts as full.

Audit: a bounded sample of vectors is compared with all vectors; while the share of
their links that the graph holds is under ``min_recall``, or threshold links still
appear, refinement goes on. Only links with a cosine of at least the threshold, in
double precision, are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import ship_by_value
from .common import append_columns, connected_components, drop_table, write_table

ship_by_value(__name__)

LIST = 10
PROJECTIONS = 6
PLANES = 48
RUN = 48
TILE = 512
ROUNDS = 8
CELLS = 2048
SLACK = 1e-6  # radians: more than rounding moves an angle
AUDIT = 256
MIN_RECALL = 0.99


_VALID = (
    "label IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0 AND exists(vec, x -> x <> 0)"
    " AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
)


def _unit(vector: list) -> np.ndarray:
    x = np.array(vector, np.float64)
    x /= np.abs(x).max()  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum())


def _matrix(col: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(v.as_buffer(), "<f8") for v in col]) if len(col) else np.zeros((0, 0))


def _nodes(rows: DataFrame) -> DataFrame:
    """Distinct valid vectors ``(label, h1, h2, copies, low, node, grp, unit)``."""
    one = rows.where("ok").groupBy("label", "h1", "h2").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("low"))
    one = one.withColumn("node", F.monotonically_increasing_id()).withColumn("grp", F.xxhash64("label", F.size("vec")))

    def run(vec: pa.Array) -> list[pa.Array]:
        return [pa.array([_unit(v).astype("<f8").tobytes() for v in vec.to_pylist()], pa.binary())]

    return append_columns(one, ["vec"], [T.StructField("unit", T.BinaryType())], run).drop("vec")


def _best(pairs: DataFrame, size: int) -> DataFrame:
    """Each node's ``size`` most similar partners: ``(u, list of (s, v))``."""
    pairs = pairs.distinct()
    w = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    return pairs.withColumn("r", F.row_number().over(w)).where(F.col("r") <= size).drop("r")


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Places of links that span what the links (i, j) connect."""
    root, out = list(range(n)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for at, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = find(a), find(b)
        if a != b:
            root[b] = a
            out.append(at)
    return out


def _top_pairs(node: np.ndarray, unit: np.ndarray, k: int, threshold: float, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node its k best partners among the others (those better than ``last``), and
    spanning links of the pairs that pass the threshold."""
    n = len(node)
    if n < 2:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    sim = unit @ unit.T
    np.fill_diagonal(sim, -2)
    sim[node[:, None] == node[None, :]] = -2  # a node may stand in a row twice
    k = min(k, n - 1)
    at = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    u, v = np.repeat(np.arange(n), k), at.ravel()
    if last is not None:
        better = sim[u, v] > last[u]
        u, v = u[better], v[better]
    i, j = np.nonzero(np.triu(sim >= threshold, 1))
    tree = _forest(n, i, j)
    u, v = np.concatenate([u, i[tree]]), np.concatenate([v, j[tree]])
    s = sim[u, v]
    ok = s > -2
    return node[u[ok]], node[v[ok]], s[ok]


def _start(nodes: DataFrame, k: int, threshold: float, projections: int, seed: int) -> DataFrame:
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit = [np.frombuffer(v.as_buffer(), "<f8") for v in b.column(2)]
            size = np.array([len(x) for x in unit])
            for t in range(projections):
                key = np.zeros(len(unit), np.int64)
                for d in np.unique(size):
                    planes = np.random.default_rng([seed, t, int(d)]).standard_normal((d, PLANES))
                    at = np.flatnonzero(size == d)
                    key[at] = (np.stack([unit[i] for i in at]) @ planes > 0) @ (1 << np.arange(PLANES)[::-1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, t, np.int32)), b.column(1), pa.array(key), b.column(0), b.column(2)], ["t", "grp", "p", "node", "unit"])

    rows = nodes.select("node", "grp", "unit").mapInArrow(project, "t int, grp long, p long, node long, unit binary")
    rows = rows.repartitionByRange("t", "grp", "p", "node").sortWithinPartitions("t", "grp", "p", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def out(run: list) -> pa.RecordBatch:
            u, v, s = _top_pairs(np.array([r[0] for r in run]), np.stack([r[1] for r in run]), k, threshold)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s)], ["u", "v", "s"])

        for b in batches:
            for t, g, n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4)):
                if (t, g) != key or len(held) == RUN:
                    if len(held) > 1:
                        yield out(held)
                    held = held[RUN // 2 :] if (t, g) == key else []  # runs overlap by half
                    key = (t, g)
                held.append((n, np.frombuffer(x.as_buffer(), "<f8")))
        if len(held) > 1:
            yield out(held)

    return rows.mapInArrow(compare, "u long, v long, s double")


def _refine(graph: DataFrame, nodes: DataFrame, k: int, threshold: float) -> DataFrame:
    """One round: all pairs among each node's list, both ways, are compared."""
    both = graph.select("u", "v").unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    # a hub's reverse list is dealt into rows of about 2 * LIST members
    deg = both.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    dealt = both.join(deg, "u").withColumn("salt", F.pmod(F.xxhash64("u", "v"), F.ceil(F.col("n") / (2 * k))).cast("int"))
    salts = deg.select("u", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / (2 * k)) - 1).cast("int"))).alias("salt"))
    members = dealt.select("u", "salt", F.col("v").alias("node")).unionByName(salts.select("u", "salt", F.col("u").alias("node")))
    last = graph.groupBy(F.col("u").alias("node")).agg(F.when(F.count(F.lit(1)) >= k, F.min("s")).otherwise(F.lit(-2.0)).alias("last"))
    known = nodes.select("node", "unit").join(last, "node", "left").select("node", "unit", F.coalesce("last", F.lit(-2.0)).alias("last"))
    rows = members.join(known, "node").repartition("u", "salt").sortWithinPartitions("u", "salt").select("u", "salt", "node", "unit", "last")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def out(run: list) -> pa.RecordBatch:
            u, v, s = _top_pairs(np.array([r[0] for r in run]), np.stack([r[1] for r in run]), k, threshold, np.array([r[2] for r in run]))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s)], ["u", "v", "s"])

        for b in batches:
            for u, salt, n, last, x in zip(*[b.column(i).to_pylist() for i in (0, 1, 2, 4)], b.column(3)):
                if (u, salt) != key:
                    if len(held) > 2:
                        yield out(held)
                    held, key = [], (u, salt)
                held.append((n, np.frombuffer(x.as_buffer(), "<f8"), last))
        if len(held) > 2:
            yield out(held)

    return rows.mapInArrow(compare, "u long, v long, s double")


def _cells(graph: DataFrame, nodes: DataFrame, comp: DataFrame, threshold: float, k: int, everything: bool) -> DataFrame:
    """``(node, cell, component, full)``: a cell lies in one component and within two links
    of its centre, the vector ``cell``; ``full``: the node's list holds ``k`` links."""
    links = graph.where(F.col("s") >= threshold)
    near = links.select("u", "v").unionByName(nodes.select(F.col("node").alias("u"), F.col("node").alias("v")))
    lead = near.groupBy("u").agg(F.min(F.struct(F.xxhash64("v").alias("h"), "v"))["v"].alias("lead"))
    cell = lead.join(lead.select(F.col("u").alias("lead"), F.col("lead").alias("cell")), "lead").select(F.col("u").alias("node"), "cell")
    full = links.groupBy(F.col("u").alias("node")).agg((F.count(F.lit(1)) >= k).alias("full"))
    out = cell.join(comp, "node", "left").join(full, "node", "left")
    return out.select("node", "cell", F.coalesce("component", "node").alias("component"), (F.coalesce("full", F.lit(False)) | F.lit(everything)).alias("full"))


def _near_cells(nodes: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: pairs of cells of different components, one at least with a full list,
    that may hold a link."""
    units = nodes.select(F.col("node").alias("cell"), F.col("unit").alias("centre"))
    rows = cells.join(nodes.select("node", "grp", "unit"), "node").join(units, "cell")

    def angle(unit: pa.Array, centre: pa.Array) -> list[pa.Array]:
        got = [np.frombuffer(a.as_buffer(), "<f8") @ np.frombuffer(b.as_buffer(), "<f8") for a, b in zip(unit, centre)]
        return [pa.array(np.arccos(np.clip(np.array(got, np.float64), -1, 1)))]

    rows = append_columns(rows, ["unit", "centre"], [T.StructField("angle", T.DoubleType())], angle)
    balls = rows.groupBy("grp", "cell", "component").agg(F.max("full").alias("full"), F.max("angle").alias("radius")).join(units, "cell")
    balls = write_table(balls.select("grp", "cell", "component", "full", "radius", "centre"), "embed-cells")
    sizes = balls.groupBy("grp").agg(F.ceil(F.count_if("full") / CELLS).cast("int").alias("n_full"), F.ceil(F.count(F.lit(1)) / CELLS).cast("int").alias("n_all")).where("n_full > 0")
    dealt = balls.join(sizes, "grp").withColumn("h", F.xxhash64("cell"))
    left = dealt.where("full").withColumn("i", F.pmod("h", F.col("n_full")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)))
    right = dealt.withColumn("j", F.pmod("h", F.col("n_all")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_full") - 1)))
    out = ["grp", "i", "j", "side", "cell", "component", "full", "radius", "centre"]
    blocks = left.withColumn("side", F.lit(0)).select(*out).unionByName(right.withColumn("side", F.lit(1)).select(*out))
    blocks = blocks.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "side")
    reach = float(np.arccos(min(max(threshold, -1.0), 1.0))) + SLACK

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        key = None

        def out() -> Iterator[pa.RecordBatch]:
            side, cell, comp, full, radius = (np.array([r[x] for r in held]) for x in range(5))
            unit = np.stack([r[5] for r in held])
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            for at in range(0, len(a), 256):
                x = a[at : at + 256]
                bound = np.cos(np.minimum(radius[x][:, None] + radius[b] + reach, np.pi)) - 1e-12
                near = (unit[x] @ unit[b].T >= bound) & (comp[x][:, None] != comp[b])
                near &= ~full[b] | (cell[x][:, None] < cell[b])  # two full cells meet twice
                i, j = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([pa.array(cell[x][i]), pa.array(cell[b][j])], ["a", "b"])

        for b in batches:
            c = [b.column(i).to_pylist() for i in range(8)]
            for g, i, j, side, cell, comp, full, radius, x in zip(*c, b.column(8)):
                if (g, i, j) != key:
                    if held:
                        yield from out()
                    held, key = [], (g, i, j)
                held.append((side, cell, comp, full, radius, np.frombuffer(x.as_buffer(), "<f8")))
        if held:
            yield from out()

    return blocks.mapInArrow(compare, "a long, b long")


def _rest(graph: DataFrame, nodes: DataFrame, comp: DataFrame, threshold: float, k: int, everything: bool) -> DataFrame | None:
    """Links ``(u, v)`` between components that full lists kept out, enough to join the
    components; None: no list is full."""
    cells = write_table(_cells(graph, nodes, comp, threshold, k, everything), "embed-in-cell")
    if not cells.where("full").limit(1).count():
        return None
    pairs = write_table(_near_cells(nodes, cells, threshold), "embed-near-cells")
    parts = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"))
    members = cells.join(parts, "cell").join(nodes.select("node", "unit"), "node").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))

    def side(name: str, own: str, other: str) -> DataFrame:
        """The members of each pair's cell ``name``, once for each part of its other cell."""
        many = parts.select(F.col("cell").alias("_of"), F.col("parts").alias("_many"))
        met = pairs.join(many, pairs["b" if name == "a" else "a"] == many["_of"]).drop("_of")
        got = met.join(members.withColumnRenamed("cell", name), name)
        got = got.withColumn(own, F.col("part")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_many") - 1)))
        return got.select("a", "b", "i", "j", F.lit(name == "b").alias("second"), "node", "unit")

    tiles = side("a", "i", "j").unionByName(side("b", "j", "i")).repartition("a", "b", "i", "j").sortWithinPartitions("a", "b", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        key = None

        def out() -> Iterator[pa.RecordBatch]:
            second, node = np.array([r[0] for r in held]), np.array([r[1] for r in held])
            unit = np.stack([r[2] for r in held])
            near = unit[~second] @ unit[second].T >= threshold
            if near.any():  # a cell is in one component: one link joins them
                i, j = np.unravel_index(near.argmax(), near.shape)
                yield pa.RecordBatch.from_arrays([pa.array(node[~second][[i]]), pa.array(node[second][[j]])], ["u", "v"])

        for b in batches:
            c = [b.column(i).to_pylist() for i in range(6)]
            for p, q, i, j, second, node, x in zip(*c, b.column(6)):
                if (p, q, i, j) != key:
                    if held:
                        yield from out()
                    held, key = [], (p, q, i, j)
                held.append((second, node, np.frombuffer(x.as_buffer(), "<f8")))
        if held:
            yield from out()

    return write_table(tiles.mapInArrow(compare, "u long, v long"), "embed-rest")


def _tile_counts(nodes: DataFrame, comp: DataFrame, threshold: float) -> DataFrame:
    """``(node, linked)``: other vectors (copies counted) linked to each node of a component."""
    members = comp.join(nodes.select("node", "copies", "unit"), "node")
    sizes = comp.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"))
    members = members.join(sizes, "component").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    tiles = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = tiles.select("component", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "copies", "unit")
    tiles = tiles.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "part")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        key = None

        def out() -> pa.RecordBatch:
            part, node, copies = (np.array([r[x] for r in held]) for x in range(3))
            unit = np.stack([r[3] for r in held])
            first = part == key[1]
            a, b = (np.flatnonzero(first), np.flatnonzero(~first)) if key[1] != key[2] else (np.flatnonzero(first),) * 2
            near = unit[a] @ unit[b].T >= threshold
            if key[1] == key[2]:
                np.fill_diagonal(near, False)
                got = [(node[a], near @ copies[b])]
            else:
                got = [(node[a], near @ copies[b]), (node[b], near.T @ copies[a])]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([g[0] for g in got])), pa.array(np.concatenate([g[1] for g in got]).astype(np.int64))], ["node", "n"])

        for b in batches:
            c = [b.column(i).to_pylist() for i in range(6)]
            for comp_, i, j, part, node, copies, x in zip(*c, b.column(6)):
                if (comp_, i, j) != key:
                    if held:
                        yield out()
                    held, key = [], (comp_, i, j)
                held.append((part, node, copies, np.frombuffer(x.as_buffer(), "<f8")))
        if held:
            yield out()

    return tiles.mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("linked"))


def _audit(nodes: DataFrame, threshold: float, size: int) -> tuple[DataFrame, int]:
    """Links of a bounded hash sample of nodes, found by comparing them with every node:
    ``(u, v)``, and their number. One narrow pass; the sample is at most ``size`` vectors."""
    sample = nodes.select("node", "grp", "unit").orderBy(F.xxhash64("node", F.lit(7))).limit(size).collect()
    by_group: dict[int, list] = {}
    for r in sample:
        by_group.setdefault(r["grp"], []).append((r["node"], np.frombuffer(bytes(r["unit"]), "<f8")))
    packed = nodes.sparkSession.sparkContext.broadcast({g: (np.array([n for n, _ in v]), np.stack([x for _, x in v])) for g, v in by_group.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grp, node = b.column(1).to_numpy(), b.column(0).to_numpy()
            us, vs = [], []
            for g in np.unique(grp):
                if int(g) in packed.value:
                    names, units = packed.value[int(g)]
                    at = np.flatnonzero(grp == g)
                    q, r = np.nonzero(units @ _matrix(b.column(2).take(pa.array(at))).T >= threshold)
                    other = names[q] != node[at[r]]
                    us.append(names[q][other]), vs.append(node[at[r]][other])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    found = write_table(nodes.select("node", "grp", "unit").mapInArrow(run, "u long, v long"), "embed-audit")
    return found, found.count()


def near_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    size: int = LIST,
    projections: int = PROJECTIONS,
    rounds: int = ROUNDS,
    min_recall: float = MIN_RECALL,
    seed: int = 17,
) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links``, ``component_id``, ``kept``.

    Vectors are compared only with those of an equal, non-NULL label and equal length.
    NULL, empty, zero or non-finite vectors and those with a NULL component link with
    nothing and are their own component. Copies link with each other and share their
    links. Repeated ids keep their rows; a NULL id names a component only if no other id is in
    it. No rows give no rows.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.hash("vec", F.lit(1))).withColumn("ok", F.expr(f"coalesce({_VALID}, false)"))
    nodes = write_table(_nodes(rows), "embed-nodes")
    audit, n_audit = _audit(nodes, threshold, AUDIT)
    graph = write_table(_best(_start(nodes, size, threshold, projections, seed), size), "embed-graph")
    links, before = graph.where(F.col("s") >= threshold).select("u", "v"), -1
    for turn in range(rounds + 1):
        comp = write_table(connected_components(links, "embed-cc"), "embed-comp")
        joined = comp.where("node <> component").count()
        held = audit.join(comp.select(F.col("node").alias("u"), F.col("component").alias("cu")), "u").join(
            comp.select(F.col("node").alias("v"), F.col("component").alias("cv")), "v").where("cu = cv").count()
        met = joined == before and held >= min_recall * n_audit
        if met or turn == rounds:
            break
        before = joined
        more = write_table(_refine(graph, nodes, size, threshold), "embed-more")
        passed = links.unionByName(more.where(F.col("s") >= threshold).select("u", "v"))
        links = write_table(passed.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "embed-links")
        graph = write_table(_best(graph.unionByName(more), size), "embed-graph")
        drop_table(more)
    rest = _rest(graph, nodes, comp, threshold, size, not met)
    if rest is not None and rest.limit(1).count():
        comp = write_table(connected_components(links.unionByName(rest), "embed-cc"), "embed-comp")
    counts = _tile_counts(nodes, comp, threshold)
    named = nodes.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    known = named.join(lows, "component").join(counts, "node", "left").select(
        F.lit(True).alias("ok"), "label", "h1", "h2", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.drop("vec").join(known, ["ok", "label", "h1", "h2"], "left")
    name = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        name.alias("component_id"),
        F.col("id").eqNullSafe(name).alias("kept"),
    )
