"""A Gini forest grown and applied by Spark, kept as a table of tree parts instead of in the driver.

Each feature is cut into bins once. While a node holds more rows than ``part_rows``, its splits are
found from class counts by bin, summed over all rows; below that its rows are shuffled to one task,
which grows the rest of that tree: a part. A tree is its top (part 0) and the parts the top leads to.
Rows are scored by sending them to the parts they reach. So neither growing nor scoring needs more of
the forest in one place than a part and the tops.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.session import arrow_schema, fresh_path, local_rows, stage

# Rows of one side of a scoring task; bytes that growing a part may take for each of its rows.
SLAB_ROWS, ROW_BYTES = 1 << 20, 512

# A part: per node the feature (-1: leaf), the last bin that goes left, the row of ``masks`` that
# holds the categories that go left (-1: by the bin), the children (0: none) and the rows by class.
ARRAYS = {"feature": np.int32, "cut": np.int32, "mask": np.int32, "left": np.int32, "right": np.int32,
          "ref": np.int32, "n0": np.int64, "n1": np.int64}
PART = "tree int, part int, n_nodes int, masks binary, taken array<double>, " + ", ".join(f"{c} binary" for c in ARRAYS)
NODE = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>,
rawCount: bigint, gain: double, leftChild: int, rightChild: int,
split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"""


class Grid:
    """The bins of each slot: ``arity`` categories, or 0 and the ascending ``edges``; a value is left
    of an edge when it is at most that."""

    def __init__(self, arity: list[int], edges: list[list[float]]):
        self.arity, self.edges = list(arity), [list(e) for e in edges]
        self.size = max((a or len(e) + 1 for a, e in zip(arity, edges)), default=1)
        self.type = np.uint8 if self.size < 256 else np.uint16 if self.size < 65536 else np.int32
        self.width = (max((a for a in arity if a > 2), default=0) + 7) // 8

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, self.type)
        for f, (arity, edges) in enumerate(zip(self.arity, self.edges)):
            # A category that was not known takes the spare bin, which never goes left.
            out[:, f] = np.where((x[:, f] >= 0) & (x[:, f] < arity), x[:, f], arity) if arity else np.searchsorted(edges, x[:, f])
        return out


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


# --- splits ----------------------------------------------------------------------------------

def _gini_sum(a, b):
    """Rows times Gini impurity, of class counts."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    return 2.0 * a * b / np.maximum(a + b, 1.0)


def _taken(l0, l1, t0, t1):
    """What a split takes from that; exactly 0 where both sides have the same shares."""
    left, right = l0 + l1, (t0 - l0) + (t1 - l1)
    apart = (l1 * right - (t1 - l1) * left).astype(float)
    return 2.0 * apart * apart / np.maximum((left + right) * left.astype(float) * right, 1.0)


def best_splits(node, b, a0, a1, by_rate, n0, n1):
    """For each node the best cut through its filled bins, from class counts sorted by (node, bin):
    (taken, last entry that goes left, order of the entries, first entry). The bins of a node in
    ``by_rate`` are unordered categories and are put in order of their share of class 1."""
    order = np.arange(len(node))
    free = np.flatnonzero(by_rate[node])
    if len(free):
        rate = a1[free] / (a0[free] + a1[free])
        order[free] = free[np.lexsort((rate, node[free]))]
        a0, a1 = a0[order], a1[order]
    first = np.searchsorted(node, np.arange(len(n0)))
    c0, c1 = np.cumsum(a0), np.cumsum(a1)
    l0, l1 = c0 - (c0 - a0)[first][node], c1 - (c1 - a1)[first][node]
    taken = _taken(l0, l1, n0[node], n1[node])
    best = np.maximum.reduceat(taken, first) if len(node) else np.zeros(0)
    hit = np.flatnonzero(taken == best[node])[::-1]
    at = np.zeros(len(n0), np.int64)
    at[node[hit]] = hit
    return best, at, order, first


def _left_masks(b, order, first, at, nodes, width):
    """Packed sets of the categories that go left, a row for each of ``nodes``."""
    out = np.zeros((len(nodes), width), np.uint8)
    if len(nodes):
        sizes = at[nodes] - first[nodes] + 1
        row = np.repeat(np.arange(len(nodes)), sizes)
        entry = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first[nodes], sizes)
        category = b[order[entry]]
        np.bitwise_or.at(out, (row, category >> 3), (1 << (category & 7)).astype(np.uint8))
    return out


def _goes_left(b, cut, mask, masks):
    left = b <= cut
    if len(masks):
        free = np.flatnonzero(mask >= 0)
        c = b[free].astype(np.int64)
        inside = c < masks.shape[1] * 8
        c = np.where(inside, c, 0)
        left[free] = inside & ((masks[mask[free], c >> 3] >> (c & 7)) & 1).astype(bool)
    return left


# Of a row's weight times 2 plus its class, below 64: the weight, and above bit 32 that of class 1.
SUMS = np.array([(c >> 1) + ((c >> 1) * (c & 1) << 32) for c in range(64)], np.int64)


class Cells:
    """Class counts by node and bin, of rows at the nodes ``at``; ``wy`` is a row's weight times 2 plus
    its class. They are counted in place while the bins of all nodes are few against the rows, and by
    sorting the rows else."""

    def __init__(self, at, wy, nodes: int, wide: int):
        self.wide, self.size, self.sort = wide, 2 * nodes * wide, nodes * wide > 2 * len(at)
        if self.sort:
            self.row = (at * (64 * wide) + wy).astype(np.uint32 if nodes * wide < 1 << 26 else np.int64)
        else:
            self.row, self.weight = at * (2 * wide) + (wy & 1), (wy >> 1).astype(float)

    def count(self, b):
        """(node, bin, rows of class 0, of class 1) of the filled bins, sorted, from each row's bin."""
        if self.sort:
            key = self.row + (b.astype(self.row.dtype) << 6)
            key.sort()
            cell = key >> 6
            start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            sums = np.add.reduceat(np.take(SUMS, key & 63), start)
            cell, a1 = cell[start].astype(np.int64), sums >> 32
            a0 = (sums & 0xFFFFFFFF) - a1
        else:
            sums = np.bincount(self.row + 2 * b.astype(np.int64), self.weight, self.size)
            a0, a1 = sums[0::2], sums[1::2]
            cell = np.flatnonzero(a0 + a1)
            a0, a1 = a0[cell].astype(np.int64), a1[cell].astype(np.int64)
        node = cell // self.wide
        return node, cell - node * self.wide, a0, a1


def draw(rng, nodes: int, slots: int, take: int) -> np.ndarray:
    """The slots that each node may split by."""
    return np.argsort(rng.random((nodes, slots)), axis=1)[:, :take]


def grow(x, label, weight, grid: Grid, take: int, depth: int, rng) -> dict:
    """One part, level by level over all open nodes. Like Spark's trees, a node becomes a leaf when
    none of its drawn slots takes anything from its impurity."""
    slots = len(grid.arity)
    unordered = np.array([a > 2 for a in grid.arity])
    flat, wide = x.reshape(-1), grid.size + 1
    wy = (np.minimum(weight, 31) * 2 + label).astype(np.int64)
    parts, taken_by, masks, n_masks, base = [], np.zeros(slots), [], 0, 0
    at, rows, n_nodes = np.zeros(len(label), np.int64), np.arange(len(label)), 1
    for level in range(depth + 1):
        sums = np.bincount(2 * at + (wy[rows] & 1), wy[rows] >> 1, 2 * n_nodes).astype(np.int64)
        n0, n1 = sums[0::2], sums[1::2]
        made = {c: np.zeros(n_nodes, t) for c, t in ARRAYS.items()} | {"n0": n0, "n1": n1}
        made["feature"][:], made["mask"][:] = -1, -1
        parts.append(made)
        live = np.flatnonzero((n0 > 0) & (n1 > 0)) if level < depth else np.zeros(0, np.int64)
        if not len(live):
            break
        new = np.full(n_nodes, -1)
        new[live] = np.arange(len(live))
        keep = new[at] >= 0
        rows, at = rows[keep], new[at[keep]]
        m0, m1 = n0[live], n1[live]
        drawn = draw(rng, len(live), slots, take)
        best, slot = np.zeros(len(live)), np.full(len(live), -1)
        cut, sets = np.zeros(len(live), np.int64), np.zeros((len(live), grid.width), np.uint8)
        at_row, cells = rows * slots, Cells(at, wy[rows], len(live), wide)
        for j in range(drawn.shape[1]):
            b = np.take(flat, at_row + np.take(np.ascontiguousarray(drawn[:, j]), at))
            node, b, a0, a1 = cells.count(b)
            gain, last, order, first = best_splits(node, b, a0, a1, unordered[drawn[:, j]], m0, m1)
            better = np.flatnonzero(gain > best)
            best[better], slot[better], cut[better] = gain[better], drawn[better, j], b[order[last[better]]]
            free = better[unordered[drawn[better, j]]]
            sets[free] = _left_masks(b, order, first, last, free, grid.width)
        split = np.flatnonzero(slot >= 0)
        np.add.at(taken_by, slot[split], best[split])
        where = live[split]
        made["feature"][where], made["cut"][where] = slot[split], cut[split]
        made["left"][where] = base + n_nodes + 2 * np.arange(len(split))
        made["right"][where] = made["left"][where] + 1
        by_set = split[unordered[slot[split]]]
        made["mask"][live[by_set]] = n_masks + np.arange(len(by_set))
        masks.append(sets[by_set])
        n_masks += len(by_set)
        place = np.full(len(live), -1)
        place[split] = np.arange(len(split))
        own = np.full(len(live), -1)
        own[by_set] = np.arange(len(by_set))
        keep = place[at] >= 0
        rows, at = rows[keep], at[keep]
        left = _goes_left(flat[rows * slots + slot[at]], cut[at], own[at], sets[by_set])
        at = 2 * place[at] + ~left
        base, n_nodes = base + n_nodes, 2 * len(split)
        if not n_nodes:
            break
    out = {c: np.concatenate([p[c] for p in parts]).astype(t) for c, t in ARRAYS.items()}
    return out | {"masks": np.concatenate(masks) if masks else np.zeros((0, grid.width), np.uint8), "taken": taken_by}


def route(part: dict, x: np.ndarray) -> np.ndarray:
    """The leaf, or the node that leads to another part, that each row reaches."""
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        here = at[rows]
        inner = part["feature"][here] >= 0
        rows, here = rows[inner], here[inner]
        left = _goes_left(x[rows, part["feature"][here]], part["cut"][here], part["mask"][here], part["masks"])
        at[rows] = np.where(left, part["left"][here], part["right"][here])
    return at


def _row(tree: int, number: int, part: dict) -> tuple:
    return (tree, number, len(part["feature"]), part["masks"].tobytes(), [float(v) for v in part["taken"]],
            *[np.ascontiguousarray(part[c], t).tobytes() for c, t in ARRAYS.items()])


def _part(row: dict, width: int) -> dict:
    got = {c: np.frombuffer(row[c], t) for c, t in ARRAYS.items()}
    return got | {"masks": np.frombuffer(row["masks"], np.uint8).reshape(-1, width) if width else np.zeros((0, 0), np.uint8)}


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _left_values(p: dict, i: np.ndarray, grid: Grid) -> pa.Array:
    """Of the nodes ``i`` what goes left: the threshold, or the categories in order; none of a leaf."""
    feature, cut, mask = p["feature"][i], p["cut"][i], p["mask"][i]
    arity = np.where(feature >= 0, np.array(grid.arity)[feature], 0)
    edges = np.concatenate([np.zeros(0), *grid.edges])
    first = np.cumsum([0, *map(len, grid.edges)])
    number = np.flatnonzero((feature >= 0) & (arity == 0))
    cuts = np.flatnonzero((feature >= 0) & (arity > 0) & (mask < 0))
    sets = np.flatnonzero((feature >= 0) & (mask >= 0))
    upto = np.repeat(cuts, cut[cuts] + 1)
    at, category = np.nonzero(np.unpackbits(p["masks"][mask[sets]], axis=1, bitorder="little"))
    where = np.concatenate([number, upto, sets[at]])
    values = np.concatenate([edges[first[feature[number]] + cut[number]], np.arange(len(upto)) - np.searchsorted(upto, upto), category])
    ends = np.r_[0, np.cumsum(np.bincount(where, minlength=len(i)))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[np.argsort(where, kind="stable")].astype(float)))


def _node_batch(tree: int, p: dict, ids: np.ndarray, i: np.ndarray, grid: Grid, schema: pa.Schema) -> pa.RecordBatch:
    """The nodes ``i`` of a part as rows of ``NODE``; ``ids`` are the ids of all its nodes."""
    inner = p["feature"][i] >= 0
    left, right = p["left"][i], p["right"][i]

    def mixed(at):
        n0, n1 = p["n0"][at].astype(float), p["n1"][at].astype(float)
        return n0, n1, n0 + n1, _gini_sum(n0, n1) / np.maximum(n0 + n1, 1)

    n0, n1, n, impurity = mixed(i)
    (_, _, n_left, of_left), (_, _, n_right, of_right) = mixed(left), mixed(right)
    gain = np.where(inner, impurity - (n_left * of_left + n_right * of_right) / np.maximum(n, 1), -1.0)
    node = schema.field("nodeData").type
    split = node.field("split").type
    arity = np.where(inner, np.array(grid.arity)[p["feature"][i]], 0)
    int32 = lambda v: pa.array(v.astype(np.int32))
    stats = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(i) + 1, 2, dtype=np.int32)), pa.array(np.stack([n0, n1], 1).reshape(-1)))
    how = pa.StructArray.from_arrays(
        [int32(p["feature"][i]), _left_values(p, i, grid).cast(split.field("leftCategoriesOrThreshold").type), int32(np.where(arity > 0, arity, -1))],
        fields=list(split))
    data = pa.StructArray.from_arrays(
        [int32(ids[i]), pa.array((n1 > n0).astype(float)), pa.array(impurity), stats.cast(node.field("impurityStats").type), pa.array(n.astype(np.int64)),
         pa.array(gain), int32(np.where(inner, ids[left], -1)), int32(np.where(inner, ids[right], -1)), how], fields=list(node))
    return pa.RecordBatch.from_arrays([int32(np.full(len(i), tree)), data], schema=schema)


# --- growing ---------------------------------------------------------------------------------

def fit_grid(df: DataFrame, features: str, slots: int, arity: list[int], bins: int) -> Grid:
    """Up to ``bins`` bins by slot: between all values where there are few, else between quantiles."""
    numeric = [f for f in range(slots) if not arity[f]]
    edges: list[list[float]] = [[] for _ in range(slots)]
    if numeric:
        cells = df.select(F.posexplode(vector_to_array(features)).alias("slot", "value")).filter(F.col("slot").isin(numeric))
        ranks = F.array(*[F.lit(i / (bins - 1)) for i in range(bins)])
        found = cells.groupBy("slot").agg(
            F.percentile_approx("value", ranks, 50 * bins).alias("points"), F.approx_count_distinct("value").alias("n")).collect()
        few = [r["slot"] for r in found if r["n"] <= bins * 1.2]
        each = cells.filter(F.col("slot").isin(few)).distinct().groupBy("slot").agg(F.collect_list("value")).collect()
        points = {r["slot"]: r["points"] for r in found}
        points |= {f: values for f, values in each if len(values) <= bins}
        for f, values in points.items():
            v = np.unique(np.array(values, float))
            edges[f] = ((v[1:] + v[:-1]) / 2.0).tolist()
    return Grid(arity, edges)


def slots_of(df: DataFrame, features: str) -> tuple[int, list[int]]:
    """Vector size, and the number of categories by slot (0: a number), from the column's metadata."""
    slots = len(df.select(vector_to_array(features)).first()[0])
    arity = [0] * slots
    for kind, attrs in df.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).items():
        for a in attrs if kind in ("nominal", "binary") else ():
            arity[a["idx"]] = 2 if kind == "binary" else len(a["vals"]) if "vals" in a else a.get("num_vals", 0)
    return slots, arity


def _blocks(df: DataFrame, features: str, label: str, grid: Grid) -> DataFrame:
    """The rows as bins and classes, packed: (block, x, y)."""
    slots = len(grid.arity)
    schema = pa.schema([("block", pa.int64()), ("x", pa.binary()), ("y", pa.binary())])

    def pack(batches):
        for i, batch in enumerate(batches):
            if batch.num_rows:
                x = grid.bins(_matrix(batch.column(0), slots))
                y = batch.column(1).to_numpy().astype(np.uint8)
                yield pa.RecordBatch.from_pylist([{"block": (batch.column(2)[0].as_py() << 32) + i, "x": x.tobytes(), "y": y.tobytes()}], schema)

    return stage(df.select(vector_to_array(features), label, F.spark_partition_id()).mapInArrow(pack, "block long, x binary, y binary"))


def _unpacked(batches, grid: Grid, trees: int, seed: int):
    """(tree, x, y, weight) of every block: how often the tree has each row, drawn by block and tree."""
    for batch in batches:
        for r in batch.to_pylist():
            y = np.frombuffer(r["y"], np.uint8)
            x = np.frombuffer(r["x"], grid.type).reshape(len(y), -1)
            for tree in range(trees):
                weight = np.random.default_rng([seed, tree, r["block"]]).poisson(1.0, len(y))
                has = weight > 0
                yield tree, x[has], y[has], weight[has]


def _tops(blocks: DataFrame, n_rows: int, grid: Grid, trees: int, depth: int, take: int, seed: int, part_rows: int,
          pass_nodes: int) -> list[dict]:
    """The nodes of more than ``part_rows`` rows, split level by level from summed counts. The end
    nodes lead to parts, numbered from 1 (``ref``), unless they are leaves already."""
    slots = len(grid.arity)
    unordered = np.array([a > 2 for a in grid.arity])
    empty = {c: np.zeros(1, t) for c, t in ARRAYS.items()}
    empty["feature"][:], empty["mask"][:], empty["n0"][:] = -1, -1, n_rows
    tops = [empty | {"masks": np.zeros((0, grid.width), np.uint8), "taken": np.zeros(slots), "depth": np.zeros(1, np.int32)}
            for _ in range(trees)]
    open_ = [(t, 0) for t in range(trees)] if n_rows > part_rows and depth else []
    while open_:
        now, later = open_[:pass_nodes], open_[pass_nodes:]
        drawn = {k: draw(np.random.default_rng([seed, 1, *k]), 1, slots, take)[0] for k in now}

        def count(batches):
            sums = {k: np.zeros((take, grid.size + 1, 2), np.int64) for k in drawn}
            for tree, x, y, weight in _unpacked(batches, grid, trees, seed):
                at = route(tops[tree], x)
                for node in np.unique(at):
                    if (tree, node) in sums:
                        r = at == node
                        for j, f in enumerate(drawn[tree, node]):
                            key = x[r, f].astype(np.int64) * 2 + y[r]
                            sums[tree, node][j] += np.bincount(key, weight[r], 2 * grid.size + 2).astype(np.int64).reshape(-1, 2)
            for (tree, node), cells in sums.items():
                j, b = np.nonzero(cells.sum(2))
                n = len(j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, tree, np.int32)), pa.array(np.full(n, node, np.int32)), pa.array(j.astype(np.int32)),
                     pa.array(b.astype(np.int32)), pa.array(cells[j, b, 0]), pa.array(cells[j, b, 1])],
                    names=["tree", "node", "j", "b", "a0", "a1"])

        split_schema = "tree int, node int, slot int, cut int, mask binary, taken double, l0 long, l1 long, n0 long, n1 long"
        arrow = arrow_schema(split_schema)

        def choose(key, cells):
            tree, node = (k.as_py() for k in key)
            j, b, a0, a1 = (cells[c].to_numpy() for c in ("j", "b", "a0", "a1"))
            best = None
            for k, f in enumerate(drawn[tree, node]):
                r = np.flatnonzero(j == k)
                r = r[np.argsort(b[r])]
                n0, n1 = a0[r].sum(keepdims=True), a1[r].sum(keepdims=True)
                zero = np.zeros(len(r), np.int64)
                gain, last, order, first = best_splits(zero, b[r], a0[r], a1[r], unordered[[f]], n0, n1)
                if best is None or gain[0] > best[5]:
                    goes = r[order[:last[0] + 1]]
                    mask = _left_masks(b[r], order, first, last, np.zeros(1, np.int64), grid.width)[0].tobytes() if unordered[f] else None
                    slot = int(f) if gain[0] > 0 else -1
                    best = (tree, node, slot, int(b[r][order[last[0]]]), mask, float(gain[0]),
                            int(a0[goes].sum()), int(a1[goes].sum()), int(n0[0]), int(n1[0]))
            return _table([best], arrow)

        cells = blocks.mapInArrow(count, "tree int, node int, j int, b int, a0 long, a1 long")
        summed = cells.groupBy("tree", "node", "j", "b").agg(F.sum("a0").alias("a0"), F.sum("a1").alias("a1"))
        found = summed.groupBy("tree", "node").applyInArrow(choose, split_schema).collect()
        open_ = later
        for s in sorted(found, key=lambda s: (s["tree"], s["node"])):
            top, i = tops[s["tree"]], s["node"]
            n = len(top["feature"])
            top = {c: v.copy() for c, v in top.items()}
            top["n0"][i], top["n1"][i] = s["n0"], s["n1"]
            tops[s["tree"]] = top
            if s["slot"] < 0:
                top["ref"][i] = -1
                continue
            top["feature"][i], top["cut"][i], top["left"][i], top["right"][i] = s["slot"], s["cut"], n, n + 1
            top["taken"][s["slot"]] += s["taken"]
            if s["mask"] is not None:
                top["mask"][i] = len(top["masks"])
                top["masks"] = np.vstack([top["masks"], np.frombuffer(s["mask"], np.uint8)])
            for c0, c1 in ((s["l0"], s["l1"]), (s["n0"] - s["l0"], s["n1"] - s["l1"])):
                values = {"feature": -1, "mask": -1, "n0": c0, "n1": c1, "depth": int(top["depth"][i]) + 1, "ref": -1 if not (c0 and c1) else 0}
                for c in (*ARRAYS, "depth"):
                    top[c] = np.append(top[c], np.array(values.get(c, 0), top[c].dtype))
                if c0 and c1 and c0 + c1 > part_rows and top["depth"][-1] < depth:
                    open_.append((s["tree"], len(top["feature"]) - 1))
    for top in tops:
        # An end node that is not known to be a leaf leads to a part, unless the depth is used up.
        ends = np.flatnonzero((top["feature"] < 0) & (top["ref"] == 0) & ((top["depth"] < depth) | (top["depth"] == 0)))
        top["ref"] = np.zeros(len(top["feature"]), np.int32)
        top["ref"][ends] = np.arange(1, len(ends) + 1)
    return tops


def fit_table_forest(df: DataFrame, features: str, label: str, trees: int, depth: int, bins: int, seed: int, memory_mb: int):
    spark = df.sparkSession
    slots, arity = slots_of(df, features)
    most = max(arity, default=0)
    if most > bins:
        raise ValueError(f"{bins} bins are too few for {most} categories")
    grid = fit_grid(df, features, slots, arity, bins)
    take = int(np.ceil(np.sqrt(slots)))
    blocks = _blocks(df, features, label, grid)
    part_rows = max((memory_mb << 20) // ROW_BYTES, 2)
    n_rows = int(blocks.agg(F.sum(F.length("y"))).first()[0])
    pass_nodes = max((memory_mb << 20) // (16 * take * (grid.size + 1)), 1)
    tops = _tops(blocks, n_rows, grid, trees, depth, take, seed, part_rows, pass_nodes)

    def deal(batches):
        for tree, x, y, weight in _unpacked(batches, grid, trees, seed):
            number = tops[tree]["ref"][route(tops[tree], x)]
            for part in np.unique(number[number > 0]):
                r = number == part
                yield pa.RecordBatch.from_pylist([{"tree": tree, "part": int(part), "x": x[r].tobytes(), "y": y[r].tobytes(),
                                                   "weight": weight[r].astype(np.uint8).tobytes()}], dealt)

    dealt = pa.schema([("tree", pa.int32()), ("part", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("weight", pa.binary())])
    arrow = arrow_schema(PART)

    def finish(key, rows):
        tree, number = (k.as_py() for k in key)
        x, y, weight = (np.frombuffer(b"".join(rows[c].to_pylist()), t) for c, t in (("x", grid.type), ("y", np.uint8), ("weight", np.uint8)))
        root = np.flatnonzero(tops[tree]["ref"] == number)[0]
        rng = np.random.default_rng([seed, 2, tree, number])
        made = grow(x.reshape(len(y), -1), y, weight, grid, take, depth - int(tops[tree]["depth"][root]), rng)
        return _table([_row(tree, number, made)], arrow)

    n_parts = sum(int((t["ref"] > 0).sum()) for t in tops)
    # Whole parts fall to the tasks by hash: the more rows there are, the more tasks even that out.
    spread = max(min(2 * n_parts, max(4 * spark.sparkContext.defaultParallelism, n_rows * trees >> 19)), 1)
    rows = blocks.mapInArrow(deal, "tree int, part int, x binary, y binary, weight binary").repartition(spread, "tree", "part")
    path = fresh_path(spark, "forest")
    rows.groupBy("tree", "part").applyInArrow(finish, PART).write.parquet(path)
    # A part without rows, of a tree that has drawn none, is a leaf that does not vote.
    made = {tuple(r) for r in spark.read.schema(PART).parquet(path).select("tree", "part").collect()}
    empty = {c: np.full(1, -1 if c in ("feature", "mask") else 0) for c in ARRAYS} | {"masks": np.zeros((0, 0), np.uint8), "taken": np.zeros(slots)}
    rest = [(t, int(n)) for t, top in enumerate(tops) for n in top["ref"] if n > 0 and (t, int(n)) not in made]
    local_rows(spark, [_row(t, 0, top) for t, top in enumerate(tops)] + [_row(t, n, empty) for t, n in rest], PART).write.mode("append").parquet(path)
    about = {"trees": trees, "arity": grid.arity, "edges": grid.edges, "features": features, "depth": depth, "bins": bins, "seed": seed}
    return TableForest(path, about)


# --- the model -------------------------------------------------------------------------------

class TableForest(Model, MLReadable, MLWritable):
    """A grown forest: its parts as Parquet, and the bins. Scores like Spark's forest model: every
    tree votes with the class shares of the leaf."""

    def __init__(self, path: str, about: dict):
        super().__init__()
        self.path, self.about = path, about
        self.grid = Grid(about["arity"], about["edges"])
        self.numFeatures, self._spark_model = len(about["arity"]), None

    def parts(self) -> DataFrame:
        return SparkSession.active().read.schema(PART).parquet(self.path)

    def tops(self) -> list[dict]:
        found = {r["tree"]: _part(r.asDict(), self.grid.width) for r in self.parts().filter("part = 0").collect()}
        return [found[t] for t in range(self.about["trees"])]

    @property
    def totalNumNodes(self) -> int:
        # The first node of a part is the end node of the top that leads there.
        return int(self.parts().agg(F.sum(F.col("n_nodes") - (F.col("part") > 0).cast("int"))).first()[0])

    @property
    def featureImportances(self) -> DenseVector:
        """What the splits by each slot took from the impurity, as a share of the tree, averaged."""
        cells = self.parts().select("tree", F.posexplode("taken").alias("slot", "taken"))
        by_tree = cells.groupBy("tree", "slot").agg(F.sum("taken").alias("taken"))
        whole = F.sum("taken").over(Window.partitionBy("tree"))
        share = by_tree.withColumn("whole", whole).filter("whole > 0").groupBy("slot").agg(F.sum(F.col("taken") / F.col("whole")))
        out = np.zeros(self.numFeatures)
        for slot, v in share.collect():
            out[slot] = v
        return DenseVector(out / out.sum() if out.sum() else out)

    def nodes(self) -> DataFrame:
        """A row per node, in the layout in which Spark saves its forests. Ids ascend from 0 in each
        tree, children after their parents."""
        grid, tops, spark = self.grid, self.tops(), SparkSession.active()
        sizes = self.parts().filter("part > 0").select("tree", "part", "n_nodes").collect()
        start, nexts = [], [len(t["feature"]) for t in tops]
        for tree, part, n in sorted(tuple(r) for r in sizes):
            start.append((tree, part, int(np.flatnonzero(tops[tree]["ref"] == part)[0]), nexts[tree]))
            nexts[tree] += n - 1
        start += [(t, 0, 0, 1) for t in range(len(tops))]
        placed = self.parts().join(F.broadcast(local_rows(spark, start, "tree int, part int, root int, next int")), ["tree", "part"])
        arrow = arrow_schema(NODE)
        step = 1 << 14

        def unpack(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    p = _part(r, grid.width)
                    ids = np.arange(r["n_nodes"])
                    if r["part"]:
                        ids += r["next"] - 1
                        ids[0] = r["root"]
                    for low in range(0, r["n_nodes"], step):
                        i = np.arange(low, min(low + step, r["n_nodes"]))
                        i = i[p["ref"][i] == 0] if r["part"] == 0 else i
                        if len(i):
                            yield _node_batch(r["tree"], p, ids, i, grid, arrow)

        return placed.mapInArrow(unpack, NODE)

    def to_spark(self) -> RandomForestClassificationModel:
        """The same trees as Spark's own model, which the driver holds whole; for small forests and
        for streams."""
        if self._spark_model is None:
            spark, path, about = SparkSession.active(), fresh_path(SparkSession.active(), "sparkforest"), self.about
            params = {"featuresCol": about["features"], "impurity": "gini", "maxDepth": about["depth"], "maxBins": about["bins"], "seed": about["seed"]}
            base = {"timestamp": 0, "sparkVersion": spark.version, "defaultParamMap": {
                "labelCol": "label", "predictionCol": "prediction", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction"}}
            kind = "org.apache.spark.ml.classification."
            whole = base | {"class": kind + "RandomForestClassificationModel", "uid": self.uid, "numFeatures": self.numFeatures,
                            "numClasses": 2, "numTrees": about["trees"], "paramMap": params | {"numTrees": about["trees"]}}
            spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
            each = [(t, json.dumps(base | {"class": kind + "DecisionTreeClassificationModel", "uid": f"{self.uid}_{t}", "paramMap": params}), 1.0)
                    for t in range(about["trees"])]
            spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
            self.nodes().write.parquet(f"{path}/data")
            self._spark_model = RandomForestClassificationModel.load(path)
        return self._spark_model

    @property
    def trees(self):
        return self.to_spark().trees

    def _transform(self, df: DataFrame) -> DataFrame:
        if df.isStreaming:
            return self.to_spark().transform(df)
        grid, tops, slots, n_trees = self.grid, self.tops(), self.numFeatures, self.about["trees"]
        rows = stage(df.withColumn("__row", F.monotonically_increasing_id()))
        n_rows = rows.count()
        sent = pa.schema([("block", pa.int64()), ("tree", pa.int32()), ("part", pa.int32()), ("at", pa.binary()), ("x", pa.binary()),
                          ("ids", pa.binary())])

        def send(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids = batch.column(0).to_numpy()
                x = grid.bins(_matrix(batch.column(1), slots))
                for tree, top in enumerate(tops):
                    end = route(top, x)
                    number = top["ref"][end]
                    for part in np.unique(number):
                        at = np.flatnonzero(number == part)
                        # A leaf of the top is part 0: the row's short way through the top is taken again there.
                        yield pa.RecordBatch.from_pylist([{
                            "block": int(ids[0]), "tree": tree, "part": int(part), "at": at.astype(np.int32).tobytes(),
                            "x": x[at].tobytes(), "ids": ids[at].tobytes() if tree == 0 else None}], sent)

        slabs = max(-(-n_rows // SLAB_ROWS), 1)
        keys = ["tree", "part", "slab"]
        chunks = (rows.select("__row", vector_to_array(self.about["features"])).mapInArrow(
            send, "block long, tree int, part int, at binary, x binary, ids binary")
            .withColumn("slab", F.pmod(F.hash("block"), F.lit(slabs))))
        parts = self.parts().withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))))
        voted = pa.schema([("block", pa.int64()), ("tree", pa.int32()), ("at", pa.binary()), ("ids", pa.binary()), ("p", pa.binary())])

        def vote(key, left, right):
            out = []
            if left.num_rows:
                part = _part(right.to_pylist()[0], grid.width)
                n = part["n0"] + part["n1"]
                share = np.where(n > 0, part["n1"] / np.maximum(n, 1), np.nan)
                for r in left.to_pylist():
                    x = np.frombuffer(r["x"], grid.type).reshape(-1, slots)
                    out.append((r["block"], r["tree"], r["at"], r["ids"], share[route(part, x)].tobytes()))
            return _table(out, voted)

        spread = 4 * SparkSession.active().sparkContext.defaultParallelism
        votes = (chunks.repartition(spread, *keys).groupBy(*keys).cogroup(parts.repartition(spread, *keys).groupBy(*keys))
                 .applyInArrow(vote, "block long, tree int, at binary, ids binary, p binary"))
        scored = pa.schema([("__row", pa.int64()), ("__no", pa.float64()), ("__yes", pa.float64())])

        def tally(key, got):
            rows_ = got.to_pylist()
            own = [r for r in rows_ if r["ids"] is not None]
            size = sum(len(r["ids"]) for r in own) // 8
            ids, shares = np.empty(size, np.int64), np.full((size, n_trees), np.nan)
            for r in own:
                ids[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["ids"], np.int64)
            for r in rows_:
                shares[np.frombuffer(r["at"], np.int32), r["tree"]] = np.frombuffer(r["p"], float)
            return pa.table([pa.array(v) for v in (ids, np.nansum(1.0 - shares, 1), np.nansum(shares, 1))], schema=scored)

        totals = votes.groupBy("block").applyInArrow(tally, "__row long, __no double, __yes double")
        no, yes = F.col("__no"), F.col("__yes")
        share = F.coalesce(F.try_divide(yes, no + yes), F.lit(0.5))
        return rows.join(stage(totals), "__row").select(
            *[F.col(f"`{c}`") for c in df.columns], array_to_vector(F.array(no, yes)).alias("rawPrediction"),
            array_to_vector(F.array(1.0 - share, share)).alias("probability"),
            (yes > no).cast("double").alias("prediction"))

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, forest: TableForest):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.forest, path, self.sparkSession, extraMetadata={"about": self.forest.about})
        self.forest.parts().write.parquet(f"{path}/parts")


class _Reader(MLReader):
    def load(self, path: str) -> TableForest:
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        forest = TableForest(f"{path}/parts", found["about"])
        return forest._resetUid(found["uid"])
