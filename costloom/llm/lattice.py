"""Embedding near-duplicates by lattice hashing.

Unit vectors are projected at random to 8 dimensions, scaled, and decoded to the nearest point of the E8 lattice. ``blocks`` such
projections make a cell of one table; more blocks make finer cells, and their number grows with the number of vectors. A vector
lies in its home cell and in the ``PROBES`` neighbouring cells that are cheapest to reach, where single blocks move to their
second-nearest lattice point. The number of tables follows from the recall asked for: a simulation of pairs exactly at the
threshold gives the chance that one table brings such a pair together.

All vectors of a cell are compared by their cosine in double precision, so no false link remains. A pair that meets in several cells
counts only in the first one, which each cell can tell from the two vectors alone. A cell gives back a number of links per vector
and tree edges, never its pairs. Equal vectors are one vector with a count before anything is dealt out. Cells with more than
``HOT`` vectors are dealt out as pairs of chunks.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing and are their own component. Vectors of different
lengths don't link. Repeated ids with the same vector are copies of each other and link; ties need no order. Extremely
large or small components are scaled before the norm is taken. Empty tables give empty results, other columns are not read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.spread import grouped_for_join
from .common import checkpointed
from .components import components

COSINE = 0.9
RECALL = 0.97
PROBES = 3
SCALE = 3.0
HOT = 4096
CHUNK = 16_384
SMALL = 48


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = [a * np.eye(8)[i] + b * np.eye(8)[j] for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)]
    half = [np.where([m >> k & 1 for k in range(8)], 0.5, -0.5) for m in range(256) if bin(m).count("1") % 2 == 0]
    return np.array(whole + half)


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points: integers with an even sum, or those moved by one half in every coordinate."""
    def even(y):
        point = np.rint(y)
        off = y - point
        odd = np.flatnonzero(point.sum(axis=1) % 2 != 0)
        worst = np.abs(off[odd]).argmax(axis=1)
        point[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
        return point

    a, b = even(x), even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def block_count(dim: int, count: int) -> int:
    """Lattice blocks of a cell: three up to a million vectors, one more for every factor of 30, no more than the dimensions fill."""
    return max(1, min(dim // 8, 3 + max(0, math.ceil(math.log(max(count, 1) / 1e6, 30)))))


class Index:
    """Projections of all tables for vectors of one length."""

    def __init__(self, dim: int, blocks: int, tables: int, probes: int = PROBES, seed: int = 5):
        self.dim, self.blocks, self.tables = dim, blocks, tables
        rng = np.random.default_rng([seed, dim, blocks])
        scale = SCALE * math.sqrt(dim / 64)
        self.planes = []
        for _ in range(tables):
            g = rng.normal(size=(dim, 8 * blocks))
            self.planes.append((np.linalg.qr(g)[0] if dim >= 8 * blocks else g / math.sqrt(dim)) * scale)
        moves = sorted(range(1, 1 << blocks), key=lambda m: (bin(m).count("1"), m))
        self.moves = np.array([[m >> b & 1 for b in range(blocks)] for m in moves], bool)
        self.probes = min(probes, len(moves))
        self.mix = np.random.default_rng(99).integers(1, 1 << 62, 8 * blocks, dtype=np.int64) | 1

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """Cell numbers of unit vectors, by vector, table, and home or probe."""
        out = np.empty((len(unit), self.tables, 1 + self.probes), np.int64)
        for t, plane in enumerate(self.planes):
            x = unit @ plane
            home, moved, cost = [], [], []
            for b in range(self.blocks):
                y = x[:, 8 * b: 8 * b + 8]
                point = nearest(y)
                gain = (y - point) @ neighbours().T
                best = gain.argmax(axis=1)
                mix = self.mix[8 * b: 8 * b + 8]
                home.append(np.rint(2 * point).astype(np.int64) @ mix)
                moved.append(np.rint(2 * (point + neighbours()[best])).astype(np.int64) @ mix)
                cost.append(2 - 2 * gain[np.arange(len(y)), best])
            home, moved, cost = (np.stack(z, axis=1) for z in (home, moved, cost))
            out[:, t, 0] = home.sum(axis=1)
            order = np.argsort(cost @ self.moves.T, axis=1, kind="stable")[:, : self.probes]
            for p in range(self.probes):
                out[:, t, 1 + p] = np.where(self.moves[order[:, p]], moved, home).sum(axis=1)
            out[:, t] = (out[:, t] ^ np.int64((t * 0x9E3779B97F4A7C1 + self.dim) % (1 << 63))) * 0x1000193
        return out


def hit_rate(dim: int, blocks: int, cosine: float = COSINE, probes: int = PROBES, pairs: int = 2000) -> float:
    """How often one table brings a pair at ``cosine`` together."""
    rng = np.random.default_rng(17)
    a, w = rng.normal(size=(2, pairs, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    w -= (w * a).sum(axis=1)[:, None] * a
    w /= np.maximum(np.linalg.norm(w, axis=1), 1e-9)[:, None]
    hits = []
    for seed in range(3):
        index = Index(dim, blocks, 1, probes, seed)
        x, y = index.cells(a)[:, 0], index.cells(cosine * a + math.sqrt(1 - cosine**2) * w)[:, 0]
        hits.append((x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean())
    return float(np.mean(hits))


@lru_cache(maxsize=16)
def index_for(dim: int, count: int, cosine: float = COSINE, recall: float = RECALL) -> Index:
    blocks = block_count(dim, count)
    rate = hit_rate(dim, blocks, cosine)
    tables = 1 if rate >= recall else math.ceil(math.log(1 - recall) / math.log(1 - max(rate, 0.01)))
    return Index(dim, blocks, tables)


def units(column) -> np.ndarray:
    """Unit vectors in double precision of an Arrow list column whose rows have equal lengths."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def first_meeting(index: Index, unit: np.ndarray, i: np.ndarray, j: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Which pairs meet in ``cell`` first: in no earlier table, and in no smaller cell of this one."""
    which, back = np.unique(np.r_[i, j], return_inverse=True)
    cells = index.cells(unit[which])
    a, b = back[: len(i)], back[len(i):]
    first = np.zeros(len(i), bool)
    alive = np.arange(len(i))
    top = np.iinfo(np.int64).max
    for t in range(index.tables):
        x, y = cells[a[alive], t], cells[b[alive], t]
        common = np.where((x[:, :, None] == y[:, None, :]).any(axis=2), x, top).min(axis=1)
        met = common != top
        first[alive[met]] = common[met] == cell[alive[met]]
        alive = alive[~met]
        if not len(alive):
            break
    return first


class _Tally:
    """Links and tree edges of the vectors of one piece of work."""

    def __init__(self, index, cosine, cid, copies, unit, cell):
        self.index, self.cosine, self.cid, self.copies, self.unit, self.cell = index, cosine, cid, copies, unit, cell
        self.links = np.zeros(len(cid), np.int64)
        self.label = np.arange(len(cid))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs that are near enough."""
        for k in range(0, len(i), 20_000):
            a, b = i[k:k + 20_000], j[k:k + 20_000]
            first = first_meeting(self.index, self.unit, a, b, self.cell[a])
            a, b = a[first], b[first]
            np.add.at(self.links, a, self.copies[b])
            np.add.at(self.links, b, self.copies[a])
            while len(a):
                low = np.minimum(self.label[a], self.label[b])
                if (self.label[a] == low).all() and (self.label[b] == low).all():
                    break
                np.minimum.at(self.label, self.label[a], low)
                np.minimum.at(self.label, self.label[b], low)
                self.label[a], self.label[b] = self.label[self.label[a]], self.label[self.label[b]]
                while (self.label != self.label[self.label]).any():
                    self.label = self.label[self.label]

    def near(self, bucket: np.ndarray) -> None:
        """Compare within small buckets, whose rows stand together: row k with row k + 1, then with row k + 2, ..."""
        step = 1
        while True:
            i = np.flatnonzero(bucket[:-step] == bucket[step:]) if step < len(bucket) else np.zeros(0, int)
            if not len(i):
                return
            cos = np.einsum("ij,ij->i", self.unit[i], self.unit[i + step])
            i = i[(cos >= self.cosine) & (self.cid[i] != self.cid[i + step])]
            self.add(i, i + step)
            step += 1

    def across(self, left: np.ndarray, right: np.ndarray, same: bool) -> None:
        for a in range(0, len(left), 512):
            rows = left[a:a + 512]
            for b in range(0, len(right), 2048):
                others = right[b:b + 2048]
                i, j = np.nonzero(self.unit[rows] @ self.unit[others].T >= self.cosine)
                i, j = rows[i], others[j]
                keep = (i < j if same else np.ones(len(i), bool)) & (self.cid[i] != self.cid[j])
                self.add(i[keep], j[keep])

    def out(self):
        import pyarrow as pa

        some, moved = np.flatnonzero(self.links), np.flatnonzero(self.label != np.arange(len(self.label)))
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.array(np.r_[self.cid[some], self.cid[moved]]), pa.concat_arrays([none(len(some)), pa.array(self.cid[self.label[moved]])]),
            pa.concat_arrays([pa.array(self.links[some]), none(len(moved))])], names=["a", "b", "links"])


def dealt(classes: DataFrame, count: int, cosine: float, recall: float) -> DataFrame:
    """``classes`` with one row for every cell a vector lies in."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes).tolist():
                rows = batch.filter(pa.array(sizes == dim))
                cells = index_for(dim, count, cosine, recall).cells(units(rows.column("embedding"))).reshape(rows.num_rows, -1)
                for a in range(0, len(cells), 512):
                    each = [np.unique(c) for c in cells[a:a + 512]]
                    part = rows.take(pa.array(np.repeat(np.arange(a, a + len(each)), [len(c) for c in each])))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.concatenate(each))], names=[*rows.schema.names, "cell"])

    return classes.mapInArrow(run, T.StructType([*classes.schema.fields, T.StructField("cell", T.LongType())]))


def links(classes: DataFrame, count: int, cosine: float = COSINE, recall: float = RECALL, hot: int = HOT) -> DataFrame:
    """``(cid, dim, copies, embedding)`` to numbers of links ``(a, null, links)`` and tree edges ``(a, b, null)``."""
    rows = dealt(classes, count, cosine, recall)
    crowded = checkpointed(dealt(classes, count, cosine, recall).groupBy("dim", "cell").count().filter(F.col("count") > hot))
    rows = rows.withColumns({"left": F.lit(0), "right": F.lit(0), "chunk": F.lit(0)})
    if not crowded.isEmpty():
        chunks = F.ceil(F.col("count") / (hot // 2)).cast("int")
        own = F.when(F.col("count").isNull(), 0).otherwise(F.pmod(F.xxhash64("cid"), F.coalesce(chunks, F.lit(1)))).cast("int")
        others = F.sequence(F.lit(0), F.coalesce(chunks, F.lit(1)) - 1)
        rows = rows.join(crowded, ["dim", "cell"], "left").withColumn("chunk", own).withColumn("other", F.explode(others)).withColumns(
            {"left": F.least("chunk", "other"), "right": F.greatest("chunk", "other")}).select(*rows.columns)
    key = ["dim", "cell", "left", "right"]
    names = ["cid", "copies", "embedding", "chunk", *key]

    def run(batches):
        import pyarrow as pa

        def done(table):
            got = {c: table.column(c).to_numpy() for c in names if c != "embedding"}
            unit = units(pa.concat_arrays(table.column("embedding").chunks))
            dim = int(got["dim"][0])
            tally = _Tally(index_for(dim, count, cosine, recall), cosine, got["cid"], got["copies"], unit, got["cell"])
            change = np.zeros(table.num_rows - 1, bool)
            for c in key:
                change |= got[c][1:] != got[c][:-1]
            bucket = np.r_[0, np.cumsum(change)]
            size = np.bincount(bucket)
            big = (size[bucket] > SMALL) | (got["left"] != got["right"])
            tally.near(np.where(big, -1 - np.arange(len(bucket)), bucket))
            for k in np.unique(bucket[big]):
                at = np.flatnonzero(bucket == k)
                if got["left"][at[0]] == got["right"][at[0]]:
                    tally.across(at, at, True)
                else:
                    mine = got["chunk"][at] == got["left"][at[0]]
                    tally.across(at[mine], at[~mine], False)
            return tally.out()

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch.select(names)])
            held = table if held is None else pa.concat_tables([held, table])
            # Work starts when enough whole buckets of one length of vectors are there; the last bucket may go on.
            while held.num_rows >= CHUNK:
                columns = [held.column(c).to_numpy() for c in key]
                edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
                edge = edge[columns[0][edge - 1] == columns[0][0]]
                if not len(edge):
                    break
                cut = int(edge[min(np.searchsorted(edge, CHUNK), len(edge) - 1)])
                yield done(held.slice(0, cut))
                held = held.slice(cut)
        while held is not None and held.num_rows:
            dims = held.column("dim").to_numpy()
            cut = int((dims == dims[0]).sum())
            yield done(held.slice(0, cut))
            held = held.slice(cut)

    return rows.select(*names).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long, links long")


def deduplicate(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE,
                recall: float = RECALL, hot: int = HOT) -> DataFrame:
    """Per vector: n_links, component_id, kept."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    usable = F.coalesce(sound, F.lit(False))
    rows = rows.withColumn("h1", F.when(usable, F.xxhash64(v))).withColumn("h2", F.when(usable, F.xxhash64(F.lit("second"), v)))
    classes = checkpointed(
        rows.filter("h1 is not null").groupBy("h1", "h2").agg(
            F.first("embedding").alias("embedding"), F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("embedding")).withColumn("cid", F.monotonically_increasing_id()))
    found = checkpointed(links(classes.select("cid", "dim", "copies", "embedding"), classes.count(), cosine, recall, hot))
    stars = components(found.filter("b is not null").select("a", "b"))
    numbers = grouped_for_join(found.filter("links is not null"), ["a"], F.sum("links").alias("links")).withColumnRenamed("a", "cid")
    labelled = classes.select("cid", "h1", "h2", "first", "copies").join(stars.withColumnRenamed("node", "cid"), "cid", "left").join(
        numbers, "cid", "left").select("h1", "h2", "first", F.coalesce("component", "cid").alias("label"),
                                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = grouped_for_join(labelled, ["label"], F.min("first").alias("component_id"))
    result = labelled.join(least, "label").select("h1", "h2", "n_links", "component_id")
    linked = rows.select("vec_id", "h1", "h2").join(result, ["h1", "h2"], "left")
    out = linked.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).cast("long").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
