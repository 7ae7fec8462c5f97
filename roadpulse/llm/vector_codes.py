"""Vector code compression: product codes whose codebooks are learnt over metric trees of parts.

Each component x becomes the integer floor(1024 * x); a vector is cut into equal consecutive parts, and
each part position has a codebook of its own. Rows are cut into blocks of a bounded size. A block keeps one
metric tree for each part position, built once from the middle out by the anchors hierarchy: about sqrt(n)
anchors take the points nearest to them, each new one at the point farthest from its anchor; anchors
are joined two by two to larger balls, and those with many points are cut again in the same way. A ball caches
number and sum of its points.

A round sends the codebook down all trees. A ball inherits the entries that may still own some of its
points from the ball around it and strikes out each that some other entry beats everywhere in the ball.
A ball with one entry left is owned as a whole and adds its cached sum and number; only points of the smallest
balls are compared one by one, with the entries that are left there. Blocks add up by task, then by
entry in Spark. All sums are whole numbers, so results do not depend on the order of rows or blocks.

What reaches the driver and is broadcast is the codebook: 256 vectors.

Rows with a null vector, or one that holds null or non-finite components, are dropped. So are rows whose vector has not
the length of the kept vector with the smallest id (the lexicographically smallest one, if that id
repeats), or all rows if that length is no positive multiple of the number of parts. Integers are held at a bound that
keeps squared distances within 64 bits (2^28 for 64 components). Ids that repeat start one entry, the smallest
vector's; all their rows are coded. A null id starts no entry and is coded with a null id. With fewer ids than
entries the codebooks are smaller; without any id nothing can be coded and the result is empty. Only id, vector
and label are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.shared import arrow_rows, bounded_batches, by_batch, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Vectors of a block, and points of a ball that is not cut further.
BLOCK = 1024
LEAF = 32
#: Whole numbers below this are exact in 64-bit floating point.
_EXACT = 1 << 52


def largest(dimension: int) -> int:
    """The bound of components for which squared distances of whole vectors fit 64 bits."""
    return 1 << ((60 - math.ceil(math.log2(max(dimension, 1)))) // 2)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    high = max((int(np.abs(x).max()) for x in (points, entries) if x.size), default=0)
    if 4 * high * high * points.shape[1] < _EXACT:
        a, b = points.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(points), len(entries)), np.int64)
    for d in range(points.shape[1]):
        out += (points[:, d, None] - entries[None, :, d]) ** 2
    return out


class Tree:
    """A metric tree over the points of one block and part position; node 0 is the root.

    Nodes are balls: center, radius, number and sum of points, and either two children or, in a leaf,
    a run of ``order``.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self.leaf = points, leaf
        self.nodes: list[tuple] = []
        runs: list[np.ndarray] = []
        self._runs, self._at = runs, 0
        root = self._middle_out(np.arange(len(points)))
        self.order = np.concatenate(runs)
        places = [root]
        for at in places:  # parents before children, the root first
            if self.nodes[at][4] >= 0:
                places += self.nodes[at][4:6]
        place = {node: i for i, node in enumerate(places)}
        kept = [self.nodes[at] for at in places]
        self.center = np.array([n[0] for n in kept])
        self.radius = np.array([n[1] for n in kept])
        self.count = np.array([n[2] for n in kept], np.int64)
        self.sums = np.array([n[3] for n in kept], np.int64)
        self.children = np.array([[place.get(n[4], -1), place.get(n[5], -1)] for n in kept], np.int64)
        self.run = np.array([n[6:8] for n in kept], np.int64)

    def _ball(self, rows: np.ndarray) -> int:
        held = self.points[rows]
        center = held.mean(axis=0)
        radius = math.sqrt(((held - center) ** 2).sum(axis=1).max())
        self._runs.append(rows)
        self.nodes.append((center, radius, len(rows), held.sum(axis=0), -1, -1, self._at, self._at + len(rows)))
        self._at += len(rows)
        return len(self.nodes) - 1

    def _joined(self, a: int, b: int) -> int:
        (ca, ra, na, sa, *_), (cb, rb, nb, sb, *_) = self.nodes[a], self.nodes[b]
        center = (sa + sb) / (na + nb)
        radius = max(np.linalg.norm(center - ca) + ra, np.linalg.norm(center - cb) + rb)
        self.nodes.append((center, float(radius), na + nb, sa + sb, a, b, -1, -1))
        return len(self.nodes) - 1

    def _anchored(self, rows: np.ndarray) -> list[np.ndarray]:
        """The rows by anchor. A point can only move to a new anchor if it is farther from its own
        than half the way between the two, so nearer ones are not looked at."""
        points = self.points[rows].astype(np.float64)
        anchors = [points[0]]
        owner = np.zeros(len(rows), np.int64)
        far = np.sqrt(((points - anchors[0]) ** 2).sum(axis=1))
        for new in range(1, math.isqrt(len(rows) - 1) + 1):
            farthest = int(far.argmax())
            if far[farthest] == 0:
                break
            pivot = points[farthest]
            half = np.sqrt(((np.array(anchors) - pivot) ** 2).sum(axis=1)) / 2
            asked = np.flatnonzero(far >= half[owner])
            away = np.sqrt(((points[asked] - pivot) ** 2).sum(axis=1))
            taken = away < far[asked]
            owner[asked[taken]], far[asked[taken]] = new, away[taken]
            anchors.append(pivot)
        order = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[order])) + 1
        return [rows[x] for x in np.split(order, cuts)]

    def _middle_out(self, rows: np.ndarray) -> int:
        """Anchors below, joined balls above; the two whose joint ball is smallest join first."""
        groups = self._anchored(rows) if len(rows) > self.leaf else [rows]
        if len(groups) == 1:
            return self._ball(rows)
        balls = [self._middle_out(g) for g in groups]
        size = len(balls)
        center = np.array([self.nodes[b][0] for b in balls])
        radius = np.array([self.nodes[b][1] for b in balls])
        away = np.sqrt(np.maximum(((center[:, None, :] - center[None, :, :]) ** 2).sum(axis=2), 0))
        joint = (away + radius[:, None] + radius[None, :]) / 2
        joint[np.arange(size), np.arange(size)] = np.inf
        for _ in range(size - 1):
            a, b = divmod(int(joint.argmin()), size)
            balls[a] = self._joined(balls[a], balls[b])
            center[a], radius[a] = self.nodes[balls[a]][:2]
            joint[b, :] = joint[:, b] = np.inf
            live = np.isfinite(joint[a])
            live[a] = False
            joint[a, live] = (np.sqrt(((center[live] - center[a]) ** 2).sum(axis=1)) + radius[live] + radius[a]) / 2
            joint[live, a] = joint[a, live]
        return balls[a]

    FIELDS = (("order", np.int32), ("center", np.float64), ("radius", np.float64), ("count", np.int32), ("sums", np.int64), ("children", np.int32), ("run", np.int32))

    def packed(self) -> bytes:
        """Sizes, then points in their first order, then the arrays of the nodes."""
        head = np.array([len(self.points), self.points.shape[1], len(self.radius)], np.int64)
        return b"".join([head.tobytes(), self.points.astype(np.int32).tobytes(), *(getattr(self, n).astype(t).tobytes() for n, t in self.FIELDS)])

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        n, dimension, nodes = np.frombuffer(data, np.int64, 3).tolist()
        at = 24

        def take(kind: type, *shape: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, math.prod(shape), at).reshape(shape)
            at += got.nbytes
            return got

        tree.points = take(np.int32, n, dimension).astype(np.int64)
        shapes = ((n,), (nodes, dimension), (nodes,), (nodes,), (nodes, dimension), (nodes, 2), (nodes, 2))
        for (name, kind), shape in zip(cls.FIELDS, shapes, strict=True):
            setattr(tree, name, take(kind, *shape))
        return tree

    def owned(self, entries: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, np.ndarray]]]:
        """(ball, entry) of the balls that one entry owns, and (leaf, entries left) of the rest.

        ``entries`` are distinct. An entry leaves the list if another is nearer everywhere in the ball, by more
        than rounding can hide; equally near ones stay, so that ties are settled point by point.
        """
        codes = entries.astype(np.float64)
        apart = np.sqrt(np.maximum(distances(entries, entries), 0).astype(np.float64))
        whole, open_ = [], []
        level = np.zeros(1, np.int64)
        left = np.ones((1, len(entries)), bool)
        while len(level):
            center, radius = self.center[level], self.radius[level]
            away = ((center[:, None, :] - codes[None, :, :]) ** 2).sum(axis=2)
            away[~left] = np.inf
            best = away.argmin(axis=1)
            least = away[np.arange(len(level)), best]
            slack = 1e-3 + 1e-9 * (least[:, None] + np.where(left, away, 0))
            beaten = away - least[:, None] > 2 * radius[:, None] * apart[best] * (1 + 1e-9) + slack
            left = left & ~beaten
            alone = left.sum(axis=1) == 1
            whole += zip(level[alone].tolist(), best[alone].tolist(), strict=True)
            level, left = level[~alone], left[~alone]
            leaf = self.children[level, 0] < 0
            open_ += [(int(n), np.flatnonzero(x)) for n, x in zip(level[leaf], left[leaf], strict=True)]
            level, left = self.children[level[~leaf]].reshape(-1).astype(np.int64), np.repeat(left[~leaf], 2, axis=0)
        return whole, open_

    def _inside(self, ball: int) -> np.ndarray:
        """The points of a ball, by the runs of its leaves."""
        rows, todo = [], [ball]
        while todo:
            at = todo.pop()
            if self.children[at, 0] < 0:
                rows.append(self.order[self.run[at, 0] : self.run[at, 1]])
            else:
                todo += self.children[at].tolist()
        return np.concatenate(rows)

    def _settled(self, leaf: int, left: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self.order[self.run[leaf, 0] : self.run[leaf, 1]]
        return rows, left[distances(self.points[rows], entries[left]).argmin(axis=1)]

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the points of each entry."""
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        whole, open_ = self.owned(entries)
        for ball, entry in whole:
            sums[entry] += self.sums[ball]
            counts[entry] += self.count[ball]
        for leaf, left in open_:
            rows, nearest = self._settled(leaf, left, entries)
            np.add.at(sums, nearest, self.points[rows])
            np.add.at(counts, nearest, 1)
        return sums, counts

    def assigned(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each point, and its squared distance."""
        code = np.zeros(len(self.points), np.int64)
        whole, open_ = self.owned(entries)
        for ball, entry in whole:
            code[self._inside(ball)] = entry
        for leaf, left in open_:
            rows, nearest = self._settled(leaf, left, entries)
            code[rows] = nearest
        return code, ((self.points - entries[code]) ** 2).sum(axis=1)


def first_places(entries: np.ndarray) -> np.ndarray:
    """Places of the distinct entries, each at its lowest: equal later ones lose every tie."""
    return np.sort(np.unique(entries, axis=0, return_index=True)[1])


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the rows whose vector is usable, with whole numbers."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    scaled = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), v.cast("double") * SCALE))))
    read = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    return read.where(x.isNotNull() & finite).select("vec_id", "label", scaled.cast("array<long>").alias("v"))


def blocks(kept: DataFrame, dimension: int, parts: int, block: int, leaf: int) -> DataFrame:
    """Rows of a block, and its trees; rows are taken as they lie."""
    bound = largest(dimension)

    def build(ids: list[pa.Array], labels: list[pa.Array], values: list[np.ndarray]) -> pa.RecordBatch:
        held = np.concatenate(values)
        trees = [Tree(p, leaf).packed() for p in np.split(held, parts, axis=1)]
        ids, labels = (pa.concat_arrays(x) for x in (ids, labels))
        one = np.array([0, len(held)], np.int32)
        columns = {"ids": pa.ListArray.from_arrays(one, ids), "labels": pa.ListArray.from_arrays(one, labels)}
        return arrow_rows(columns | {f"tree{i}": pa.array([t], pa.binary()) for i, t in enumerate(trees)})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, values, n = [], [], [], 0
        for batch in batches:
            v = np.clip(batch.column(2).flatten().to_numpy().reshape(batch.num_rows, dimension), -bound, bound)
            at = 0
            while at < len(v):
                take = min(block - n, len(v) - at)
                for held, column in ((ids, batch.column(0)), (labels, batch.column(1))):
                    held.append(column.slice(at, take))
                values.append(v[at : at + take])
                n, at = n + take, at + take
                if n == block:
                    yield build(ids, labels, values)
                    ids, labels, values, n = [], [], [], 0
        if n:
            yield build(ids, labels, values)

    names = ", ".join(f"tree{i} binary" for i in range(parts))
    return kept.mapInArrow(rows, f"ids array<long>, labels array<long>, {names}")


def _totals(trees: DataFrame, codebook: list[np.ndarray], dimension: int) -> list:
    """One row per part position and entry that owns points: its number and sums."""
    places = [first_places(c) for c in codebook]
    held = trees.sparkSession.sparkContext.broadcast((codebook, places))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, at = held.value
        sums = [np.zeros(c.shape, np.int64) for c in books]
        counts = [np.zeros(len(c), np.int64) for c in books]
        for batch in batches:
            for part, (book, place) in enumerate(zip(books, at, strict=True)):
                for tree in batch.column(f"tree{part}"):
                    s, n = Tree.unpacked(tree.as_buffer().to_pybytes()).totals(book[place])
                    sums[part][place] += s
                    counts[part][place] += n
        for part, (s, n) in enumerate(zip(sums, counts, strict=True)):
            used = np.flatnonzero(n)
            if len(used):
                flat = pa.ListArray.from_arrays(np.arange(0, s.shape[1] * len(used) + 1, s.shape[1], dtype=np.int32), pa.array(s[used].reshape(-1)))
                yield arrow_rows({"part": np.full(len(used), part), "entry": used, "n": n[used], "s": flat})

    found = trees.mapInArrow(rows, "part long, entry long, n long, s array<long>")
    each = [F.sum(F.col("s")[d]).alias(f"s{d}") for d in range(dimension)]
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect()


def learnt(trees: DataFrame, codebook: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after the rounds; entries that own nothing stay."""
    for _ in range(rounds):
        codebook = [c.copy() for c in codebook]
        for row in _totals(trees, codebook, codebook[0].shape[1]):
            part, entry, n, *sums = row
            codebook[part][entry] = [s // n for s in sums]
    return codebook


def digest(codebook: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for c in codebook for x in c.reshape(-1).tolist()).encode()).hexdigest()


def coded(trees: DataFrame, codebook: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of every row of the blocks."""
    held = trees.sparkSession.sparkContext.broadcast((codebook, [first_places(c) for c in codebook]))

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        books, at = held.value
        for i in range(batch.num_rows):
            ids, labels = (batch.column(c)[i].values for c in ("ids", "labels"))
            code, error = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for part, (book, place) in enumerate(zip(books, at, strict=True)):
                nearest, away = Tree.unpacked(batch.column(f"tree{part}")[i].as_buffer().to_pybytes()).assigned(book[place])
                code = code * 256 + place[nearest]
                error += away
            text = pa.array([f"{c:0{2 * len(books)}x}" for c in code.tolist()])
            yield arrow_rows({"vec_id": ids, "label": labels, "code": text, "error": error})

    return trees.mapInArrow(by_batch(rows), "vec_id long, label long, code string, error long")


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK, leaf: int = LEAF) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of all usable rows, and the codebooks (at most 256 entries each)."""
    spark = bounded_batches(vectors.sparkSession)
    kept = whole_numbers(vectors)
    least = kept.agg(F.min("vec_id")).first()[0]
    shortest = kept.where(F.col("vec_id") == least).agg(F.min("v")).first()[0] if least is not None else None
    dimension = len(shortest or [])
    if not dimension or dimension % parts:
        return spark.createDataFrame([], "vec_id long, label long, code string, error long"), []
    kept = kept.where(F.size("v") == dimension)
    ids = [r.vec_id for r in kept.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    first = kept.where(F.col("vec_id") <= ids[-1]).groupBy("vec_id").agg(F.min("v").alias("v")).collect()
    start = np.array([r.v for r in sorted(first, key=lambda r: r.vec_id)], np.int64)
    bound = largest(dimension)
    codebook = np.split(np.clip(start, -bound, bound), parts, axis=1)
    trees = stored(blocks(kept, dimension, parts, block, leaf), "vector-trees")
    codebook = learnt(trees, codebook, rounds)
    return coded(trees, codebook), codebook


def reported(vectors: DataFrame) -> DataFrame:
    """Codes with their errors, the errors by label, and the digest of the codebooks."""
    rows, codebook = compressed(vectors)
    rows = stored(rows, "vector-codes")
    labels = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(labels, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(codebook)).alias("codebooks_sha256"))
