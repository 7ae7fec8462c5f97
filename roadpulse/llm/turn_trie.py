"""Conversation prefix trie as burst tries over shards.

Every conversation c is rebuilt first: the first h turns of conversation ``c - c % 5``, then its own turns
after its first h, h being crc32(c as text) % 9. A node of the trie is a distinct sequence of first turns;
a turn is its role and text.

Rows carry a hash of all turns up to them, so a row names its node. Trie heads are nodes with more than
``CONTAINER_ROWS`` turns at or below them; the suffixes under all other nodes lie in containers. At first
all suffixes hang at the root; an oversized container bursts by the next turn id into one container for each
child, and those that are still oversized burst again. A round bursts as many levels as all rounds before it
and one more, so the rounds follow the logarithm of the deepest head. Heads are counted by aggregation, so a turn that
a third of all conversations share, or copies of one conversation, need no container. The containers that
remain are bounded; each is sorted by its turn ids and swept once from left to right into nodes.

What a head needs from below (leaves, saved bytes) is handed up by way of conversations: a node's own
share belongs to its smallest member, and a running sum along each conversation, deepest first, adds up what lies at or
below each of its nodes. The ids that end in a head are joined in chunks and hashed one chunk after another.

Turns are ordered by turn (null first), then role, then md5 of the text; null role and text are empty. Rows without a
conversation id take no part. Repeated rows are turns of their own. An empty table has no nodes, not even
a root. A long conversation is never gathered: its turns are numbered in slices. Turns are known by two 64-bit hashes,
nodes by two more. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.shared import arrow_rows, bounded_batches, folder, stored
from roadpulse.operators.ordered import ordered, with_row_number, with_running

BASE_EVERY = 5
MOST_TURNS = 9
#: Turns of the largest container.
CONTAINER_ROWS = 256
#: Ids that are hashed at once.
_CHUNK_IDS = 4096
_NODE = ("depth", "x", "y")
_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, px long, py long"
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_TURNS


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, side, pos, a, b, bytes) of the rebuilt turns in order of side and pos, and all ids."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        role.alias("role"),
        F.md5(text).alias("tie"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("turn"), text, role).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    numbered = stored(with_row_number(ordered(turns, ("turn", "role", "tie"), ("conv_id",)), "pos"), "numbered-turns")
    ids = numbered.where("pos = 1").select("conv_id")
    h, base = shared_turns(F.col("conv_id")), F.col("conv_id") - F.col("conv_id") % BASE_EVERY
    first = numbered.where((F.col("pos") < MOST_TURNS) & (F.col("conv_id") % BASE_EVERY == 0))
    first = first.select(F.col("conv_id").alias("base"), "pos", "a", "b", "bytes")
    taken = ids.select("conv_id", h.alias("h"), base.alias("base")).join(first, "base").where("pos <= h")
    own = numbered.where(F.col("pos") > h)
    parts = [rows.select("conv_id", F.lit(side).alias("side"), "pos", "a", "b", "bytes") for side, rows in enumerate((taken, own))]
    return parts[0].unionByName(parts[1]), ids


def _node(sums: list[Column], depth: Column) -> tuple[Column, Column]:
    return F.xxhash64(*sums, depth), F.xxhash64(F.lit("node"), depth, *reversed(sums))


def _level(depth: Column) -> Column:
    """The round that looks at this depth: 1, then 2 and 3, then 4 to 7, and so on."""
    return F.length(F.bin(depth)) - 1


def turn_rows(turns: DataFrame) -> DataFrame:
    """One row per rebuilt turn: its depth, the conversation's length, its node and the node's parent.

    A node's hash is a sum over its turns of a hash of turn and depth, in 31-bit pieces, so that sums
    along a conversation can be taken in slices.
    """
    steps = with_running(ordered(turns, ("side", "pos"), ("conv_id",)), count="depth", totals={"length": F.lit(1)})
    depth = F.col("depth")
    long = [F.xxhash64("a", "b", depth), F.xxhash64(F.lit("turn"), depth, "b", "a")]
    pieces = [p for k in long for p in (k.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(k, 33))]
    marked = steps.with_columns({f"_own{i}": p for i, p in enumerate(pieces)})
    run = with_running(marked, sums={f"_sum{i}": f"_own{i}" for i in range(len(pieces))}).result()
    sums = [F.col(f"_sum{i}") for i in range(len(pieces))]
    x, y = _node(sums, depth)
    px, py = _node([s - F.col(f"_own{i}") for i, s in enumerate(sums)], depth - 1)
    rows = run.select("conv_id", "depth", "length", x.alias("x"), y.alias("y"), px.alias("px"), py.alias("py"), "bytes", _level(depth).alias("level"))
    spark = rows.sparkSession
    path = f"{folder(spark)}/turn-rows-{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").partitionBy("level").parquet(path)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return spark.read.schema(kind).parquet(path)


@dataclass
class _Open:
    """A node whose members are still being swept."""

    depth: int
    first: int
    bytes: int
    px: int
    py: int
    convs: int = 0
    children: list[int] = field(default_factory=list)
    leaves: int = 0
    saved: int = 0
    ends: list[int] = field(default_factory=list)


class Sweep:
    """Nodes of one container after another; what is found is kept as columns."""

    def __init__(self) -> None:
        self.columns: list[list] = [[] for _ in _NODES.split(", ")]

    def _close(self, stack: list[_Open]) -> None:
        node = stack.pop()
        node.leaves += not node.children
        node.saved += (node.convs - 1) * node.bytes
        at = len(self.columns[0])
        for child in node.children:
            self.columns[2][child] = node.first
        ends = hashlib.sha256(",".join(map(str, sorted(node.ends))).encode()).hexdigest()
        values = (node.first, node.depth, None, node.convs, len(node.children), node.leaves, node.saved, ends, node.px, node.py)
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        if stack:
            above = stack[-1]
            above.convs += node.convs
            above.first = min(above.first, node.first)
            above.children.append(at)
            above.leaves += node.leaves
            above.saved += node.saved

    def container(self, rows: dict[str, list]) -> None:
        """Rows of all its suffixes, in order of conversation and depth."""
        conv, depth, x = rows["conv_id"], rows["depth"], rows["x"]
        heads = [i for i in range(len(conv)) if not i or conv[i] != conv[i - 1]]
        ends = [*heads[1:], len(conv)]
        suffixes = sorted(zip(heads, ends, strict=True), key=lambda s: x[s[0] : s[1]])
        stack: list[_Open] = []
        before: list[int] = []
        for a, b in suffixes:
            turns = x[a:b]
            same = 0
            while same < min(len(before), len(turns)) and before[same] == turns[same]:
                same += 1
            while len(stack) > same:
                self._close(stack)
            for i in range(a + same, b):
                stack.append(_Open(depth[i], conv[a], rows["bytes"][i], rows["px"][i], rows["py"][i]))
            top = stack[-1]
            top.convs += 1
            top.first = min(top.first, conv[a])
            top.ends.append(conv[a])
            before = turns
        while stack:
            self._close(stack)

    def taken(self) -> pa.RecordBatch:
        names = [f.split() for f in _NODES.split(", ")]
        batch = arrow_rows({n: pa.array(c, pa.string() if k == "string" else pa.int64()) for (n, k), c in zip(names, self.columns, strict=True)})
        self.columns = [[] for _ in names]
        return batch


def swept(rows: DataFrame) -> DataFrame:
    """Nodes of all containers; ``rows`` hold the container as ``cx``, ``cy``. A container's top has no parent yet."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, last = Sweep(), None, None
        for batch in batches:
            keys = list(zip(batch.column("cx").to_pylist(), batch.column("cy").to_pylist(), strict=True))
            columns = {c: batch.column(c).to_pylist() for c in ("conv_id", "depth", "x", "bytes", "px", "py")}
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if held is not None and last != keys[at]:
                    found.container(held)
                    held = None
                if held is None:
                    held, last = {c: [] for c in columns}, keys[at]
                for c, values in columns.items():
                    held[c] += values[at:end]
                at = end
            yield found.taken()
        if held is not None:
            found.container(held)
            yield found.taken()

    near = rows.repartition("cx", "cy").sortWithinPartitions("cx", "cy", "conv_id", "depth")
    return near.mapInArrow(sweep, _NODES)


def id_digests(ends: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256) of the ids of each node, whatever their number.

    Ids are ranged by node and id; runs of them become one text each, and a node's texts pass one hash in order.
    """
    spark = ends.sparkSession
    keys = [F.col(c) for c in (*_NODE, "conv_id")]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, x, y, ids = (c.to_pylist() for c in batch.columns)
            cuts = [i for i in range(len(ids)) if not i or (depth[i], x[i], y[i]) != (depth[i - 1], x[i - 1], y[i - 1])]
            cuts = sorted({*cuts, *range(0, len(ids), _CHUNK_IDS)})
            text = [",".join(map(str, ids[a:b])) for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True)]
            yield arrow_rows({**{n: pa.array([v[i] for i in cuts], pa.int64()) for n, v in (("depth", depth), ("x", x), ("y", y), ("start", ids))}, "ids": pa.array(text, pa.string())})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for *node, text in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True):
                if node != last:
                    if state:
                        out.append((*last, state.hexdigest()))
                    last, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
            yield rows(out)
        if state:
            yield rows([(*last, state.hexdigest())])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return arrow_rows({n: pa.array(c, pa.string() if n == "ends_sha256" else pa.int64()) for n, c in zip((*_NODE, "ends_sha256"), columns, strict=True)})

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = ends.select(*keys).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    texts = ranged.mapInArrow(chunks, "depth long, x long, y long, start long, ids string")
    near = texts.repartition(*_NODE).sortWithinPartitions(*_NODE, "start")
    return near.mapInArrow(digest, "depth long, x long, y long, ends_sha256 string")


def burst(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The heads below the root (depth, x, y, conv_id, n_convs, bytes, px, py), and the rows at them."""
    heads, inside, level, active = [], [], 0, None
    while True:
        here = rows.where(F.col("level") == level)
        if active is not None:
            here = here.join(active, "conv_id", "left_semi")
        below = F.sum(F.col("length") - F.col("depth") + 1)
        counted = here.groupBy(*_NODE).agg(below.alias("below"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in ("bytes", "px", "py")])
        heads.append(stored(counted.where(F.col("below") > most).drop("below"), "trie-heads"))
        at = here.join(heads[-1].select(*_NODE), list(_NODE), "left_semi")
        inside.append(stored(at.select("conv_id", "length", *_NODE), "head-rows"))
        deepest = (1 << (level + 1)) - 1
        active = inside[-1].where((F.col("depth") == deepest) & (F.col("length") > deepest)).select("conv_id")
        if active.isEmpty():
            return tuple(reduce(DataFrame.unionByName, x) for x in (heads, inside))
        level += 1


def trie(conversations: DataFrame, most: int = CONTAINER_ROWS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    bounded_batches(conversations.sparkSession)
    turns, ids = rebuilt(conversations)
    rows = turn_rows(turns)
    heads, inside = burst(rows, most)

    zero, top = [F.lit(0).cast("long")] * 4, F.lit(0).cast("long")
    x, y = _node(zero, top)
    root = ids.select(top.alias("depth"), x.alias("x"), y.alias("y"), "conv_id")
    none = F.lit(None).cast("long")
    whole = root.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    heads = stored(whole.withColumns({"bytes": top, "px": none, "py": none}).unionByName(heads), "all-heads")

    # Where each conversation leaves the heads, and the container it enters there.
    left = inside.groupBy("conv_id").agg(F.max("depth").alias("last"))
    outside = rows.join(heads.select(*_NODE), list(_NODE), "left_anti")
    entered = outside.join(left, "conv_id", "left").where(F.col("depth") == F.coalesce("last", F.lit(0)) + 1)
    entered = stored(entered.select("conv_id", F.col("x").alias("cx"), F.col("y").alias("cy")), "containers")
    nodes = stored(swept(outside.join(entered, "conv_id").drop("level", "length", "y")), "container-nodes")
    tops = nodes.where("parent_conv_id is null")

    children = tops.select(F.col("depth") - 1, "px", "py").union(heads.where("depth > 0").select(F.col("depth") - 1, "px", "py")).toDF(*_NODE)
    known = stored(heads.join(children.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children")), list(_NODE), "left").fillna(0, ["n_children"]), "heads-with-children")

    # Own shares of heads and whole shares of containers, along the conversations, deepest first.
    own = known.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    shares = own.unionByName(tops.select("conv_id", "depth", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
    shares = shares.withColumns({"kind": F.lit(0), "x": none, "y": none})
    asked = inside.select(*_NODE, "conv_id").unionByName(root).withColumns({"kind": F.lit(1), "leaves": top, "saved": top})
    along = asked.unionByName(shares).withColumn("up", -F.col("depth"))
    run = with_running(ordered(along, ("up", "kind"), ("conv_id",)), sums={"all_leaves": "leaves", "all_saved": "saved"}).result()
    totals = run.where("kind = 1").groupBy(*_NODE).agg(F.sum("all_leaves").alias("n_leaves"), F.sum("all_saved").alias("saved_tokens"))

    turnless = ids.join(rows.where("depth = 1").select("conv_id"), "conv_id", "left_anti")
    ended = inside.where("depth = length").select(*_NODE, "conv_id").unionByName(root.join(turnless, "conv_id", "left_semi"))
    found = known.join(totals, list(_NODE)).join(id_digests(ended), list(_NODE), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    upper = found.select("conv_id", "depth", none.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "px", "py")

    # Parents of the heads and of the containers' tops are heads.
    above = heads.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent"))
    open_ = upper.unionByName(tops).join(above, ["depth", "px", "py"], "left").withColumn("parent_conv_id", F.col("parent"))
    names = [f.split()[0] for f in NODES.split(", ")]
    return nodes.where("parent_conv_id is not null").select(*names).unionByName(open_.select(*names))
