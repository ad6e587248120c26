"""A prefix trie of conversations, from adaptive radix trees over ranges of them."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import discard, ship, staged
from snapledger.session import broadcast_if_small

# Bytes of a turn's id: the front of the SHA-256 of role and text, high bytes first.
WIDTH = 16
# Turns in the paths of one tree, on average.
TREE_TURNS = 200_000
# Children that a node's layout has room for, before it grows into the next.
LAYOUTS = (4, 16, 48, 256)
NOTHING = hashlib.sha256(b"").digest()

NODE = "depth long, convs long, least long, children long, leaves long, saved long, ends binary"
SPINE = f"path: binary, nodes: array<struct<{NODE}, chars long>>"
TREE = f"part int, side int, above int, parent long, node struct<{NODE}>, spine struct<{SPINE}>"


class Node:
    """A node of a radix tree: a compressed path, then up to 256 children by their byte.

    Layouts of 4 and 16 list the bytes beside the children; one of 48 has an index of
    256 bytes into them; one of 256 has a place for every byte.
    """

    __slots__ = ("path", "end", "layout", "bytes", "children")

    def __init__(self, path: bytes, end: int = -1):
        self.path, self.end, self.layout = path, end, 0
        self.bytes, self.children = bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout == 3:
            return self.children[byte]
        if self.layout == 2:
            place = self.bytes[byte]
            return self.children[place - 1] if place else None
        place = self.bytes.find(byte)
        return self.children[place] if place >= 0 else None

    def add(self, byte: int, child: Node) -> None:
        """``child`` under a byte that has none; keys come in order, so it goes last."""
        if self.layout < 3 and len(self.children) == LAYOUTS[self.layout]:
            self.grow()
        if self.layout == 3:
            self.children[byte] = child
            return
        self.children.append(child)
        if self.layout == 2:
            self.bytes[byte] = len(self.children)
        else:
            self.bytes.append(byte)

    def grow(self) -> None:
        """The next larger layout, with the same children."""
        if self.layout == 1:
            index = bytearray(256)
            for place, byte in enumerate(self.bytes):
                index[byte] = place + 1
            self.bytes = index
        elif self.layout == 2:
            children: list = [None] * 256
            for byte, place in enumerate(self.bytes):
                if place:
                    children[byte] = self.children[place - 1]
            self.bytes, self.children = bytearray(), children
        self.layout += 1

    def split(self, at: int) -> None:
        """Ends the compressed path at ``at``; what was below becomes the only child."""
        below = Node(self.path[at + 1 :], self.end)
        below.layout, below.bytes, below.children = self.layout, self.bytes, self.children
        byte, self.path = self.path[at], self.path[:at]
        self.end, self.layout, self.bytes, self.children = -1, 0, bytearray(), []
        self.add(byte, below)


def common(a: bytes, b: bytes) -> int:
    """Length of the common front."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def insert(root: Node, key: bytes, value: int) -> None:
    node, at = root, 0
    while True:
        same = common(node.path, key[at : at + len(node.path)])
        if same < len(node.path):
            node.split(same)
        at += same
        if at == len(key):
            node.end = value
            return
        below = node.child(key[at])
        if below is None:
            node.add(key[at], Node(key[at + 1 :], value))
            return
        node, at = below, at + 1


class Below:
    """What is known of the part of a tree below some byte of a path."""

    __slots__ = ("convs", "least", "leaves", "saved", "tops", "first", "last")

    def __init__(self):
        self.convs, self.least, self.leaves, self.saved = 0, None, 0, 0
        # Complete nodes that still wait for their parent, and the paths covered.
        self.tops: list[int] = []
        self.first, self.last = math.inf, -1

    def add(self, other: Below) -> None:
        self.convs += other.convs
        self.least = other.least if self.least is None else min(self.least, other.least)
        self.leaves += other.leaves
        self.saved += other.saved
        self.tops += other.tops
        self.first, self.last = min(self.first, other.first), max(self.last, other.last)


class Tree:
    """The radix tree of sorted distinct paths, and the turn nodes that it has.

    A node on the way to the first or last path may go on in another task's range. Such
    nodes are kept apart as the two spines of this range, without what lies on a spine
    below them; all others are complete.
    """

    def __init__(self):
        self.root = Node(b"")
        self.paths: list[tuple] = []

    def add(self, path: bytes, chars: np.ndarray, convs: int, least: int, ends: bytes) -> None:
        if self.paths:
            insert(self.root, path, len(self.paths))
        else:
            self.root = Node(path, 0)
        self.paths.append((path, chars, convs, least, ends))

    def nodes(self):
        """Columns of the complete nodes, and the two spines as lists by depth."""
        final = len(self.paths) - 1
        self.rows: list[list] = []
        self.spines: tuple[list, list] = ([], [])
        top = self.root
        stack = [(top, 0, iter([c for c in top.children if c]), Below())]
        while stack:
            node, start, children, below = stack[-1]
            after = start + len(node.path)
            child = next(children, None)
            if child is not None:
                stack.append((child, after + 1, iter([c for c in child.children if c]), Below()))
                continue
            stack.pop()
            self.close(node, start, after, below, final)
            if stack:
                stack[-1][3].add(below)
        for spine in self.spines:
            spine.reverse()
        return self.rows, self.spines

    def close(self, node: Node, start: int, after: int, below: Below, final: int) -> None:
        """Emits the nodes at the turn-aligned bytes of a compressed path, deepest first.

        The path and the byte that leads to it cover the bytes from ``start`` on; the
        root covers byte 0 as well.
        """
        if node.end >= 0:
            _, _, convs, least, _ = self.paths[node.end]
            below.convs += convs
            below.least = least if below.least is None else min(below.least, least)
            below.first, below.last = min(below.first, node.end), max(below.last, node.end)
        first_aligned = -(-start // WIDTH) * WIDTH
        for byte in range(after // WIDTH * WIDTH, first_aligned - 1, -WIDTH):
            depth = byte // WIDTH
            chars = int(self.paths[below.first][1][depth - 1]) if depth else 0
            ends = self.paths[node.end][4] if node.end >= 0 and byte == after else NOTHING
            row = [depth, below.convs, below.least, len(below.tops), below.leaves, below.saved, ends]
            side = 0 if below.first == 0 else 1 if below.last == final else None
            if side is not None:
                for at in below.tops:
                    self.rows[at][:3] = [side, depth, None]
                self.spines[side].append([*row, chars])
                below.leaves, below.saved, below.tops = 0, 0, []
                continue
            if not below.tops:
                row[4] = below.leaves = 1
            row[5] = below.saved = below.saved + (below.convs - 1) * chars
            for at in below.tops:
                self.rows[at][:3] = [None, None, below.least]
            below.tops = [len(self.rows)]
            self.rows.append([None, None, None, *row])


NODE_TYPE = pa.struct(
    [(n, pa.int64()) for n in ("depth", "convs", "least", "children", "leaves", "saved")]
    + [("ends", pa.binary())]
)
SPINE_TYPE = pa.struct(
    [
        ("path", pa.binary()),
        ("nodes", pa.list_(pa.struct([*NODE_TYPE, ("chars", pa.int64())]))),
    ]
)
# Nodes that leave a task at a time.
ROWS = 20_000


def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The complete nodes of a range of sorted paths, and its two spines."""
    tree = Tree()
    for batch in batches:
        lists = batch["chars"]
        for at, (path, convs, least, ends) in enumerate(
            zip(*(batch[n].to_pylist() for n in ("path", "convs", "least", "ends")))
        ):
            tree.add(path, lists[at].values.to_numpy(zero_copy_only=False), convs, least, ends)
    if not tree.paths:
        return
    part = TaskContext.get().partitionId()
    rows, spines = tree.nodes()
    names = NODE_TYPE.names
    for start in range(0, len(rows), ROWS):
        some = list(zip(*rows[start : start + ROWS]))
        node = pa.StructArray.from_arrays(
            [pa.array(some[3 + i], NODE_TYPE[i].type) for i in range(len(names))], names
        )
        yield tree_rows(part, some[0], some[1], some[2], node, None)
    kept = []
    for side, place in ((0, 0), (1, len(tree.paths) - 1)):
        nodes = [dict(zip([*names, "chars"], n)) for n in spines[side]]
        if nodes:
            kept.append((side, {"path": tree.paths[place][0], "nodes": nodes}))
    yield tree_rows(part, [s for s, _ in kept], None, None, None, [spine for _, spine in kept])


def tree_rows(part, side, above, parent, node, spine) -> pa.RecordBatch:
    n = len(side)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * n, pa.int32()),
            pa.array(side, pa.int32()),
            pa.array(above, pa.int32()) if above else pa.nulls(n, pa.int32()),
            pa.array(parent, pa.int64()) if parent else pa.nulls(n, pa.int64()),
            pa.nulls(n, NODE_TYPE) if node is None else node,
            pa.nulls(n, SPINE_TYPE) if spine is None else pa.array(spine, SPINE_TYPE),
        ],
        names=["part", "side", "above", "parent", "node", "spine"],
    )


class Open:
    """A node on the spines that further ranges may add to."""

    __slots__ = ("depth", "convs", "least", "children", "leaves", "saved", "ends", "chars", "refs", "waiting")

    def __init__(self, node: dict):
        self.depth, self.chars, self.ends = node["depth"], node["chars"], NOTHING
        self.convs, self.least, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.refs: list[tuple] = []
        self.waiting: list[tuple] = []

    def merge(self, node: dict, ref: tuple) -> None:
        self.convs += node["convs"]
        self.least = node["least"] if self.least is None else min(self.least, node["least"])
        self.children += node["children"]
        self.leaves += node["leaves"]
        self.saved += node["saved"]
        self.ends = self.ends if node["ends"] == NOTHING else node["ends"]
        self.refs.append(ref)


JOINED = f"part int, side int, above int, parent long, {NODE}"


def join_spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes on the spines of all ranges, in the order of ranges, with what belongs to one
    node brought together; each with the places (range, side, depth) that it stands at.

    Nodes that the next path does not pass are finished, so only one path is open.
    """
    path: bytes = b""
    opened: list[Open] = []
    done: list[tuple] = []
    nowhere = (None, None, None)

    def close() -> None:
        node = opened.pop()
        if not node.children:
            node.leaves = 1
        node.saved += (node.convs - 1) * node.chars
        values = (node.depth, node.convs, node.least, node.children, node.leaves, node.saved, node.ends)
        done.extend((*nowhere, node.least, *child) for child in node.waiting)
        if opened:
            above = opened[-1]
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            above.waiting.append(values)
        else:
            done.append((*nowhere, None, *values))
        # Where complete nodes of the ranges find the node above them.
        none = (None,) * len(values)
        done.extend((*ref, node.least, *none) for ref in node.refs)

    def out() -> pa.RecordBatch:
        columns = list(zip(*done))
        kinds = [pa.int32()] * 3 + [pa.int64()] * 7 + [pa.binary()]
        names = ["part", "side", "above", "parent", *NODE_TYPE.names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        for row in batch.to_pylist():
            spine = row["spine"]
            same = common(path, spine["path"]) // WIDTH
            while len(opened) > same + 1:
                close()
            for node in spine["nodes"]:
                if node["depth"] == len(opened):
                    opened.append(Open(node))
                opened[node["depth"]].merge(node, (row["part"], row["side"], node["depth"]))
            path = spine["path"]
            if len(done) > ROWS:
                yield out()
                done.clear()
    while opened:
        close()
    if done:
        yield out()


def ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each path of sorted (path, conv_id): members, smallest, SHA-256 of them all.

    Ids are hashed as they pass, so that a path of very many conversations needs no room.
    """
    path, seen, least, digest = None, 0, 0, None

    def out(rows) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "convs", "ends"]
        )

    for batch in batches:
        rows = []
        for key, conv in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist()):
            if key != path:
                if seen:
                    rows.append((least, seen, digest.digest()))
                path, seen, least, digest = key, 0, conv, hashlib.sha256()
            digest.update(f",{conv}".encode() if seen else str(conv).encode())
            seen += 1
        if rows:
            yield out(rows)
    if seen:
        yield out([(least, seen, digest.digest())])


def turn_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of every conversation in order, as ids and lengths.

    Texts go no further than this; a turn is its id and its number of code points.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length in front keeps role and text apart, whatever they hold.
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    front = F.unhex(F.substring(F.sha2(said, 256), 1, 2 * WIDTH))
    order = F.struct(
        F.col("turn").isNotNull().alias("numbered"),
        F.col("turn"),
        role.alias("role"),
        # Equal turns stand in the order of their texts, which are not kept for it.
        F.sha2(text, 256).alias("text"),
        front.alias("id"),
        F.length(text).alias("chars"),
    )
    told = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), order.alias("turn")
    )
    return told.groupBy("conv_id").agg(
        F.transform(
            F.array_sort(F.collect_list("turn")),
            lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars")),
        ).alias("turns")
    )


def with_shared_openings(paths: DataFrame, family: int = 100, longest: int = 6) -> DataFrame:
    """Conversations whose first turns are those of their family's first conversation.

    Conversation c takes the first h turns of c - c % ``family`` (all if fewer, none if it
    does not exist), then its own behind its first h, h being crc32(decimal c) %
    ``longest``. ``%`` keeps the sign of c.
    """
    conv = F.col("conv_id")
    h = (F.crc32(conv.cast("string").cast("binary")) % longest).cast("int")
    openings = paths.where(conv % family == 0).select(
        conv.alias("source"), F.slice("turns", 1, longest).alias("opening")
    )
    none = F.array().cast(paths.schema["turns"].dataType)
    return (
        paths.withColumns({"h": h, "source": conv - conv % family})
        .join(openings, "source", "left")
        .select(
            "conv_id",
            F.concat(
                F.slice(F.coalesce("opening", none), F.lit(1), F.col("h")),
                F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))),
            ).alias("turns"),
        )
    )


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row for every distinct sequence of first turns of ``paths`` (``conv_id, turns``).

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the node above (null at
    the root), ``depth`` the number of turns, ``n_convs`` the members, ``n_children`` and
    ``n_leaves`` the nodes right below and the childless nodes of the subtree (a childless
    node is its own), ``saved_tokens`` the code points that sharing saves in the subtree,
    ``ends_sha256`` the digest of the members that end at the node. A conversation without
    turns ends at the root; without any conversation there is no node, no root either.
    Each conv_id occurs once; a conversation's ids have to fit into one value, 16 bytes a
    turn.

    Distinct paths are sorted and cut into ranges; a task builds an adaptive radix tree of
    each. Conversations alike are counted before that, so a path of very many has one row,
    and a range is the same length however many share a prefix: a hot prefix is cut like
    any other place. Nodes that several ranges share lie on the way to the first or last
    path of a range; these few, two paths a range, are joined one path after the other.
    The SHA-256 of the members of one node can only be taken in their order: that is one
    task's stream of ids for each node, with nothing kept.
    """
    spark = paths.sparkSession
    ship(spark)
    whole, whole_path = staged(
        paths.select(
            "conv_id",
            F.unhex(
                F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")
            ).alias("path"),
            F.transform("turns", lambda t: t["chars"]).alias("chars"),
        ),
        "paths",
    )
    members = (
        whole.select(F.unhex(F.sha2("path", 256)).alias("key"), "conv_id")
        .repartition("key")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(ends_of, "conv_id long, convs long, ends binary")
    )
    # The smallest member stands for all that have its path.
    distinct, distinct_path = staged(
        members.join(whole, "conv_id").select(
            "path", "chars", "convs", F.col("conv_id").alias("least"), "ends"
        ),
        "distinct-paths",
    )
    turns = distinct.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    ranges = max(spark.sparkContext.defaultParallelism, math.ceil(turns / TREE_TURNS))
    built, built_path = staged(
        distinct.repartitionByRange(ranges, "path")
        .sortWithinPartitions("path")
        .mapInArrow(trees, TREE),
        "trees",
    )
    spines = (
        built.where("spine IS NOT NULL")
        .select("part", "side", "spine")
        .coalesce(1)
        .sortWithinPartitions("part", "side")
    )
    joined, joined_path = staged(spines.mapInArrow(join_spines, JOINED), "joined")
    inside = built.where("node IS NOT NULL").select("part", "side", "above", "parent", "node.*")
    places = joined.where("part IS NOT NULL").select(
        "part", "side", "above", F.col("parent").alias("found")
    )
    below = inside.where("above IS NOT NULL").join(
        broadcast_if_small(places), ["part", "side", "above"]
    )
    nodes = (
        inside.where("above IS NULL")
        .unionByName(below.withColumn("parent", F.col("found")).drop("found"))
        .unionByName(joined.where("part IS NULL"))
    )
    result, _ = staged(
        nodes.select(
            F.col("least").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            F.col("convs").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.lower(F.hex("ends")).alias("ends_sha256"),
        ),
        "trie",
    )
    for path in (whole_path, distinct_path, built_path, joined_path):
        discard(spark, path)
    return result
