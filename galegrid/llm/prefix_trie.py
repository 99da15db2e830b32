"""The prefix trie of conversations: which beginnings they share.

A turn becomes an id of 16 bytes: 96 bits of a SHA-256 over role and text, then the number of the
text's code points, big-endian. (Two of 10^10 different turns are alike with a probability below
10^-8.) A conversation is the sequence of its ids, so equal beginnings are equal leading bytes.

Conversations are dealt into key ranges. Every task puts its range into an adaptive radix tree
(`radix_tree`) and walks it: byte depths that end a turn are nodes of the trie, also those inside a
compressed path; branches inside an id are not. Nodes that only one range holds are final there. The
beginnings of a range's first and last key may belong to other ranges as well; their counts are
sums over the conversations and over the nodes that a range is the first to hold, so the ranges'
parts add up, corrected by how far each first key agrees with the last key of the range before.

No range depends on how many conversations begin alike: equal keys of nearby conv_ids are one row
before the ranges are dealt, and different keys fall into different ranges however much they share.
What stays together is one conversation (a row of 16 bytes a turn) and, as their ids are hashed in
one sequence, the conversations with equal turns: a stream with a row for each span of `SPAN` ids,
never held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import checked_join
from ..session import cut_lineage
from .common import with_arrow_columns
from .radix_tree import Node, RadixTree

WIDTH, HASHED = 16, 12
#: A rebuilt conversation takes fewer than so many turns of its group's first one.
HEADS = 6
#: Conversations with equal turns whose ids lie in one span are one row.
SPAN = 4096
#: Rows of a task: at least the first unless there would be more than MOST_TASKS, at most the second.
TASK_ROWS, MOST_ROWS, MOST_TASKS, TASK_BYTES = 2_000, 100_000, 10_000, 16 << 20

NO_ENDS = hashlib.sha256(b"").hexdigest()
_COLUMNS = (
    "kind int, part int, on_first boolean, on_last boolean, node binary, parent binary, depth bigint, conv_id bigint, "
    "parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, total bigint, fresh bigint, "
    "before bigint, ends_sha256 string, first binary, last binary"
)
CLOSED, OPEN, EDGE = range(3)


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn as hexadecimal digits."""
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(named, 256), 1, 2 * HASHED), F.lower(F.lpad(F.hex(F.char_length(text)), 8, "0")))


def rebuilt(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, key): each conversation's turn ids, one after the other.

    The first h turns come from conversation c - c % 100, where h is crc32(c) % 6, if it exists;
    the rest are c's own behind its first h. Turns go by `turn`, null first, equal ones by their id.
    Null roles and texts are empty. Rows with a null key belong to no conversation and take no part.
    """
    c = F.col(f"`{key}`").cast("bigint")
    read = [F.coalesce(F.col(f"`{x}`"), F.lit("")) for x in (role, text)]
    turns = conversations.select(c.alias("c"), F.struct(F.col(f"`{turn}`").alias("turn"), turn_id(*read).alias("id")).alias("t"))
    # rows of a group are dealt together, so neither counting turns nor the join deals them again
    dealt = turns.where("c IS NOT NULL").withColumn("base", F.col("c") - F.col("c") % 100).repartition("base")
    own = dealt.groupBy("base", "c").agg(F.array_sort(F.collect_list("t")).alias("t")).select("base", "c", F.col("t.id").alias("ids"))
    heads = own.where("c = base").select("base", F.slice("ids", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("c").cast("string")) % HEADS).cast("int")
    whole = F.concat(
        F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h),
        F.slice("ids", h + 1, F.greatest(F.size("ids") - h, F.lit(0))),
    )
    return own.join(heads, "base", "left").select(F.col("c").alias("conv_id"), F.unhex(F.array_join(whole, "")).alias("key"))


def _points(turns: bytes, depth: int) -> int:
    """The code points of the first `depth` turns."""
    return sum(int.from_bytes(turns[k + HASHED : k + WIDTH], "big") for k in range(0, depth * WIDTH, WIDTH))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, tuple[int, int, str]]]:
    """Each key of a sorted range once, with its conversations' number, least id and digest."""
    key = digest = None
    n = least = 0
    for batch in batches:
        for k, count, low, ids in zip(*(batch.column(c) for c in ("key", "n", "least", "ids"))):
            k = k.as_py()
            if key != k or key is None:
                if key is not None:
                    yield key, (n, least, digest.hexdigest())
                key, n, least, digest = k, 0, low.as_py(), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_py().encode())
            n, least = n + count.as_py(), min(least, low.as_py())
    if key is not None:
        yield key, (n, least, digest.hexdigest())


class Sums:
    """What a radix node adds up to.

    `points` are those of the turns that end on its path, `above` all those before. n, least, leaves
    and total (code points of all conversations' turns) count what is at the node and below; fresh
    counts the points of distinct turns from the node's path on, children the nodes next below.
    """

    __slots__ = ("depth", "above", "points", "n", "least", "leaves", "total", "fresh", "children")


def add_up(root: Node) -> None:
    """Set `sums` of all nodes, children before parents, without recursion."""
    stack, prefix = [(root, 0, 0, False)], bytearray()
    while stack:
        node, start, above, left = stack.pop()
        if not left:
            del prefix[start:]
            prefix += node.path
            node.sums = s = Sums()
            s.depth, s.above = start // WIDTH, above
            s.points = [
                int.from_bytes(prefix[d * WIDTH - 4 : d * WIDTH], "big")
                for d in range(start // WIDTH + 1, len(prefix) // WIDTH + 1)
            ]
            stack.append((node, start, above, True))
            end, deeper = len(prefix), above + sum(s.points)
            stack.extend((child, end, deeper, False) for child in node.below())
            continue
        s, below = node.sums, [child.sums for child in node.below()]
        n, least, _ = node.value or (0, None, None)
        own = sum(s.points)
        s.n = n + sum(b.n for b in below)
        s.least = min(x for x in (least, *(b.least for b in below)) if x is not None)
        s.leaves = sum(b.leaves for b in below) or 1
        s.total = n * (above + own) + sum(b.total for b in below)
        s.fresh = own + sum(b.fresh for b in below)
        s.children = sum(1 if b.points else b.children for b in below)


def beginnings(key: bytes) -> list[bytes]:
    """Digests of the beginnings of a key by their turns, from none on."""
    digest, found = hashlib.sha256(), []
    for start in range(0, len(key) + 1, WIDTH):
        found.append(digest.digest()[:WIDTH])
        digest.update(key[start : start + WIDTH])
    return found


def walk(tree: RadixTree, first: bytes, last: bytes) -> Iterator[dict]:
    """The nodes of the trie; those on the way to the first or last key are open."""
    add_up(tree.root)
    to_first, to_last = beginnings(first), beginnings(last)
    stack: list[tuple] = [(tree.root, None, None, True, True)]
    while stack:
        node, parent, parent_conv, on_first, on_last = stack.pop()
        s = node.sums
        way = to_first if on_first else to_last if on_last else None
        fresh, before = s.fresh, s.above
        depths = [(s.depth + k, p) for k, p in enumerate(s.points, 1)] if node is not tree.root else [(0, 0)]
        for depth, points in depths:
            at_end = depth == depths[-1][0]
            name = way[depth] if way else None
            yield {
                "kind": OPEN if way else CLOSED, "on_first": on_first, "on_last": on_last, "node": name, "parent": parent,
                "depth": depth, "conv_id": s.least, "parent_conv_id": parent_conv, "n_convs": s.n,
                "n_children": s.children if at_end else 1, "n_leaves": s.leaves, "total": s.total, "fresh": fresh,
                "before": before, "ends_sha256": node.value[2] if node.value and at_end else None,
            }
            fresh, before = fresh - points, before + points
            parent, parent_conv = name, None if way else s.least
        below = node.below()
        for k, child in enumerate(below):
            first_too = on_first and node.value is None and k == 0
            stack.append((child, parent, parent_conv, first_too, on_last and k == len(below) - 1))


def _range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One key range, in order: its trie nodes, and a row with its first and last key."""
    tree, first, last = RadixTree(), None, None
    for key, value in _read(batches):
        tree.insert(key, value)
        first, last = key if first is None else first, key
    if first is None:
        return
    part = TaskContext.get().partitionId()
    held = [{"kind": EDGE, "first": first, "last": last, "part": part}]
    for row in walk(tree, first, last):
        row["part"] = part
        held.append(row)
        if len(held) == 1000:
            yield pa.RecordBatch.from_pylist(held, _SCHEMA)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, _SCHEMA)


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
_SCHEMA = pa.schema([(n, _ARROW[k]) for n, k in (c.split() for c in _COLUMNS.split(", "))])


def _agreement(edges: DataFrame) -> DataFrame:
    """Rows (part, shared, shared_points, goes_on), one for each range that holds keys.

    How many turns of its first key the range before holds as well, their code points, and whether
    the next range goes on from its last key.
    """
    parts = sorted(r["part"] for r in edges.select("part").collect())
    spark = edges.sparkSession
    pairs = spark.createDataFrame(list(zip(parts, parts[1:])), "before int, part int")
    met = (
        edges.select("part", "first")
        .join(F.broadcast(pairs), "part")
        .join(edges.select(F.col("part").alias("before"), "last"), "before")
        .select("part", "before", "first", "last")
    )

    def make() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            found = []
            for first, last in zip(batch.column("first").to_pylist(), batch.column("last").to_pylist()):
                low, high = 0, min(len(first), len(last)) // WIDTH
                while low < high:
                    middle = (low + high + 1) // 2
                    same = first[: middle * WIDTH] == last[: middle * WIDTH]
                    low, high = (middle, high) if same else (low, middle - 1)
                found.append((low, _points(first, low), low * WIDTH == len(last)))
            return [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.bool_()))]

        return run

    fields = [T.StructField("shared", T.LongType()), T.StructField("shared_points", T.LongType()), T.StructField("goes_on", T.BooleanType())]
    found = cut_lineage(with_arrow_columns(met, fields, make, reads=["first", "last"], keep=["part", "before"]))
    return (
        edges.select("part")
        .join(F.broadcast(found.select("part", "shared", "shared_points")), "part", "left")
        .join(F.broadcast(found.select(F.col("before").alias("part"), "goes_on")), "part", "left")
        .na.fill({"shared": 0, "shared_points": 0, "goes_on": False})
    )


def _together(opened: DataFrame, agreement: DataFrame) -> DataFrame:
    """The ranges' parts of their open nodes added up, one row for each node."""
    known = opened.join(F.broadcast(agreement), "part")
    held_before = F.col("on_first") & (F.col("depth") <= F.col("shared"))
    child_before = (F.col("on_first") & (F.col("depth") < F.col("shared"))).cast("bigint")
    not_leaf = (F.col("on_last") & F.col("goes_on")).cast("bigint")
    fresh = F.col("fresh") - F.when(held_before, F.col("shared_points") - F.col("before")).otherwise(0)
    return known.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum(F.col("n_children") - child_before).alias("n_children"),
        F.sum(F.col("n_leaves") - not_leaf).alias("n_leaves"),
        (F.sum("total") - F.sum("n_convs") * F.min("before") - F.sum(fresh)).alias("saved_tokens"),
        F.max("ends_sha256").alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations (see `rebuilt`).

    conv_id is the node's least conversation, parent_conv_id that of its parent (null for the root);
    n_convs counts the conversations that begin so, n_children and n_leaves nodes, saved_tokens the
    code points that need not be kept twice in the node's subtree, and ends_sha256 is over the ids of
    the conversations that end there. Without conversations there are no rows, not even the root.
    Rows that repeat are turns of their own. Other columns are not read.
    """
    spans = (
        rebuilt(conversations, key, turn, role, text)
        .groupBy("key", F.floor(F.col("conv_id") / SPAN).alias("span"))
        .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
        .select("key", "span", F.size("ids").cast("bigint").alias("n"), F.col("ids")[0].alias("least"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )
    spans = cut_lineage(spans)
    size = spans.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("key")), F.lit(0)).alias("bytes")).first()
    tasks = max(min(MOST_TASKS, -(-size["n"] // TASK_ROWS)), -(-size["n"] // MOST_ROWS), -(-size["bytes"] // TASK_BYTES), 1)
    ranges = spans.repartitionByRange(tasks, "key").sortWithinPartitions("key", "span")
    found = cut_lineage(ranges.select("key", "n", "least", "ids").mapInArrow(_range, _COLUMNS))

    edges = found.where(F.col("kind") == EDGE)
    opened = cut_lineage(_together(found.where(F.col("kind") == OPEN), _agreement(edges)))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")]
    closed = found.where(F.col("kind") == CLOSED).withColumn("saved_tokens", F.expr("total - n_convs * before - fresh"))
    of_open = ["parent", *names[:2], *names[3:]]
    outer = closed.where("parent IS NOT NULL").select(*of_open).unionByName(opened.where("parent IS NOT NULL").select(*of_open))
    parents = opened.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    root = opened.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    return (
        closed.where("parent IS NULL").select(*names)
        .unionByName(checked_join(outer, parents, ["parent"], ["conv_id", "depth"]).select(*names))
        .unionByName(root.select(*names))
    )
