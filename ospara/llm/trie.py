"""Prefix trie of conversations over range-partitioned shards.

A conversation is the path of its turns' digests. Conversations are sorted by
path and cut into shards at sampled splitters. A node whose members lie in more
than one shard has the splitter between them below it, so it is a prefix of
that splitter: the trie of the splitters' prefixes, the skeleton, is broadcast,
and a shard finishes every other node alone in one pass over its sorted rows.
For nodes of the skeleton each shard hands on partial counts, which are summed
per node; totals of subtrees are then rolled up over the skeleton alone.

The cut also looks at the id, so that conversations of one path, however many,
fall into several shards. Their ids reach the node in ordered blocks of text,
and the hash of a node runs over these as a stream.

Texts are read once, for their digests and lengths. A task holds the digests
of single conversations, open nodes, and finished nodes that wait for the id of
their parent; none of these outgrows a shard. The driver holds one splitter a
shard, within ``SPLITTER_BYTES``: beyond that every other splitter is dropped,
which makes shards larger and changes no result.

Defined results: a null role or text is empty; turns that tie follow their
digests, a null turn is first; repeated rows are turns of their own; rows
without a conversation id take no part; without any conversation there are no
rows; other columns are ignored. Digests are 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm.graph import discard, written

WIDTH = 16
SHARD_BYTES = 256 << 20
SAMPLES_PER_SHARD = 16
SPLITTER_BYTES = 4 << 20
#: Bytes of ids of one block, and finished nodes of one batch.
ID_BYTES, BATCH_ROWS = 1 << 16, 8192
BORROWED, FAMILY = 6, 100
NO_IDS = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) with the ordered (digest, chars) of each conversation's turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
            F.unhex(F.substring(F.sha2(name, 256), 1, 2 * WIDTH)).alias("digest"), F.length(text).alias("chars"),
        ).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"], t["chars"])).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Sequences whose first h turns come from the first conversation of their hundred; h is the id's CRC modulo 6."""
    own = sequences(turns)
    heads = sequences(turns.filter(F.col("conv_id") % FAMILY == 0)).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, BORROWED - 1).alias("head"))
    h = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")), F.lit(BORROWED)).cast("int")
    joined = own.join(heads, own["conv_id"] - own["conv_id"] % FAMILY == heads["base"], "left").withColumn("h", h)
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def paths(sequenced: DataFrame) -> DataFrame:
    """(conv_id, path, chars): digests in a row, and the length of each turn's text."""
    code = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    return sequenced.select("conv_id", F.unhex(code).alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"))


def splitters(conversations: DataFrame, shards: int, total: int) -> list[tuple[bytes, int]]:
    """About ``shards`` - 1 places (path, id) that cut the sorted conversations evenly."""
    if shards < 2:
        return []
    share = min(1.0, SAMPLES_PER_SHARD * shards / total)
    sample = conversations.filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    step = max(1, int(share * total) // shards)
    ranges = max(1, shards // 64)
    cuts = (
        sample.select("path", "conv_id").repartitionByRange(ranges, "path", "conv_id").sortWithinPartitions("path", "conv_id")
        .withColumn("i", F.monotonically_increasing_id()).filter(F.col("i") % step == step // 2).select("path", "conv_id")
    )
    found = sorted((bytes(r["path"]), r["conv_id"]) for r in cuts.collect())
    while sum(len(p) + 64 for p, _ in found) > SPLITTER_BYTES:
        found = found[1::2]
    return found


class Skeleton:
    """The trie of the splitters' prefixes; node 0 is the root, children follow their parents."""

    def __init__(self, cuts: list[tuple[bytes, int]]):
        self.cuts = cuts
        self.parents, self.depths = [-1], [0]
        self.steps: dict[tuple[int, bytes], int] = {}
        for path, _ in cuts:
            node = 0
            for i in range(0, len(path), WIDTH):
                step = (node, path[i : i + WIDTH])
                if step not in self.steps:
                    self.steps[step] = len(self.parents)
                    self.parents.append(node)
                    self.depths.append(self.depths[node] + 1)
                node = self.steps[step]


class _Node:
    """An open node of the pass over a shard."""

    __slots__ = ("depth", "chars", "place", "first", "members", "children", "leaves", "saved", "hash", "ids", "block", "waiting")

    def __init__(self, depth: int, chars: int, place: int):
        self.depth, self.chars, self.place = depth, chars, place
        self.first, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.hash, self.ids, self.block = None, [], 0
        self.waiting: list[tuple] = []


FIELDS = pa.schema([
    ("kind", pa.string()), ("node", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("shard", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()),
])
COLUMNS = ("kind string, node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
           "saved_tokens long, ends_sha256 string, shard int, block long, ids binary")


class _Shard:
    """One pass over the sorted conversations of a shard; rows of ``FIELDS`` gather in ``out``.

    Kinds of rows: "done", complete; "child", complete but for the id of its
    parent, a skeleton node; "part", a skeleton node's counts (``saved_tokens``
    of the local nodes below, ``block`` the length of its own text); "ids", a
    block of a skeleton node's ids.
    """

    def __init__(self, skeleton: Skeleton, shard: int, out: list[tuple]):
        self.skeleton, self.shard, self.out = skeleton, shard, out
        self.open = [_Node(0, 0, 0)]
        self.path = b""

    def add(self, conv_id: int, path: bytes, chars: list[int]) -> None:
        before, at = self.path, 0
        if path != before:
            most = min(len(path), len(before))
            while at < most and path[at : at + WIDTH] == before[at : at + WIDTH]:
                at += WIDTH
            while len(self.open) > at // WIDTH + 1:
                self.close()
            for i in range(at, len(path), WIDTH):
                above = self.open[-1]
                place = self.skeleton.steps.get((above.place, path[i : i + WIDTH]), -1) if above.place >= 0 else -1
                self.open.append(_Node(above.depth + 1, chars[i // WIDTH], place))
            self.path = path
        node = self.open[-1]
        node.members += 1
        node.first = conv_id if node.first is None else min(node.first, conv_id)
        if node.place < 0:
            text = b"%d" % conv_id if node.hash is None else b",%d" % conv_id
            node.hash = node.hash or hashlib.sha256()
            node.hash.update(text)
        else:
            node.ids.append(b"%d" % conv_id)
            if len(node.ids) * 20 > ID_BYTES:
                self.hand_on(node)

    def hand_on(self, node: _Node) -> None:
        if node.ids:
            self.out.append(("ids", node.place, *[None] * 8, self.shard, node.block, b",".join(node.ids)))
            node.ids, node.block = [], node.block + 1

    def close(self) -> None:
        node = self.open.pop()
        above = self.open[-1] if self.open else None
        if above:
            above.members += node.members
            above.first = node.first if above.first is None else min(above.first, node.first)
        if node.place >= 0:
            self.hand_on(node)
            self.out.append(("part", node.place, node.first, node.depth, None, node.members, node.children, node.leaves,
                             node.saved, None, self.shard, node.chars, None))
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.members - 1) * node.chars
        ends = node.hash.hexdigest() if node.hash else NO_IDS
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        for depth, *rest in node.waiting:
            self.out.append(("done", None, rest[0], depth, node.first, *rest[1:], None, None, None))
        own = (node.depth, node.first, node.members, node.children, leaves, saved, ends)
        if above.place >= 0:
            self.out.append(("child", above.place, own[1], own[0], None, *own[2:], None, None, None))
        else:
            above.waiting.append(own)

    def end(self) -> None:
        while self.open:
            self.close()


def finished(conversations: DataFrame, skeleton: Skeleton, shards: int) -> DataFrame:
    """The rows of all shards."""
    spark = conversations.sparkSession
    sent = spark.sparkContext.broadcast(skeleton)

    @F.arrow_udf("int")
    def shard_of(path: pa.Array, conv_id: pa.Array) -> pa.Array:
        cuts = sent.value.cuts
        return pa.array([bisect_right(cuts, x) for x in zip(path.to_pylist(), conv_id.to_pylist())], pa.int32())

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        shard = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), FIELDS)], schema=FIELDS)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "path", "conv_id", "chars"))
            for number, path, conv_id, chars in zip(*columns):
                if shard is None or number != shard.shard:
                    if shard:
                        shard.end()
                    shard = _Shard(sent.value, number, out)
                shard.add(conv_id, path, chars)
                if len(out) >= BATCH_ROWS:
                    yield batch_of(out)
                    out.clear()
        if shard:
            shard.end()
        for start in range(0, len(out), BATCH_ROWS):
            yield batch_of(out[start : start + BATCH_ROWS])

    placed = conversations.select(shard_of("path", "conv_id").alias("shard"), "path", "conv_id", "chars")
    return (
        placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id").mapInArrow(grow, COLUMNS)
    )


def ends_of(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256): the hash of each skeleton node's ids, as a stream over its ordered blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, str]] = []
        node, state = None, None
        for batch in batches:
            for number, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if number != node:
                    if state:
                        found.append((node, state.hexdigest()))
                    node, state = number, hashlib.sha256(ids)
                else:
                    state.update(b",")
                    state.update(ids)
        if state:
            found.append((node, state.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in found], pa.int64()), pa.array([h for _, h in found], pa.string())], names=["node", "ends_sha256"])

    blocks = rows.filter("kind = 'ids'").select("node", "shard", "block", "ids")
    return blocks.repartition("node").sortWithinPartitions("node", "shard", "block").mapInArrow(run, "node long, ends_sha256 string")


def rolled_up(rows: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """(node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens) of the skeleton's nodes.

    The sums of the shards are as many as the skeleton has nodes, which
    ``SPLITTER_BYTES`` bounds; only they reach the driver.
    """
    sums = rows.filter("kind = 'part'").groupBy("node").agg(
        F.min("conv_id").alias("first"), F.sum("n_convs").alias("members"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("block").alias("chars"),
    )
    found = {r["node"]: r.asDict() for r in sums.collect()}
    for node in sorted(found, reverse=True):
        own = found[node]
        own["saved"] += (own["members"] - 1) * own["chars"]
        if not own["children"]:
            own["leaves"] = 1
        above = found.get(skeleton.parents[node])
        if above:
            above["children"] += 1
            above["leaves"] += own["leaves"]
            above["saved"] += own["saved"]
    return [
        (node, own["first"], skeleton.depths[node], found[skeleton.parents[node]]["first"] if node else None,
         own["members"], own["children"], own["leaves"], own["saved"])
        for node, own in sorted(found.items())
    ]


def prefix_trie(sequenced: DataFrame, shards: int | None = None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``sequenced`` has (conv_id, turns), as ``sequences`` or ``rebuilt`` give it;
    without ``shards``, their number follows the size of the paths.
    """
    spark = sequenced.sparkSession
    conversations, path = written(paths(sequenced), "paths")
    total, size = conversations.agg(F.count(F.lit(1)), F.sum(F.length("path") + 40)).first()
    columns = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    if not total:
        return spark.createDataFrame([], f"{columns}, ends_sha256 string")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    skeleton = Skeleton(splitters(conversations, shards or max(least, -(-size // SHARD_BYTES)), total))
    rows, _ = written(finished(conversations, skeleton, len(skeleton.cuts) + 1), "trie")
    discard(spark, path)
    names = [c.split()[0] for c in columns.split(", ")]
    whole = spark.createDataFrame(rolled_up(rows, skeleton), f"node long, {columns}")
    top = whole.join(ends_of(rows), "node", "left").select(*names, F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))
    above = F.broadcast(whole.select("node", F.col("conv_id").alias("above")))
    children = rows.filter("kind = 'child'").drop("parent_conv_id").join(above, "node").withColumnRenamed("above", "parent_conv_id")
    done = rows.filter("kind = 'done'").select(*names, "ends_sha256")
    return done.unionByName(children.select(*names, "ends_sha256")).unionByName(top)
