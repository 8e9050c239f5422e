"""Near-duplicate documents by a MinHash LSH forest.

Each document's set of word shingles has a signature of ``trees * depth``
minima. Tree ``t`` sorts all sets by the signature rotated to its own minima,
so that sets with a long common prefix stand next to each other. Candidates
are neighbours in a sorted order that share ``depth`` minima or more. Where a
region of such sets is longer than the neighbourhood, the order decides by its
depth: a set is compared with those of the longest common prefix next to it,
and with the region's centres, the sets whose prefixes are longest over all
trees. Every candidate link is confirmed on full sets of 64-bit shingle hashes.
What these links connect need not be compared again; all other pairs of each
long region are, block by block, so all pairs that share ``depth`` minima in a
tree are connected or compared.

Equal sets are folded into one node first, so copies make no pairs. The
orders are cut by range, never by prefix, so a region that holds a third of all
sets is spread over tasks; the ends of the ranges are compared with those of the
next ranges in a second, small pass. Pairs are confirmed in bins that get each set once,
and a bin skips pairs that it has connected already.

A link of similarity ``s`` is missed by one tree with probability
``1 - s ** depth``: at 0.85 by all 20 trees with 4e-7, at 0.8 with 3e-5.

Defined results: a null or empty text, or one without words, has no shingles,
links with nothing and is kept; fewer words than a shingle are one shingle
together; rows with equal ids keep one component id each; a null doc_id links
as others do, but no component is named by it and it is not kept where the
component has another name; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm.graph import components, written
from ospara.llm.texts import LOWER, raw, slices, task_number
from ospara.scale import top_k

WIDTH = 5
PERCENT = 80
TREES = 20
DEPTH = 4
#: Minima of an order's key; deeper than this, order is by node.
KEY = 12
#: Neighbours on each side in an order, and in a region that is longer.
NEIGHBOURS = 6
CROWDED_NEIGHBOURS = 2
#: Keys at each end of a range that are compared with those of the next ranges; enough to see a long region.
EDGE = NEIGHBOURS + 2
#: Centres of a long region, which connect most of it. Members of a region per bin.
CENTRES = 512
CROWD_BLOCK = 1024
#: Strays, and sets that they are compared with, of a bin.
STRAY_BLOCK = 512
#: Pairs that a bin confirms, about.
BIN_PAIRS = 4000

_CHUNK = 1 << 15
_MIX = np.random.default_rng(20).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles, A-Z in lower case."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashes[k : k + n]) * _MIX[k]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signatures(sets: list[np.ndarray], functions: int) -> np.ndarray:
    """Minima of each set, none of them empty, under ``functions`` hash functions."""
    keys = np.random.default_rng(7).integers(1, 2**63, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(sets), functions), ">u4")
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= _CHUNK):
            size += len(sets[last])
            last += 1
        values = np.concatenate(sets[first:last])
        starts = np.cumsum([0, *map(len, sets[first : last - 1])])
        for k, key in enumerate(keys):
            out[first:last, k] = np.minimum.reduceat(values * key, starts) >> np.uint64(32)
        first = last
    return out


def row_key() -> F.Column:
    return F.xxhash64("doc_id", "text")


def sketches(docs: DataFrame, width: int, functions: int) -> DataFrame:
    """(doc_id, row_key, n_shingles, node, signature); the node names the set, null if empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_shingles", pa.int64()),
                        ("node", pa.binary()), ("signature", pa.binary())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, width) for t in raw(batch.column("text"))]
            rows = iter(signatures([s for s in sets if len(s)], functions))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("row_key"), pa.array(map(len, sets), pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], schema=schema)

    return docs.select("doc_id", "text", row_key().alias("row_key")).mapInArrow(
        sketch, "doc_id long, row_key long, n_shingles long, node binary, signature binary"
    )


def candidates(classes: DataFrame, trees: int, depth: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct pairs (a, b) of nodes, a < b, that stand close in some order; the crowds' rows and members (see ``crowds``)."""
    key = max(KEY, depth)
    columns = key + 1
    rotated = F.concat("signature", F.substring("signature", 1, 4 * key))
    orders = classes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.concat(
        F.unhex(F.lpad(F.hex(t), 8, "0")), F.substring(rotated, t * (4 * depth) + 1, F.lit(4 * key))))).alias("key"))
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("region", pa.int64()), ("shared", pa.int64()),
                        ("part", pa.int32()), ("place", pa.int64()), ("key", pa.binary())])

    def close(nodes: pa.Array, keys: np.ndarray, old: int = 0, gaps: np.ndarray | None = None) -> pa.Table:
        left, right, crowded, shared = close_pairs(keys, depth + 1, old, gaps)
        names = [xxhash.xxh3_64_intdigest(k.tobytes()) >> 1 for k in keys[crowded, : depth + 1]]
        none, blank = pa.nulls(len(left), pa.int64()), pa.nulls(len(crowded), pa.binary())
        return pa.concat_tables([
            pa.Table.from_arrays([nodes.take(pa.array(left)), nodes.take(pa.array(right)), none, none], schema=close_schema),
            pa.Table.from_arrays([nodes.take(pa.array(crowded)), blank, pa.array(names, pa.int64()), pa.array(shared, pa.int64())],
                                 schema=close_schema)]).combine_chunks()

    close_schema = pa.schema(list(schema)[:4])

    def unpacked(column) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, columns)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, keys = pa.array([], pa.binary()), np.zeros((0, columns), ">u4")
        head, tail, total = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            old = len(keys)
            nodes = pa.concat_arrays([nodes, batch.column("node").cast(pa.binary())])
            keys = np.concatenate([keys, unpacked(batch.column("key"))])
            table = close(nodes, keys, old)
            for part in table.to_batches():
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.nulls(part.num_rows, f.type) for f in list(schema)[4:]]], schema=schema)
            edge = [(node, key, total + i) for rows in (range(min(EDGE, batch.num_rows)), range(max(EDGE, batch.num_rows - EDGE), batch.num_rows))
                    for i in rows for node, key in [(batch.column("node")[i].as_py(), batch.column("key")[i].as_py())]]
            head = (head + edge)[:EDGE]
            tail = (tail + edge)[-EDGE:]
            total += batch.num_rows
            kept = max(0, len(keys) - NEIGHBOURS - 1)
            nodes, keys = nodes.slice(kept), keys[kept:]
        edge = head + [row for row in tail if row[2] > head[-1][2]]
        yield pa.RecordBatch.from_arrays([
            pa.array([n for n, _, _ in edge], pa.binary()), *[pa.nulls(len(edge), f.type) for f in list(schema)[1:4]],
            pa.array([task_number()] * len(edge), pa.int32()), pa.array([i for _, _, i in edge], pa.int64()),
            pa.array([k for _, k, _ in edge], pa.binary())], schema=schema)

    def across(edges: pa.Table) -> pa.Table:
        edges = edges.sort_by([("part", "ascending"), ("place", "ascending")]).combine_chunks()
        part, place = (edges.column(c).to_numpy() for c in ("part", "place"))
        gaps = (part[1:] == part[:-1]) & (place[1:] > place[:-1] + 1)
        return close(pa.array(edges.column("a").to_pylist(), pa.binary()), unpacked(edges.column("key")), 0, gaps)

    found, _ = written(orders.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node").mapInArrow(
        neighbours, "a binary, b binary, region long, shared long, part int, place long, key binary"), "close")
    joined, _ = written(found.filter("key is not null").select("a", "part", "place", "key", F.substring("key", 1, 4).alias("tree")).groupBy(
        "tree").applyInArrow(across, "a binary, b binary, region long, shared long"), "joined")
    found = found.filter("key is null").select("a", "b", "region", "shared").unionByName(joined)
    pairs = found.filter("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return written(pairs, "pairs")[0], *crowds(found.filter("b is null"))


def crowds(crowd: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(root, block, node, centre): members of long regions in blocks, and the region's centres in every block.

    Also (node, region, shared) of every long region that a set is in.
    A set belongs to the block of its longest region, whatever the tree; the
    centres are chosen from all sets of the region.
    """
    members = crowd.groupBy(F.col("a").alias("node"), "region").agg(F.max("shared").alias("shared"))
    members, _ = written(members, "members")
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("size"))
    central = members.groupBy("node").agg(F.sum("shared").alias("central"))
    placed, _ = written(members.join(sizes, "region").join(central, "node"), "crowd")
    homes, _ = written(placed.groupBy("node").agg(F.max(F.struct("size", "region"))["region"].alias("root")), "homes")
    blocks, _ = written(homes.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / CROWD_BLOCK).alias("blocks")), "crowd-sizes")
    dealt = homes.join(blocks, "root").select(
        "root", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), "node", F.lit(False).alias("centre"))
    chosen = placed.join(blocks.withColumnRenamed("root", "region"), "region")
    everywhere = top_k(chosen, ["region"], [F.desc("central"), F.asc("node")], CENTRES).select(
        F.col("region").alias("root"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "node", F.lit(True).alias("centre"))
    return written(dealt.unionByName(everywhere), "crowd-blocks")[0], members


def close_pairs(
    keys: np.ndarray, depth: int, old: int = 0, gaps: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of sorted keys that share ``depth`` columns and stand close.

    Also the rows of regions longer than the neighbourhood, and how many columns
    each of these shares with a neighbour. The first ``old`` rows come from
    the stretch before and were compared with each other there. ``gaps`` marks
    rows after which others are left out.
    """
    n = len(keys)
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none, none, none
    common = np.cumprod(keys[1:] == keys[:-1], axis=1).sum(axis=1)
    if gaps is not None:
        common[gaps] = 0
    region = np.concatenate([[0], np.cumsum(common < depth)])
    long = np.bincount(region)[region] > NEIGHBOURS + 1
    lefts, rights = [], []
    reach = common.copy()
    for step in range(1, NEIGHBOURS + 1):
        if step > 1:
            reach = np.minimum(reach[:-1], common[step - 1 :])
        at = np.flatnonzero(reach >= depth)
        at = at[at + step >= old]
        if step > CROWDED_NEIGHBOURS:
            at = at[~long[at]]
        lefts.append(at)
        rights.append(at + step)
    crowded = np.flatnonzero(long)
    shared = np.maximum(np.concatenate([[0], common]), np.concatenate([common, [0]]))[crowded]
    return np.concatenate(lefts), np.concatenate(rights), crowded, shared


def links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, crowd: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) with ``100 * intersection >= percent * union`` that connect what the candidates connect.

    A pair goes to the bin of its smaller ends' smallest partner, so that a
    group of copies meets in one bin; a crowd is spread by its members. Sides
    that both grow with the documents are merge joined at every size.
    """
    spark = docs.sparkSession
    total = pairs.count()
    bins = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // BIN_PAIRS)
    both = pairs.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("n"), F.col("a").alias("m")))
    labels, _ = written(both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("label")), "labels")
    dealt = pairs.join(labels.withColumnsRenamed({"n": "a", "label": "la"}).hint("merge"), "a").join(
        labels.withColumnsRenamed({"n": "b", "label": "lb"}).hint("merge"), "b").select("a", "b", F.least("la", "lb").alias("label"))
    large, _ = written(dealt.groupBy("label").count().filter(F.col("count") > BIN_PAIRS), "large")
    salt = F.pmod(F.xxhash64("a"), F.ceil(F.col("count") / BIN_PAIRS))
    place = F.pmod(F.xxhash64("label", F.coalesce(salt, F.lit(0))), F.lit(bins)).alias("bin")
    paired = dealt.join(large, "label", "left").select(place, "a", "b", F.lit(None).cast("boolean").alias("centre"))
    gathered = crowd.select(F.pmod(F.xxhash64("root", "block"), F.lit(bins)).alias("bin"), F.col("node").alias("a"),
                            F.col("root").cast("string").cast("binary").alias("b"), "centre")
    binned, _ = written(paired.unionByName(gathered), "binned")
    needed = binned.select("bin", F.explode(F.when(F.col("centre").isNull(), F.array("a", "b")).otherwise(F.array("a"))).alias("node"))
    needed = needed.distinct()
    keyed, _ = written(needed.join(classes.select("node", "row_key").hint("merge"), "node"), "needed")
    texts = docs.select("doc_id", "text", row_key().alias("row_key")).join(keyed.hint("merge"), "row_key").select("bin", "node", "text")
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def confirm(wanted: pa.Table, found: pa.Table) -> pa.Table:
        sets = {}
        for node, text in zip(found.column("node").to_pylist(), raw(found.column("text").combine_chunks())):
            shingles = shingle_set(text, width)
            if xxhash.xxh3_128_digest(shingles.tobytes()) == node:
                sets[node] = shingles
        parent = {node: node for node in sets}

        def root(node):
            while parent[node] != node:
                parent[node] = node = parent[parent[node]]
            return node

        us, vs = [], []

        def link(a, b):
            ra, rb = root(a), root(b)
            if ra != rb and similar(sets[a], sets[b], percent):
                parent[ra] = rb
                us.append(a)
                vs.append(b)

        members, centres = {}, {}
        for a, b, centre in zip(*(wanted.column(c).to_pylist() for c in ("a", "b", "centre"))):
            if centre is None:
                link(a, b)
            else:
                (centres if centre else members).setdefault(b, []).append(a)
        for name, held in members.items():
            for centre in centres.get(name, ()):
                for member in held:
                    link(member, centre)
        return pa.Table.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], schema=schema)

    return binned.groupBy("bin").cogroup(texts.groupBy("bin")).applyInArrow(confirm, "u binary, v binary")


def late_links(
    docs: DataFrame, classes: DataFrame, members: DataFrame, roots: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links (u, v) between sets of one long region that are not connected by ``roots``.

    In each region the sets outside of its largest component, the strays, are
    compared with all others that they are not connected with. Regions of the
    same largest component share their bins, a block of strays and one of all
    sets each, so that a bin gets each set once or twice, whatever the trees.
    """
    spark = docs.sparkSession
    held, _ = written(members.select("node", "region").join(roots, "node", "left").select(
        "node", "region", F.coalesce("root", "node").alias("component")), "held")
    counted = held.groupBy("region", "component").agg(F.count(F.lit(1)).alias("size"))
    mixed = counted.groupBy("region").agg(
        F.max(F.struct("size", "component"))["component"].alias("label"), F.count(F.lit(1)).alias("components")).filter("components > 1")
    placed, _ = written(held.join(mixed.drop("components"), "region").groupBy("label", "node", "component").agg(
        F.collect_set("region").alias("regions")).withColumn("stray", F.col("component") != F.col("label")), "strays")
    blocks = placed.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / STRAY_BLOCK).alias("all_blocks"),
                                         F.ceil(F.count_if("stray") / STRAY_BLOCK).alias("stray_blocks"))
    dealt = placed.join(blocks, "label")
    mine = F.xxhash64("node")
    others = dealt.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("stray_blocks") - 1))).withColumn(
        "j", F.pmod(mine, F.col("all_blocks"))).withColumn("stray", F.lit(False))
    strays = dealt.filter("stray").withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1))).withColumn(
        "i", F.pmod(mine, F.col("stray_blocks")))
    columns = ["label", "i", "j", "node", "component", "regions", "stray"]
    rows, _ = written(others.select(columns).unionByName(strays.select(columns)), "stray-blocks")
    bins = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // STRAY_BLOCK)
    keyed = rows.select(F.pmod(F.xxhash64("label", "i", "j"), F.lit(bins)).alias("bin"), "node", "component", "regions", "stray").join(
        classes.select("node", "row_key").hint("merge"), "node")
    texts = docs.select("text", row_key().alias("row_key")).join(keyed.hint("merge"), "row_key").drop("row_key")
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def confirm(found: pa.Table) -> pa.Table:
        sets, component = {}, {}
        first, second = {}, {}
        names = found.column("node").to_pylist()
        for node, text, root_, regions, stray in zip(
            names, raw(found.column("text").combine_chunks()), *(found.column(c).to_pylist() for c in ("component", "regions", "stray"))
        ):
            if node not in sets:
                shingles = shingle_set(text, width)
                if xxhash.xxh3_128_digest(shingles.tobytes()) != node:
                    continue
                sets[node], component[node] = shingles, root_
            for region in regions:
                (first if stray else second).setdefault(region, set()).add(node)
        parent = {c: c for c in component.values()}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        us, vs, apart = [], [], set()
        for region, some in first.items():
            for a in some:
                for b in second.get(region, ()):
                    ra, rb = root(component[a]), root(component[b])
                    pair = (a, b) if a < b else (b, a)
                    if ra == rb or pair in apart:
                        continue
                    if similar(sets[a], sets[b], percent):
                        parent[ra] = rb
                        us.append(a)
                        vs.append(b)
                    else:
                        apart.add(pair)
        return pa.Table.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], schema=schema)

    return texts.groupBy("bin").applyInArrow(confirm, "u binary, v binary")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH
) -> DataFrame:
    """(doc_id, row_key, n_shingles, root, component_id, kept) of every document.

    ``root`` names the component, whose documents are connected by links; it is
    null for a document without shingles. ``component_id`` is the component's
    smallest doc_id, and that document is kept.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketched, _ = written(sketches(docs, width, trees * depth), "sketches")
    classes = sketched.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min("row_key").alias("row_key"), F.first("signature").alias("signature"))
    classes, _ = written(classes, "classes")
    pairs, crowd, members = candidates(classes, trees, depth)
    roots, _ = written(components(links(docs, classes, pairs, crowd, width, percent)), "roots")
    late, _ = written(late_links(docs, classes, members, roots, width, percent), "late")
    if not late.isEmpty():
        stars = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
        roots, _ = written(components(stars.unionByName(late)), "roots")
    ids = classes.select("node", "first_id")
    named = roots.join(ids, "node").groupBy("root").agg(F.min("first_id").alias("id"))
    component, _ = written(
        ids.join(roots.join(named, "root").select("node", "root", "id"), "node", "left").select(
            "node", F.coalesce("root", "node").alias("root"), F.coalesce("id", "first_id").alias("component")),
        "components",
    )
    return sketched.drop("signature").join(component.hint("merge"), "node", "left").select(
        "doc_id", "row_key", "n_shingles", "root",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one of the smallest doc_id; all columns stay.

    Rows that repeat in id and text count as one; of several rows with the
    component's id, or without any id, one stays.
    """
    parts = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    keys = {"_k1": F.xxhash64(*parts), "_k2": F.hash(*parts)}
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = near_duplicates(narrow, width, percent)
    group = F.coalesce(F.hex("root"), F.col("row_key").cast("string")).alias("group")
    kept = found.filter("kept").groupBy(group).agg(F.min("row_key").alias("_k1")).select("_k1")
    whole = docs.select(F.struct("*").alias("_row"), *[v.alias(k) for k, v in keys.items()])
    return whole.join(kept, "_k1", "left_semi").dropDuplicates(["_k1", "_k2"]).select("_row.*")
