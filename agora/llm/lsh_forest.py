"""Near-duplicate documents by an LSH forest over MinHash signatures.

Words are runs of bytes other than ASCII white space after lower-casing A-Z; a
document's set are its distinct shingles of ``SHINGLE`` words, or its whole
sequence of words if it has fewer.  Two documents are linked when their sets have
a Jaccard similarity of at least ``PERCENT`` / 100.

1.  Documents with equal sets are one node (128-bit set hash); copies are never
    expanded into pairs.
2.  A node's signature has ``TREES`` * ``STEP`` minima.  Tree t orders the nodes by
    the signature read in a circle from position t * STEP.  Nodes that share their
    first ``DEPTHS[0]`` values in a tree are a region of it.  A region that is too
    heavy for a task is cut deeper, by more values, as far as it takes; its nodes
    also become candidates of the region's smallest member.
3.  In a region's order neighbours have the longest common prefixes: each node and
    the next one are a candidate pair.  Pairs are confirmed on full sets.
4.  A region all of whose pairs are confirmed is one component.  Where one failed,
    all nodes of the region are compared, on full sets, with those not in its
    largest component so far, so no link within a region is lost.
5.  Cutting only finds the first links of a region that is too heavy.  The nodes of
    all such regions are then compared by prefixes: two sets that are linked share
    one of their ``n - ceil(n * PERCENT / 100) + 1`` rarest shingles, in any order of
    rarity that all sets agree on.  Nodes with such a shingle in common are a group
    and are compared like a region.
6.  Links make components.

With 24 trees of depth 3 a pair at similarity 0.75 shares no region with
probability 2e-6, however heavy its regions are.  Weight bounds
(``REGION_SHINGLES``) decide how work is dealt out, not what is compared: a group
beyond it is compared block by block.

Nulls: a null, empty or wordless text has an empty set and is linked with nothing;
a row without ``doc_id`` is linked with nothing either and has no component.
Repeated rows have the same set and so the same component.  Other columns are
ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import batches
from agora.llm.components import components
from agora.llm.words import NOT_SPACE, Block, Powers, blocks, mix, rolled, scan
from agora.sources.staging import stage

SHINGLE = 5
PERCENT = 75
TREES = 24
STEP = 4
DEPTHS = (3, 5, 8, 12, 20, 36, 68)
REGION_SHINGLES = 1_000_000
#: Values by which a region's nodes are ordered.
ORDERED = 16
#: Shingles are ordered by the counts of so many hash buckets, and then by hash.
RARITY_BITS = 20
_VALUES = TREES * STEP
_SEEDS = mix(np.arange(1, 2 * _VALUES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def shingle_sets(block: Block, powers: Powers) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending."""
    words = scan(block, NOT_SPACE, powers)
    hashed = rolled(words.hash, SHINGLE)
    ends = np.searchsorted(words.doc, np.arange(block.last - block.first + 1))
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a >= SHINGLE:
            own = np.sort(hashed[a : b - SHINGLE + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            own = rolled(words.hash[a:b], b - a) if b > a else np.empty(0, np.uint64)
        out.append(own)
    return out


def _prints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Set hashes (n, 2) and signatures (n, values) of sets that are not empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(x) for x in sets[:-1])])
    prints = np.stack([np.add.reduceat(mix(flat ^ s), starts) for s in (np.uint64(1), np.uint64(0xABCDEF))], axis=1)
    signature = np.empty((len(sets), _VALUES), ">u4")
    for k in range(_VALUES):
        drawn = ((flat ^ _SEEDS[k]) * (_SEEDS[_VALUES + k] | np.uint64(1))) >> np.uint64(32)
        signature[:, k] = np.minimum.reduceat(drawn.astype(np.uint32), starts)
    return mix(prints), signature


def _signatures(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches(source):
        for block in blocks(batch.column("text")):
            sets = shingle_sets(block, powers)
            docs = len(sets)
            sizes = np.array([len(x) for x in sets], np.int64)
            some = np.flatnonzero(sizes)
            prints: list[bytes | None] = [None] * docs
            signatures: list[bytes | None] = [None] * docs
            if len(some):
                found, values = _prints([sets[i] for i in some])
                for i, p, s in zip(some.tolist(), found, values):
                    prints[i], signatures[i] = p.tobytes(), s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.slice(block.first, docs).column("doc_id").cast(pa.int64()),
                    batch.slice(block.first, docs).column("text_hash"),
                    pa.array(sizes),
                    pa.array(prints, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "print", "signature"],
            )


def _sets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches(source):
        for block in blocks(batch.column("text")):
            sets = shingle_sets(block, powers)
            piece = batch.slice(block.first, len(sets))
            wanted = piece.column("print").to_pylist()
            rows = [i for i, x in enumerate(sets) if len(x) and _one_print(x) == wanted[i]]
            nodes = piece.column("node").take(pa.array(rows, pa.int64()))
            values = [sets[i].view(np.int64) for i in rows]
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *values]))
            ends = pa.array(np.cumsum([0, *(len(x) for x in values)]), pa.int32())
            yield pa.RecordBatch.from_arrays([nodes, pa.ListArray.from_arrays(ends, flat)], names=["node", "shingles"])


def _one_print(own: np.ndarray) -> bytes:
    sums = np.array([mix(own ^ s).sum(dtype=np.uint64) for s in (np.uint64(1), np.uint64(0xABCDEF))], np.uint64)
    return mix(sums).tobytes()


def _resolve(group: pa.Table) -> pa.Table:
    """Links between different components of a region, one for each pair of components that meets."""
    nodes = group.column("node").to_numpy()
    label = group.column("label").to_numpy()
    column = group.column("shingles").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy()
    sizes = np.diff(column.offsets.to_numpy())
    starts = np.cumsum(sizes) - sizes
    by = np.argsort(flat)
    ordered = flat[by]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    number = np.empty(len(flat), np.int64)
    number[by] = np.cumsum(new) - 1
    values, own = np.unique(label, return_inverse=True)
    weight = np.bincount(own)
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[tuple[int, int]] = []
    marked = np.zeros(int(new.sum()), np.int32)
    for i in np.flatnonzero(own != weight.argmax()).tolist():
        mine = number[starts[i] : starts[i] + sizes[i]]
        marked[mine] = 1
        shared = np.add.reduceat(marked[number], starts)
        marked[mine] = 0
        linked = np.flatnonzero(100 * shared >= PERCENT * (sizes + sizes[i] - shared))
        for j in linked.tolist():
            a, b = root(int(own[i])), root(int(own[j]))
            if a != b:
                parent[a] = b
                out.append((int(nodes[i]), int(nodes[j])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Mixed shingles of a batch's sets, one after the other, and the sizes of the sets."""
    column = batch.column("shingles")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return mix(column.flatten().to_numpy().view(np.uint64)), sizes


def _bucket_counts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << RARITY_BITS, np.int64)
    for batch in batches(source):
        flat, _ = _flat(batch)
        counts += np.bincount((flat >> np.uint64(64 - RARITY_BITS)).astype(np.int64), minlength=len(counts))
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])


def _rarest(sent):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            flat, sizes = _flat(batch)
            count = sent.value[(flat >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]
            owner = np.repeat(np.arange(len(sizes)), sizes)
            by = np.lexsort((flat, count, owner))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            reach = sizes + (-PERCENT * sizes) // 100 + 1
            # a shingle that is alone in its bucket is in one set only
            kept = by[(place < reach[owner]) & (count[by] > 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(flat[kept].view(np.int64)),
                    batch.column("node").take(pa.array(owner[kept])),
                    pa.array(sizes[owner[kept]]),
                ],
                names=["key", "node", "weight"],
            )

    return rows


def _prefixes(sets: DataFrame) -> DataFrame:
    """Groups (key, node, weight) of sets that have one of their rarest shingles in common."""
    counted = sets.select("shingles").mapInArrow(_bucket_counts, "bucket long, n long")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most 2 ** RARITY_BITS rows
    counts = np.zeros(1 << RARITY_BITS, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    sent = sets.sparkSession.sparkContext.broadcast(counts)
    return sets.select("node", "shingles").mapInArrow(_rarest(sent), "key long, node long, weight long")


def _compared(groups: DataFrame, label: DataFrame, sets: DataFrame, bound: int) -> DataFrame:
    """Links (a, b) that join all components that meet in a group (key, node, weight).

    Nodes outside a group's heaviest component are compared with all its nodes.  Both
    are dealt into blocks of ``bound`` shingles, and each two blocks go to one task.
    """
    labelled = stage(
        groups.join(label, "node", "left").select("key", "node", "weight", F.coalesce("label", "node").alias("label")),
        "labelled",
    )
    each = labelled.groupBy("key", "label").agg(
        F.sum("weight").alias("weight"), F.count("*").alias("size"),
        F.sum(F.xxhash64("node") % (1 << 40)).alias("h1"), F.sum(F.xxhash64("node", F.lit(1)) % (1 << 40)).alias("h2"),
    )
    heaviest = F.max(F.struct("weight", "label"))
    parts = lambda weight: F.ceil(weight / bound)
    # groups often have the same members: one of them is enough
    mixed = (
        each.groupBy("key")
        .agg(
            F.count("*").alias("labels"), heaviest.alias("main"), F.sum("weight").alias("total"),
            F.sum("size").alias("size"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"),
        )
        .where(F.col("labels") > 1)
        .select(
            "size", "h1", "h2", "key", F.col("main.label").alias("main"),
            parts(F.col("main.weight")).alias("mains"), parts(F.col("total") - F.col("main.weight")).alias("rests"),
        )
        .groupBy("size", "h1", "h2")
        .agg(F.min(F.struct("key", "main", "mains", "rests")).alias("one"))
        .select("one.*")
    )
    dealt = F.xxhash64("node", F.lit(2))
    inside = F.col("label") == F.col("main")
    own = F.when(inside, F.col("rests") + F.pmod(dealt, "mains")).otherwise(F.pmod(dealt, "rests"))
    last = F.when(inside, F.col("rests")).otherwise(F.col("rests") + F.col("mains")) - 1
    others = F.filter(F.sequence(F.lit(0).cast("long"), last), lambda other: other != F.col("own"))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key")
    open_ = (
        labelled.join(stage(mixed, "mixed"), "key")
        .select("key", "node", "label", own.alias("own"), last.alias("last"), "rests", "mains", "main")
        .withColumn("other", F.explode(others))
        .select(pair, "node", "label")
    )
    return open_.join(sets, "node").groupBy("key").applyInArrow(_resolve, "a long, b long")


def _regions(nodes: DataFrame, region_shingles: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Members of all regions (key, node, weight, order, members), candidates (a, b) and nodes of those that were cut."""
    circle = F.concat("signature", "signature")
    values = lambda count, tree: F.substring(circle, 4 * STEP * tree + 1, 4 * count)
    prefixes = F.array(*[F.xxhash64(F.lit(t), values(DEPTHS[0], F.lit(t))) for t in range(TREES)])
    signatures = nodes.select("node", "signature")
    level = nodes.select("node", F.col("n").alias("weight"), F.posexplode(prefixes).alias("tree", "key"))
    found: list[DataFrame] = []
    stars: list[DataFrame] = []
    cut = None
    # only ids move until the regions are known; signatures are fetched for members of regions
    for step in range(len(DEPTHS)):
        sizes = stage(
            level.groupBy("key")
            .agg(F.count("*").alias("members"), F.sum("weight").alias("total"), F.min("node").alias("centre"))
            .where(F.col("members") > 1),
            "regions",
        )
        light = (F.col("total") <= region_shingles) | (F.col("members") == 2)
        heavy = sizes.where(~light)
        found.append(level.join(sizes.where(light).select("key", "members"), "key").select("key", "node", "weight", "tree", "members"))
        if not heavy.take(1):
            break
        inner = level.join(heavy.select("key", "centre", "members"), "key")
        stars.append(inner.where(F.col("node") != F.col("centre")).select(F.col("centre").alias("a"), F.col("node").alias("b")))
        if cut is None:
            cut = stage(inner.select("node").distinct(), "cut")
        if step == len(DEPTHS) - 1:  # equal in this many values: hashed parts, next to the star
            part = F.xxhash64("key", F.pmod(F.col("node"), F.ceil(F.col("members") / 1000)))
            found.append(inner.select(part.alias("key"), "node", "weight", "tree", "members"))
            break
        deeper = F.xxhash64("key", values(DEPTHS[step + 1], F.col("tree"))).alias("key")
        level = stage(inner.join(signatures, "node").select(deeper, "node", "weight", "tree"), "region-members")
    members = found[0]
    for more in found[1:]:
        members = members.unionByName(more)
    star = None
    for more in stars:
        star = more if star is None else star.unionByName(more)
    order = values(ORDERED, F.col("tree")).alias("order")
    return members.join(signatures, "node").select("key", "node", "weight", "members", order), star, cut


def near_duplicates(docs: DataFrame, region_shingles: int = REGION_SHINGLES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    # an id may have many texts: a text is found again by its hash as well
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    prints = stage(
        texts.mapInArrow(
            _signatures, "doc_id long, text_hash long, n_shingles long, print binary, signature binary"
        ),
        "signatures",
    )
    classes = (
        prints.where(F.col("print").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("print")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("first"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
        )
        .select("print", F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("text_hash"), "n", "signature")
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = stage(classes, "nodes")
    members, star, cut = _regions(nodes, region_shingles)
    members = stage(members, "members")
    order = Window.partitionBy("key").orderBy("order", "node")
    chain = (
        members.withColumn("next", F.lead("node").over(order))
        .where(F.col("next").isNotNull())
        .select("key", "members", F.least("node", "next").alias("a"), F.greatest("node", "next").alias("b"))
    )
    chain = stage(chain, "chains")
    pairs = chain.select("a", "b")
    if star is not None:
        pairs = pairs.unionByName(star)
    pairs = stage(pairs.distinct(), "candidates")
    used = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.join(used, "node").select("node", F.col("id").alias("doc_id"), "text_hash", "print")
    sets = stage(
        texts.join(wanted, ["doc_id", "text_hash"])
        .select("node", "print", "text")
        .mapInArrow(_sets, "node long, shingles array<bigint>")
        .dropDuplicates(["node"]),
        "shingle-sets",
    )
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    linked = 100 * shared >= PERCENT * (F.size("left") + F.size("right") - shared)
    judged = stage(pairs.join(left, "a").join(right, "b").select("a", "b", linked.alias("linked")), "judged")
    sure = judged.where("linked").select("a", "b")
    first = stage(components(sure), "first-components")
    failed = chain.where(F.col("members") > 2).join(judged.where(~F.col("linked")).select("a", "b"), ["a", "b"], "left_semi")
    open_ = members.join(failed.select("key").distinct(), "key", "left_semi").select("key", "node", "weight")
    sure = stage(sure.unionByName(_compared(open_, first, sets, region_shingles)), "sure")
    label = stage(components(sure), "components")
    if cut is not None:
        groups = _prefixes(sets.join(cut, "node", "left_semi"))
        label = components(sure.unionByName(_compared(groups, label, sets, region_shingles)))
    least = label.join(nodes.select("node", "id"), "node").groupBy("label").agg(F.min("id").alias("least"))
    ids = nodes.select("print", "node", "id").join(label, "node", "left").join(least, "label", "left")
    ids = ids.select("print", F.coalesce("least", "id").alias("class_id"))
    known = prints.select("doc_id", "n_shingles", "print")
    named = known.join(ids, "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return named.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as (
  select doc_id, list_distinct(
    case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) end) as s
  from words
),
flat as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as n, any_value(a.n) as nx, any_value(b.n) as ny
  from flat a join flat b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
),
links as (select x, y from shared where 100 * n >= 75 * (nx + ny - n)),
sides as (select x, y from links union all select y, x from links),
reached as (
  select doc_id as node, doc_id as label from sets
  union
  select sides.y, reached.label from reached join sides on sides.x = reached.node and reached.label < sides.y
),
least as (select node, min(label) as label from reached group by node)
select doc_id, cast(len(s) as bigint) as n_shingles, label as component_id, doc_id = label as kept
from sets join least on node = doc_id
"""
