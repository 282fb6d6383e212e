"""SimHash near-duplicates with BK-trees over shards of equal bit blocks.

A fingerprint bit is set when it is set in over half the hashes of the text's word
shingles. Two fingerprints within ``radius`` bits agree on at least
``blocks - radius`` of ``blocks`` bit blocks, so every linked pair meets in a shard
keyed by one choice of blocks and their bits. In a shard, a BK-tree (children keyed
by their Hamming distance to the parent) answers each fingerprint by following only
the edges within the radius of its distance to a node.

Fingerprints are made distinct first, so exact copies cost one row. A shard's
fingerprints beyond ``shard_size`` are split: its trees (of at most ``shard_size``
fingerprints) are each sent to all of its query blocks, so no task holds more than
one tree and one block, whatever the shard's size, and no pair is missed. A task
returns, per tree, a chain through the fingerprints that it found linked, never all
pairs of a group.

Components: labels start at the smallest doc_id of a fingerprint; each round hooks
the label groups that a link joins and follows the hooks to their end. Every round
is written to the shared folder; rows of hot labels are spread by ``lookup_join``.

Defined results: NULL, empty and blank texts have no shingle and fingerprint zero,
linked like any other; a text with fewer words than a shingle is one shingle; NULL
doc_ids take part, and a component of NULL ids only has id NULL; repeated rows each
get a row; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, lookup_join, shuffle_parts, stored


def _bit_counts() -> np.ndarray:
    """For each byte value, its 8 bits as 8 counters of one byte in a 64-bit word."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


COUNTS = _bit_counts()


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a text's XXH64 word-shingle hashes, as an unsigned 64-bit number."""
    found = text.encode("utf-8").lower().split() if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    lens = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    n = max(len(found) - shingle + 1, 1)
    last = ends[min(shingle, len(found)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last, strict=True)], "<u8")
    total = np.zeros(64, np.int64)
    for at in range(0, n, 65_025):  # 255 rows at most add up in a one-byte counter
        part = hashes[at:at + 65_025].view(np.uint8).reshape(-1, 8)
        rows = np.add.reduceat(COUNTS[part], np.arange(0, len(part), 255), axis=0)
        total += rows.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in part], np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp"))


class BKTree:
    """Distinct fingerprints; each node's children are keyed by distance to it."""

    def __init__(self, fps: np.ndarray):
        self.fps = np.asarray(fps, np.uint64)
        self.child = np.full((len(fps), 65), -1, np.int32)
        # All fingerprints sink together: at each level they move along the edge of their
        # distance, and the first to ask for an empty edge becomes the node there.
        waiting = np.arange(1, len(fps))
        node = np.zeros(len(waiting), np.int64)
        while len(waiting):
            edge = np.bitwise_count(self.fps[waiting] ^ self.fps[node]).astype(np.int64)
            to = self.child[node, edge]
            empty = np.flatnonzero(to < 0)
            _, first = np.unique(node[empty] * 65 + edge[empty], return_index=True)
            self.child[node[empty[first]], edge[empty[first]]] = waiting[empty[first]]
            to = self.child[node, edge]
            keep = to != waiting
            waiting, node = waiting[keep], to[keep].astype(np.int64)

    def near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) positions within ``radius``, one tree level at a time."""
        queries = np.asarray(queries, np.uint64)
        hits = []
        span = np.arange(-radius, radius + 1)
        for at in range(0, len(queries), 512):
            q = np.arange(at, min(at + 512, len(queries)))
            node = np.zeros(len(q), np.int64)
            while len(q):
                d = np.bitwise_count(queries[q] ^ self.fps[node]).astype(np.int64)
                near = d <= radius
                hits.append(np.stack([q[near], node[near]]))
                edges = d[:, None] + span
                to = np.where((edges >= 1) & (edges <= 64), self.child[node[:, None], np.clip(edges, 0, 64)], -1)
                keep = to >= 0
                q, node = np.repeat(q, keep.sum(axis=1)), to[keep].astype(np.int64)
        found = np.concatenate(hits, axis=1) if hits else np.zeros((2, 0), np.int64)
        return found[0], found[1]


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def chain(a: np.ndarray, b: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Links that join what the pairs (a, b) of 0..size-1 join, each position in two
    links at most."""
    parent = list(range(size))
    touched = np.unique(np.concatenate([a, b]))
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = _find(parent, i), _find(parent, j)
        if x != y:
            parent[max(x, y)] = min(x, y)
    last: dict[int, int] = {}
    links = []
    for i in touched.tolist():
        root = _find(parent, i)
        if root in last:
            links.append((last[root], i))
        last[root] = i
    return links


def _shard_links(trees: np.ndarray, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (fp, fp) between one tree's fingerprints and one block of queries."""
    fps = np.unique(np.concatenate([trees, queries]))
    tree = BKTree(trees)
    q, node = tree.near(queries, radius)
    a, b = np.searchsorted(fps, queries[q]), np.searchsorted(fps, trees[node])
    keep = a != b
    return [(int(fps[i]), int(fps[j])) for i, j in chain(a[keep], b[keep], len(fps))]


def _block_bounds(blocks: int) -> list[tuple[int, int]]:
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def shard_keys(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(choice, part, fp): every choice of ``blocks - radius`` blocks, and the
    fingerprint's bits there."""
    masks = []
    for c in combinations(_block_bounds(blocks), blocks - radius):
        mask = sum(((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in c)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    choices = F.array(*[F.lit(m).cast("long") for m in masks])
    return fps.select("fp", F.posexplode(choices).alias("choice", "_mask")).select(
        "choice", F.col("fp").bitwiseAND(F.col("_mask")).alias("part"), "fp")


def links(fps: DataFrame, radius: int = 4, blocks: int = 6, shard_size: int = 2_048) -> DataFrame:
    """(a, b): links that connect exactly the distinct ``fps`` (fp) that chains of
    pairs within ``radius`` bits connect."""
    keyed = shard_keys(fps, radius, blocks)
    sizes = (keyed.groupBy("choice", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .withColumn("splits", F.ceil(F.col("n") / shard_size).cast("int")))
    sizes = stored(sizes, "simhash-shards")
    # A fingerprint belongs to one split of its shard: its tree there answers the queries of
    # that split and of all later ones.
    placed = (lookup_join(keyed, sizes, ["choice", "part"], "n").where(F.col("splits").isNotNull())
              .withColumn("split", F.pmod(F.xxhash64("fp"), F.col("splits")).cast("int")))
    as_tree = placed.select("choice", "part", F.col("split").alias("tree"), "fp", F.explode(
        F.sequence(F.col("split"), F.col("splits") - 1)).alias("block"), F.lit(0).alias("asks"))
    as_query = placed.select("choice", "part", F.explode(
        F.sequence(F.lit(0), F.col("split"))).alias("tree"), "fp", F.col("split").alias("block"),
        F.lit(1).alias("asks"))
    cell = ["choice", "part", "tree", "block"]
    # In a cell of equal tree and block the tree asks itself.
    rows = as_tree.unionByName(as_query.where("tree < block")).select(*cell, "asks", "fp")
    n = shuffle_parts(fps.sparkSession)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def run(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
            found: list[tuple[int, int]] = []
            keys = part[cell].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            fp, asks = part["fp"].to_numpy().view(np.uint64), part["asks"].to_numpy()
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(part)]])
            # Cells of two fingerprints: a tree of one node and one query.
            pairs = starts[stops - starts == 2]
            near = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= radius]
            a, b = [fp[near].view(np.int64)], [fp[near + 1].view(np.int64)]
            for i, j in zip(starts.tolist(), stops.tolist(), strict=True):
                if j - i > 2:
                    tree, block = fp[i:j][asks[i:j] == 0], fp[i:j][asks[i:j] == 1]
                    if len(tree):  # a split may have no fingerprint
                        found += _shard_links(tree, block if len(block) else tree, radius)
            got = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"a": np.concatenate([a[0], got[:, 0]]), "b": np.concatenate([b[0], got[:, 1]])})

        for part in batches:
            if not len(part):
                continue
            held.append(part)
            whole = pd.concat(held) if len(held) > 1 else part
            last = whole[cell].iloc[-1]
            open_ = (whole[cell] == last).all(axis=1).to_numpy()  # its cell may go on
            first = len(whole) - int(open_[::-1].argmin()) if not open_.all() else 0
            if first:
                yield from run(whole.iloc[:first])
            held = [whole.iloc[first:]]
        if held and len(held[0]):
            yield from run(pd.concat(held))

    return (rows.repartition(n, *cell).sortWithinPartitions(*cell, "asks", "fp")
            .mapInPandas(search, "a long, b long").where("a <> b").distinct())


def group_labels(nodes: DataFrame, edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(fp, label) of the ``nodes`` (fp, id) that ``edges`` (a, b) link: the smallest
    (last, id, fp) reachable, ``last`` marking a NULL id."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                  "simhash-edges")
    inside = both.select(F.col("a").alias("fp")).distinct()
    # A label is the fingerprint that stands for the group: the one of smallest (id, fp).
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("fp").alias("fp"))
    labels = stored(nodes.join(inside, "fp", "left_semi").select("fp", order.alias("label")), "simhash-labels")
    for _ in range(max_rounds):  # each halves the linked groups at least: enough for 2^64 fingerprints
        near = (both.join(labels, F.col("a") == F.col("fp")).select(F.col("b").alias("fp"), "label")
                .groupBy("fp").agg(F.min("label").alias("seen")))
        # Each group hooks onto the smallest label that any member saw.
        hooks = (labels.join(near, "fp").groupBy("label")
                 .agg(F.min("seen").alias("to"), F.count(F.lit(1)).alias("n"))
                 .withColumn("to", F.least("to", "label")))
        hooks = stored(hooks, "simhash-hooks")
        if not hooks.where("to < label").head(1):
            drop_stored(hooks)
            break
        while True:  # follow the hooks to their ends
            weights = hooks.groupBy("to").agg(F.count(F.lit(1)).alias("_w"))
            ends = (weights.join(hooks.select(F.col("label").alias("_l"), F.col("to").alias("_end")),
                                 F.col("to") == F.col("_l")).select("to", "_w", "_end"))
            jumped = stored(lookup_join(hooks, ends, ["to"], "_w").select(
                "label", F.coalesce("_end", "to").alias("to"), "n",
                (F.coalesce("_end", "to") < F.col("to")).alias("moved")), "simhash-hooks")
            moved = bool(jumped.where("moved").head(1))
            drop_stored(hooks)
            hooks = jumped.drop("moved")
            if not moved:
                break
        new = stored(lookup_join(labels, hooks.withColumnRenamed("to", "_to"), ["label"], "n")
                     .select("fp", F.coalesce("_to", "label").alias("label")), "simhash-labels")
        drop_stored(labels)
        drop_stored(hooks)
        labels = new
    return labels


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(fp, component, label) from ``nodes`` (fp, id) and ``edges`` (a, b): the smallest
    id reachable, and the fingerprint that stands for the group. NULL ids sort last."""
    labels = group_labels(nodes, edges, max_rounds)
    alone = (nodes.join(labels.select("fp"), "fp", "left_anti")
             .select("fp", F.col("id").alias("component"), F.col("fp").alias("label")))
    return alone.unionByName(labels.select("fp", F.col("label.id").alias("component"), F.col("label.fp").alias("label")))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, blocks: int = 6,
                    shard_size: int = 2_048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stored(fingerprints(docs, shingle, doc_id, text), "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")),
                   "simhash-nodes")
    edges = links(nodes.select("fp"), radius, blocks, shard_size)
    groups = components(nodes, edges).drop("label").join(nodes.select("fp", "copies"), "fp")
    return lookup_join(prints, groups, ["fp"], "copies").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"))


def group_decisions(docs: DataFrame, shingle: int = 4, radius: int = 4, blocks: int = 6, shard_size: int = 2_048,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, hash, copies, stays): what becomes of the rows of each (doc_id, md5 of the
    text) in a group of more than one row. The smallest key, NULL ids last, stays (one
    row of it); rows of other keys go. Rows that stand alone have no decision."""
    key = F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"), text_hash(text).alias("hash"))
    prints = fingerprints(docs.select(key.alias("doc_id"), F.col(text).alias("text")), shingle)
    rows = stored(prints.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("copies")), "simhash-rows")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.sum("copies").alias("copies"))
                   .select("fp", F.col("first.id").alias("id"), "first", "copies"), "simhash-nodes")
    labels = group_labels(nodes.select("fp", "id"), links(nodes.select("fp"), radius, blocks, shard_size))
    # A fingerprint without links is a group by itself; of the linked ones each row is joined once.
    alone = (nodes.where(F.col("copies") > 1).join(labels.select("fp"), "fp", "left_anti")
             .select("fp", F.col("first").alias("winner"), "copies"))
    members = stored(labels.select("fp", F.col("label.fp").alias("label")).join(nodes.select("fp", "first", "copies"), "fp"),
                     "simhash-members")
    winners = members.groupBy("label").agg(F.min("first").alias("winner"), F.count(F.lit(1)).alias("_members"))
    linked = lookup_join(members.select("fp", "label", "copies"), winners, ["label"], "_members")
    of = stored(alone.unionByName(linked.select("fp", "winner", "copies")), "simhash-winners")
    return lookup_join(rows, of.withColumnRenamed("copies", "_n"), ["fp"], "_n").where(F.col("winner").isNotNull()).select(
        F.col("doc_id.id").alias("doc_id"), F.col("doc_id.hash").alias("hash"), "copies",
        (F.col("doc_id") == F.col("winner")).alias("stays"))


def text_hash(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
