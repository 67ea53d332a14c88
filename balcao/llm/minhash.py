"""Near-duplicate documents by a join on signature coordinates.

Documents with equal shingle sets are one node. Each node's signature has ``COORDINATES``
minima, and the inverted index posts nodes under (coordinate, value). Pairs at the
similarity wanted share at least ``matches_for`` it coordinates, up to a chance of about one
in 100,000 right at the limit. So two such nodes meet under one of each node's
COORDINATES - matches + 1 rarest values (the prefix); values only one node has need no
posting at all, which leaves nothing of most documents. Under a value, the signatures are
merged: pairs are skipped whose sizes are too far apart, the others' collisions are counted,
and those with too few fall away.

Only connections are wanted, so pairs of nodes that are already connected are skipped too.
Candidates are confirmed on the full sets, each node's best few partners under a value first.
Values whose nodes have more candidates than that, or are too many to meet at once, stay open.
Their nodes meet again with their whole sets, dealt into blocks of bounded size: each pair of
blocks is a group that compares across, confirms what is still unconnected right there, and
returns a spanning forest of the links it finds, fewer rows than nodes. Nodes of the value's
largest component, which need not meet each other, have blocks of their own. No candidate that
could connect two components is left out.

Null texts count as empty; empty texts are linked with nothing. Rows that share an id count
each on their own; where all ids of a component are null its id is null. An empty table gives
an empty result. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.llm.components import components
from balcao.llm.membership import likely_members
from balcao.llm.shingle_sets import set_ids, shingle_sets
from balcao.llm.word_ids import slices
from balcao.sources.staging import staged

COORDINATES = 64
SIGMAS = 4.2  # standard deviations below the mean that collisions of a linked pair may lie
_NOTHING = 1 << 40  # above every 32-bit hash of a key
BLOCK_NODES = 2_000  # nodes of one value in a block, on average; two blocks are compared at a time
BUCKET_POSTINGS = 20_000  # postings worked on in one call, on average
BEST = 2  # partners of a node under one value that are confirmed first
NODE_SHINGLES = 500  # as many weigh as much as one node, when sets are dealt into blocks
BUCKET_WEIGHT = 4_000  # of nodes with their sets worked on in one call, on average


def matches_for(least_percent: int) -> int:
    """Collisions that a pair at the limit of similarity has but for a negligible chance."""
    share = least_percent / 100
    return max(1, int(COORDINATES * share - SIGMAS * (COORDINATES * share * (1 - share)) ** 0.5))


def _factors() -> np.ndarray:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)


def signatures(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima of every non-empty set under each coordinate's hash: 32-bit values."""
    found = np.zeros((len(starts) - 1, COORDINATES), dtype=np.uint32)
    some = np.flatnonzero(np.diff(starts))
    if len(some):
        for c, factor in enumerate(_factors()):
            values = ((hashes ^ (hashes >> np.uint64(31))) * factor >> np.uint64(32)).astype(np.uint32)
            found[some, c] = np.minimum.reduceat(values, starts[:-1][some])
    return found


def document_signatures(
    docs: DataFrame, width: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node`` (number of the set, 0 if empty), ``signature``."""
    id_type = dict(docs.dtypes)[id_column]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                hashes, starts = shingle_sets(part.column(1), width)
                values = signatures(hashes, starts).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(part) + 1, dtype=np.int32) * COORDINATES), pa.array(values.ravel())
                )
                nodes = set_ids(hashes, starts).view(np.int64)
                yield pa.record_batch(
                    [part.column(0), pa.array(np.diff(starts)), pa.array(nodes), lists],
                    names=["doc_id", "n_shingles", "node", "signature"],
                )

    schema = f"doc_id {id_type}, n_shingles bigint, node bigint, signature array<int>"
    return docs.select(id_column, text_column).mapInArrow(sign, schema)


def prefix_postings(nodes: DataFrame, matches: int) -> DataFrame:
    """``key`` (coordinate and value), ``node``, ``posted``: each node's rarest shared values.

    ``posted`` holds the hashes of all keys that the node is posted under.
    """
    posted = nodes.select("node", F.posexplode("signature").alias("coordinate", "value")).select(
        "node",
        F.shiftleft(F.col("coordinate").cast("bigint"), 32)
        .bitwiseOR(F.col("value").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))
        .alias("key"),
    )
    shared = posted.groupBy("key").agg(F.count("*").alias("nodes")).where("nodes > 1")
    ranked = posted.join(shared, "key").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("nodes", "key"))).alias("keys")
    )
    # Values of its own come first in a node's order, and need no posting.
    own = F.lit(COORDINATES) - F.size("keys")
    wanted = F.greatest(F.lit(COORDINATES - matches + 1) - own, F.lit(0))
    posted = F.slice("keys", F.lit(1), wanted)
    hashes = F.transform(posted, lambda k: F.hash(k["key"]))
    return ranked.select("node", hashes.alias("posted"), F.explode(posted).alias("k")).select(
        "node", "posted", "k.key"
    )


def _blocks(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``postings`` with ``label``, the ``block`` (a pair of blocks of their key) and ``side``.

    Nodes with a ``weight`` fill blocks of ``BLOCK_NODES`` by it; without, each counts as one.

    Nodes of a block pair are compared if their sides differ; side 0 is compared with itself.
    So every two nodes of a key meet once, but for those of its largest component. In the first
    round, when nothing is known of components, blocks are only compared inside.
    """
    if labels is None:
        labelled = postings.withColumn("label", F.col("node")).withColumn("is_main", F.lit(False))
        sizes = postings.groupBy("key").agg(F.count("*").alias("others"), F.lit(0).alias("mains"))
    else:
        labelled = postings.join(labels, "node", "left").withColumn(
            "label", F.coalesce("label", "node")
        )
        weight = F.sum("weight") if "weight" in postings.columns else F.count("*")
        by_label = labelled.groupBy("key", "label").agg(weight.alias("n"))
        sizes = by_label.groupBy("key").agg(
            F.sum("n").alias("size"),
            F.max(F.struct("n", "label")).alias("main"),
            F.count("*").alias("labels"),
        ).where("labels > 1")
        # Few nodes are one block.
        is_split = F.col("size") > BLOCK_NODES
        sizes = sizes.select(
            "key",
            F.when(is_split, F.col("main.label")).alias("main"),
            F.when(is_split, F.col("size") - F.col("main.n")).otherwise(F.col("size")).alias("others"),
            F.when(is_split, F.col("main.n")).otherwise(F.lit(0)).alias("mains"),
        )
        labelled = labelled.join(sizes.select("key", "main"), "key").withColumn(
            "is_main", F.col("label").eqNullSafe(F.col("main"))
        )

    def count(column: str):
        return F.ceil(F.col(column) / BLOCK_NODES).cast("int").alias(column)

    dealt = labelled.join(sizes.select("key", count("others"), count("mains")), "key")
    own = F.when(
        F.col("is_main"), F.col("others") + F.pmod(F.xxhash64("node", "key"), F.col("mains"))
    ).otherwise(F.pmod(F.xxhash64("node", "key"), F.col("others")))
    dealt = dealt.withColumn("own", own.cast("int"))
    if labels is None:
        met = F.array("own")
    else:
        met = F.sequence(F.lit(0), F.col("others") - 1 + F.when(F.col("is_main"), 0).otherwise(F.col("mains")))
    low, high = F.least("own", "met").cast("bigint"), F.greatest("own", "met")
    side = F.when(F.col("own") == F.col("met"), 0).when(F.col("own") < F.col("met"), 1).otherwise(2)
    return dealt.withColumn("met", F.explode(met)).withColumns(
        {"block": low * (F.col("others") + F.col("mains")) + high, "side": side}
    )


def _collisions(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left == right).sum(axis=-1, dtype=np.int16)


def _first_meeting(left: np.ndarray, right: np.ndarray, key: np.ndarray | int) -> np.ndarray:
    """Whether pairs of nodes meet under ``key`` first: it is the least both are posted under."""
    found = np.zeros(len(left), dtype=bool)
    for first in range(0, len(left), 2048):
        some = slice(first, first + 2048)
        a, b = left[some, :, None], right[some, None, :]
        least = np.where((a == b) & (a != _NOTHING), a, _NOTHING).min(axis=(1, 2))
        found[some] = least == (key if np.isscalar(key) else key[some])
    return found


def _across(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether nodes of these sides are compared: two blocks that meet are not compared inside."""
    return (left != right) | (left == 0)


def _candidates(
    values: np.ndarray, sizes: np.ndarray, labels: np.ndarray, sides: np.ndarray, first: int, least_percent: int
) -> np.ndarray:
    """Collisions of a few nodes from ``first`` on with all of a group; 0 for what cannot be a new link."""
    some = slice(first, first + 64)
    alike = _collisions(values[some, None, :], values[None, :, :])
    small = np.minimum(sizes[some, None], sizes[None, :])
    large = np.maximum(sizes[some, None], sizes[None, :])
    apart = (labels[some, None] != labels[None, :]) & (100 * small >= least_percent * large)
    apart &= _across(sides[some, None], sides[None, :])
    return np.where(apart & (alike >= matches_for(least_percent)), alike, 0)


def _partners_in_group(
    values: np.ndarray, sizes: np.ndarray, labels: np.ndarray, sides: np.ndarray, posted: np.ndarray, key: int, least_percent: int
) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the best candidate pairs of one group, and whether there are more.

    Only pairs that meet here first, so that a pair is not found once for each common key.
    """
    left, right, more = [], [], False
    for first in range(0, len(values), 64):
        alike = _candidates(values, sizes, labels, sides, first, least_percent)
        if alike.shape[1] > BEST:
            # Ties at the limit: the first ones, as many as are wanted.
            rank = np.argsort(np.argsort(-alike, axis=1, kind="stable"), axis=1, kind="stable")
            more = more or bool(((alike > 0) & (rank >= BEST)).any())
            alike = np.where(rank < BEST, alike, 0)
        i, j = np.nonzero(alike)
        here = _first_meeting(posted[i + first], posted[j], key)
        left.append(i[here] + first)
        right.append(j[here])
    i, j = np.concatenate(left), np.concatenate(right)
    pairs = np.unique(np.minimum(i, j) * len(values) + np.maximum(i, j))
    return pairs // len(values), pairs % len(values), more


class _Bucket:
    """Postings of a bucket in order, group after group (key and block)."""

    def __init__(self, table: pa.Table):
        keys, blocks = np.asarray(table.column("key")), np.asarray(table.column("block"))
        nodes = np.asarray(table.column("node"))
        order = np.lexsort((nodes, blocks, keys))
        self.order, self.keys, self.nodes, blocks = order, keys[order], nodes[order], blocks[order]
        self.labels = np.asarray(table.column("label"))[order]
        self.sides = np.asarray(table.column("side"))[order]
        self.sizes = np.asarray(table.column("n_shingles"))[order]
        self.key_hashes = np.asarray(table.column("key_hash")).astype(np.int64)[order]
        lists = table.column("posted").combine_chunks()
        lengths = np.asarray(lists.value_lengths())
        owners = np.repeat(np.arange(len(lists)), lengths)
        places = np.arange(len(owners)) - np.repeat(np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py(), lengths)
        posted = np.full((len(lists), int(places.max()) + 1), _NOTHING, dtype=np.int64)
        posted[owners, places] = np.asarray(lists.flatten())
        self.posted = posted[order]
        short = table.column("short").to_pylist()
        self.values = np.frombuffer(b"".join(short[i] for i in order), dtype=np.uint8).reshape(len(order), -1)
        self.opens = np.flatnonzero(
            np.concatenate([[True], (self.keys[1:] != self.keys[:-1]) | (blocks[1:] != blocks[:-1])])
        )
        self.counts = np.diff(np.append(self.opens, len(order)))


_FOUND = "x bigint, y bigint, open bigint"


def _best_partners(least_percent: int):
    """Candidate pairs of a bucket of groups: each node's best partners in other components.

    A row with an ``open`` key in place of a pair says that the key has more candidates.
    """

    def pairs(table: pa.Table) -> pa.Table:
        b = _Bucket(table)
        # Most groups are of two: all at once.
        twos = b.opens[b.counts == 2]
        small = np.minimum(b.sizes[twos], b.sizes[twos + 1])
        near = (b.labels[twos] != b.labels[twos + 1]) & (
            100 * small >= least_percent * np.maximum(b.sizes[twos], b.sizes[twos + 1])
        )
        near &= _across(b.sides[twos], b.sides[twos + 1])
        near &= _collisions(b.values[twos], b.values[twos + 1]) >= matches_for(least_percent)
        twos = twos[near]
        twos = twos[_first_meeting(b.posted[twos], b.posted[twos + 1], b.key_hashes[twos])]
        left, right, open_keys = [b.nodes[twos]], [b.nodes[twos + 1]], []
        for first, count in zip(b.opens[b.counts > 2].tolist(), b.counts[b.counts > 2].tolist()):
            group = slice(first, first + count)
            i, j, more = _partners_in_group(
                b.values[group], b.sizes[group], b.labels[group], b.sides[group], b.posted[group],
                int(b.key_hashes[first]), least_percent,
            )
            left.append(b.nodes[first + i])
            right.append(b.nodes[first + j])
            if more:
                open_keys.append(int(b.keys[first]))
        one, other = np.concatenate(left), np.concatenate(right)
        found = pd.DataFrame({"x": np.minimum(one, other), "y": np.maximum(one, other)}).drop_duplicates()
        marks = pa.nulls(len(open_keys), pa.int64())
        return pa.table(
            {
                "x": pa.concat_arrays([pa.array(found["x"].to_numpy(), pa.int64()), marks]),
                "y": pa.concat_arrays([pa.array(found["y"].to_numpy(), pa.int64()), marks]),
                "open": pa.concat_arrays([pa.nulls(len(found), pa.int64()), pa.array(open_keys, pa.int64())]),
            }
        )

    return pairs


def _reaches(a: np.ndarray, b: np.ndarray, least_percent: int) -> bool:
    """Whether two sets of sorted hashes are as similar as is wanted."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= least_percent * (len(a) + len(b) - common)


class _Sets:
    """Sets of a group, one of which can be compared with all others at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.total = int(self.sizes.sum())
        self.numbers: np.ndarray | None = None

    def reached(self, one: int, others: np.ndarray, least_percent: int) -> Iterator[int]:
        """Those of ``others`` that are similar to ``one``, when asked for."""
        if len(others) * self.sizes[one] < self.total // 8:
            yield from (int(k) for k in others if _reaches(self.sets[one], self.sets[k], least_percent))
            return
        if self.numbers is None:
            self.numbers = np.unique(np.concatenate(self.sets), return_inverse=True)[1].astype(np.int32)
            self.starts = np.cumsum(self.sizes) - self.sizes
            self.has = np.zeros(int(self.numbers.max()) + 1, dtype=bool)
        own = self.numbers[self.starts[one] : self.starts[one] + self.sizes[one]]
        self.has[own] = True
        common = np.add.reduceat(self.has[self.numbers], self.starts, dtype=np.int64)[others]
        self.has[own] = False
        together = self.sizes[one] + self.sizes[others] - common
        yield from others[100 * common >= least_percent * together].tolist()


def _forest_of_links(least_percent: int):
    """Links of a bucket of groups that connect what was not connected, as a spanning forest of each group."""

    def links(table: pa.Table) -> pa.Table:
        b = _Bucket(table)
        members = table.column("members").to_pylist()
        sets = [np.frombuffer(members[i], dtype=np.uint64) for i in b.order.tolist()]
        found: list[tuple[int, int]] = []
        for first, count in zip(b.opens.tolist(), b.counts.tolist()):
            group, own = slice(first, first + count), _Sets(sets[first : first + count])
            labels = np.unique(b.labels[group], return_inverse=True)[1]
            parent = np.arange(labels.max() + 1)  # of components known before or found here
            for at in range(0, count, 64):
                alike = _candidates(b.values[group], b.sizes[group], parent[labels], b.sides[group], at, least_percent)
                i, j = np.nonzero(np.triu(alike, at + 1))
                here = _first_meeting(b.posted[first + at + i], b.posted[first + j], int(b.key_hashes[first]))
                i, j = i[here], j[here]
                for row in np.unique(i).tolist():
                    one, others = at + row, j[i == row]
                    # The likeliest first: what they connect need not be looked at again.
                    others = others[np.argsort(-alike[row, others], kind="stable")]
                    others = others[parent[labels[others]] != parent[labels[one]]]
                    for other in own.reached(one, others, least_percent):
                        low, high = parent[labels[one]], parent[labels[other]]
                        if low != high:
                            parent[parent == high] = low
                            found.append((int(b.nodes[first + one]), int(b.nodes[first + other])))
        u, v = zip(*found) if found else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return links


def _confirm(least_percent: int):
    """Which pairs reach the similarity on their full sets."""

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for a, b in zip(batch["set_x"], batch["set_y"]):
                a, b = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
                kept.append(_reaches(a, b, least_percent))
            yield batch.loc[:, ["x", "y"]].assign(linked=np.array(kept, dtype=bool))

    return confirm


def _candidate_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node`` and ``members`` (sorted hashes) of the nodes of ``wanted`` (node, doc_id)."""
    rows = likely_members(docs.select("doc_id", "text"), "doc_id", wanted, "doc_id").join(
        wanted.select(F.col("doc_id").alias("wanted_id"), F.col("node").alias("wanted_node")),
        F.col("doc_id").eqNullSafe(F.col("wanted_id")),
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                hashes, starts = shingle_sets(part.column(1), width)
                nodes = set_ids(hashes, starts).view(np.int64)
                right = np.flatnonzero(nodes == np.asarray(part.column(0)))
                packed = [hashes[starts[i] : starts[i + 1]].tobytes() for i in right]
                yield pa.record_batch(
                    [pa.array(nodes[right]), pa.array(packed, pa.binary())], names=["node", "members"]
                )

    found = rows.select("wanted_node", "text").mapInArrow(sets, "node bigint, members binary")
    return found.dropDuplicates(["node"])


def link_nodes(
    docs: DataFrame, signed: DataFrame, width: int, least_percent: int
) -> DataFrame | None:
    """``node`` and ``label`` of the nodes that are linked with others; None if none are.

    ``signed`` is a written table of ``document_signatures``.
    """
    nodes = staged(
        signed.where("node <> 0")
        .groupBy("node")
        .agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("s"))
        .select("node", "s.*"),
        "nodes",
    )
    posted = staged(prefix_postings(nodes, matches_for(least_percent)), "postings")
    wanted = posted.select("node").distinct()
    short = F.transform("signature", lambda v: F.lpad(F.hex(v.bitwiseAND(F.lit(255))), 2, "0"))
    known = nodes.join(wanted, "node").select(
        "node", "doc_id", "n_shingles", F.unhex(F.array_join(short, "")).alias("short")
    )
    known = staged(known, "known")
    postings = posted.join(known.select("node", "n_shingles", "short"), "node")
    buckets = max(1, posted.count() // BUCKET_POSTINGS)
    columns = ["key", F.hash("key").alias("key_hash"), "block", "side", "node", "label", "n_shingles", "short", "posted"]
    found = (
        _blocks(postings, None)
        .select(F.pmod(F.xxhash64("key", "block"), F.lit(buckets)).alias("bucket"), *columns)
        .groupBy("bucket")
        .applyInArrow(_best_partners(least_percent), _FOUND)
    )
    found = staged(found.distinct(), "pairs")
    pairs = found.where("open is null").select("x", "y")
    # Blocks of a value with many nodes have not met each other yet.
    split = posted.groupBy("key").count().where(F.col("count") > BLOCK_NODES).select("key")
    open_keys = staged(found.where("open is not null").select(F.col("open").alias("key")).union(split).distinct(), "open")
    if pairs.isEmpty() and open_keys.isEmpty():
        return None
    sets = staged(_candidate_sets(docs, known.select("node", "doc_id"), width), "sets")
    both = pairs.join(sets.select(F.col("node").alias("x"), F.col("members").alias("set_x")), "x").join(
        sets.select(F.col("node").alias("y"), F.col("members").alias("set_y")), "y"
    )
    judged = both.select("x", "y", "set_x", "set_y").mapInPandas(
        _confirm(least_percent), "x bigint, y bigint, linked boolean"
    )
    links = judged.where("linked").select(F.col("x").alias("u"), F.col("y").alias("v"))
    labels = staged(components(links).select("node", "label"), "labels")
    if not open_keys.isEmpty():
        meeting = posted.join(open_keys, "key", "left_semi").join(known.select("node", "n_shingles"), "node")
        again = staged(_meeting_again(meeting, labels), "dealt")
        weight = again.agg(F.sum("weight")).first()[0] or 0
        bucket = F.pmod(F.xxhash64("key", "block"), F.lit(max(1, weight // BUCKET_WEIGHT)))
        more = (
            again.join(known.select("node", "short"), "node")
            .join(posted.select("node", "posted").dropDuplicates(["node"]), "node")
            .join(sets, "node")
            .select(bucket.alias("bucket"), *columns, "members")
            .groupBy("bucket")
            .applyInArrow(_forest_of_links(least_percent), "u bigint, v bigint")
        )
        # What is known of a component is one edge for each node.
        edges = labels.where("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v"))
        labels = staged(components(edges.unionByName(more)).select("node", "label"), "labels")
    return labels


def _meeting_again(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Where nodes meet with their sets: a few numbers for each meeting."""
    heavy = (1 + F.floor(F.col("n_shingles") / NODE_SHINGLES)).cast("bigint")
    kept = postings.select("key", "node", "n_shingles", heavy.alias("weight"))
    return _blocks(kept, labels).select("key", "block", "side", "node", "label", "n_shingles", "weight")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    least_percent: int = 85,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``.

    Documents are linked whose sets satisfy 100 * common >= ``least_percent`` * together.
    """
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    signed = staged(document_signatures(docs, width), "signed")
    labels = link_nodes(docs, signed, width, least_percent)
    rows = signed.select("doc_id", "n_shingles", "node")
    if labels is None:
        rows = rows.withColumn("label", F.col("node"))
    else:
        rows = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = rows.where("label <> 0").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    found = rows.join(smallest, "label", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("smallest"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )
