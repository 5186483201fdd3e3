"""A Merkle manifest of a table, with a witness for every row.

Rows are leaves. Leaves of one group stand in the order of their key; every eight consecutive nodes
(the last ones may be fewer, even one) become their hash, until one is left, the group's subroot.
Subroots, ordered by group, become the root in the same way. H is lower-case hex SHA-256 of its inputs
one after another, digests being hex text.

Witnesses are built while leaves are appended. ``OpenSubtrees`` keeps, of each height, the nodes
whose run is not full; each node knows its leaves, and each leaf has the part of its witness that is known so
far. When a run completes, the leaves below each of its nodes get the other nodes as siblings, and the run's
hash is appended one height up. Leaves are cut into aligned blocks of 8**4 (``HEIGHT``), which tasks append
independently; a block's root is one more append to a tree of block roots, in blocks again, and so on
until one node is left, so no task ever gets more than one block. On the way down every block
extends the witnesses of its nodes by that of its root.

Positions come from one sort by ranges: rows are numbered inside their range, and a small table of
ranges and groups says how many came before. One group, or one repeated row, may hold most of the table.

A null group is a group of its own and comes first; null keys come first in their group; equal keys stand in the order of
their leaves, so repeated rows make a defined root. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlane.shared import settle

FAN = 8
# Height of the aligned blocks that one task appends: 4,096 nodes.
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "grp string, ordinal long, n long, node string"
PATHS = "grp string, ordinal long, places array<int>, siblings array<string>, subroot string, root string"
FOLDED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


class OpenSubtrees:
    """A tree that grows by appended nodes, and the witness of each as far as it is known."""

    def __init__(self) -> None:
        self.waiting: list[list[tuple[bytes, int, int]]] = []
        self.witnesses: list[list[tuple[int, bytes]]] = []

    def append(self, node: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._wait(0, (node, at, at + 1))

    def _wait(self, height: int, node: tuple[bytes, int, int]) -> None:
        if height == len(self.waiting):
            self.waiting.append([])
        self.waiting[height].append(node)
        if len(self.waiting[height]) == FAN:
            self._complete(height)

    def _complete(self, height: int) -> None:
        run, self.waiting[height] = self.waiting[height], []
        for place, (_, first, end) in enumerate(run):
            others = b"".join([node for at, (node, _, _) in enumerate(run) if at != place])
            for leaf in range(first, end):
                self.witnesses[leaf].append((place, others))
        self._wait(height + 1, (digest(b"".join([node for node, _, _ in run])), run[0][1], run[-1][2]))

    def close(self, height: int) -> bytes:
        """Complete what is open below ``height`` and return the node there."""
        for low in range(height):
            if low < len(self.waiting) and self.waiting[low]:
                self._complete(low)
        return self.waiting[height][0][0]


def height_of(n: int) -> int:
    """Heights until one node is left of ``n``."""
    height = 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


def grown(nodes: pa.Table, height: int) -> tuple[OpenSubtrees, bytes]:
    """A block's subtrees after all its nodes (sorted by ordinal) were appended, and its root."""
    subtrees = OpenSubtrees()
    for node in nodes["node"].to_pylist():
        subtrees.append(node.encode())
    n = nodes["n"][0].as_py()
    return subtrees, subtrees.close(min(height, height_of(n)))


def folded(node: bytes, witness: Sequence[tuple[int, bytes]]) -> bytes:
    """The root that a node and its witness lead to."""
    for place, others in witness:
        at = 64 * place
        node = digest(others[:at] + node + others[at:])
    return node


def measured(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    whole = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(whole, F.lit("-"))


def leaf_of(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[measured(column) for column in columns]), 256)


def leaves(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    key: str = "doc_id",
    held: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(grp, doc_id, node, found, row); ``found`` is the leaf of what is ``held`` now in place of fields."""
    held = held or {}
    name = F.col(group).cast("string")
    return docs.select(
        F.coalesce(F.concat(F.lit("1"), name), F.lit("0")).alias("grp"),
        F.col(key).cast("long").alias("doc_id"),
        leaf_of([F.col(field) for field in fields]).alias("node"),
        leaf_of([held.get(field, F.col(field)) for field in fields]).alias("found"),
        F.monotonically_increasing_id().alias("row"),
    )


def in_order(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Settled ``rows`` with ``ordinal``, from 0 inside their ``grp`` by ``order``, and ``n``, the group's size."""
    keys = ["grp", *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Of a sorted range: its number above, the row's number in it in the 33 bits below.
    ranged = ranged.withColumn("place", F.monotonically_increasing_id())
    ranged = settle(ranged.withColumn("part", F.shiftright("place", 33)), "ordered")
    counts = ranged.groupBy("grp", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    counts = settle(counts, "ranges")
    before = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "grp",
        "part",
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(W.partitionBy("grp")).alias("n"),
    )
    placed = ranged.join(settle(starts, "range-starts"), ["grp", "part"])
    return placed.withColumn("ordinal", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def _blocked(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"ordinal div {FAN**height}"))


def block_roots(nodes: DataFrame, height: int) -> DataFrame:
    """The nodes that blocks of ``nodes`` (grp, ordinal, n, node) become."""

    size = FAN**height

    def close(block: pa.Table) -> pa.Table:
        block = block.sort_by("ordinal")
        _, root = grown(block, height)
        ordinal, n = block["ordinal"][0].as_py(), block["n"][0].as_py()
        return pa.table(
            {
                "grp": [block["grp"][0].as_py()],
                "ordinal": pa.array([ordinal // size], pa.int64()),
                "n": pa.array([-(-n // size)], pa.int64()),
                "node": [root.decode()],
            }
        )

    narrow = _blocked(nodes.select("grp", "ordinal", "n", "node"), height)
    return narrow.groupBy("grp", "block").applyInArrow(close, NODES)


def climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """``nodes``, their block roots, and so on up to one node in every group."""
    levels = [nodes]
    while True:
        levels.append(settle(block_roots(levels[-1], height), "block-roots"))
        if (levels[-1].agg(F.max("n")).first()[0] or 0) <= 1:
            return levels


def extended_paths(nodes: DataFrame, upper: DataFrame, height: int) -> DataFrame:
    """Witnesses of ``nodes``, given those of their blocks' roots (``PATHS``)."""

    def extend(block: pa.Table, above: pa.Table) -> pa.Table:
        block, above = block.sort_by("ordinal"), above.to_pylist()[0]
        witnesses = grown(block, height)[0].witnesses
        n = len(block)
        return pa.table(
            {
                "grp": block["grp"],
                "ordinal": block["ordinal"],
                "places": pa.array(
                    [[place for place, _ in own] + above["places"] for own in witnesses], pa.list_(pa.int32())
                ),
                "siblings": [[others.decode() for _, others in own] + above["siblings"] for own in witnesses],
                "subroot": [above["subroot"]] * n,
                "root": [above["root"]] * n,
            },
        ).cast(_PATHS)

    return _with_upper(nodes.select("grp", "ordinal", "n", "node"), upper, height).applyInArrow(extend, PATHS)


_PATHS = pa.schema(
    [
        ("grp", pa.string()),
        ("ordinal", pa.int64()),
        ("places", pa.list_(pa.int32())),
        ("siblings", pa.list_(pa.string())),
        ("subroot", pa.string()),
        ("root", pa.string()),
    ]
)


def _with_upper(nodes: DataFrame, upper: DataFrame, height: int):
    above = upper.withColumnRenamed("ordinal", "block")
    return _blocked(nodes, height).groupBy("grp", "block").cogroup(above.groupBy("grp", "block"))


def folded_leaves(nodes: DataFrame, upper: DataFrame, height: int) -> DataFrame:
    """The last step for leaves: their whole witnesses hashed, and folded with the leaf that was found."""

    def fold(block: pa.Table, above: pa.Table) -> pa.Table:
        block, above = block.sort_by("ordinal"), above.to_pylist()[0]
        rest = [(place, others.encode()) for place, others in zip(above["places"], above["siblings"])]
        beyond = b"".join([others for _, others in rest])
        proofs, roots = [], []
        for own, found in zip(grown(block, height)[0].witnesses, block["found"].to_pylist()):
            proofs.append(hashlib.sha256(b"".join([others for _, others in own]) + beyond).hexdigest())
            roots.append(folded(folded(found.encode(), own), rest).decode())
        return pa.table(
            {
                "doc_id": block["doc_id"],
                "leaf": block["node"],
                "subroot": [above["subroot"]] * len(block),
                "root": [above["root"]] * len(block),
                "proof_sha256": proofs,
                "folded_root": roots,
            }
        )

    carried = nodes.select("grp", "ordinal", "n", "node", "doc_id", "found")
    return _with_upper(carried, upper, height).applyInArrow(fold, FOLDED)


def group_paths(subroots: DataFrame, height: int) -> DataFrame:
    """Witnesses of the groups' subroots (grp, node) in the tree above them, as ``PATHS`` with ordinal 0."""
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
    nodes = settle(in_order(settle(named, "subroots"), ["name"]), "subroots")
    levels = climb(nodes, height)
    none = F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("siblings")
    upper = levels[-1].select("grp", "ordinal", *none, F.col("node").alias("subroot"), F.col("node").alias("root"))
    for level in levels[-2::-1]:
        upper = settle(extended_paths(level, upper, height), "paths")
    paths = upper.drop("subroot", "grp")
    return settle(
        nodes.select("ordinal", "name", F.col("node").alias("subroot"))
        .join(paths, "ordinal")
        .select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("ordinal"), "places", "siblings", "subroot", "root"),
        "paths",
    )


def _built(docs: DataFrame, height: int, **options) -> tuple[DataFrame, DataFrame]:
    """The leaves in order, and the witnesses of their blocks' roots."""
    rows = settle(leaves(docs, **options), "leaves")
    levels = climb(in_order(rows, ["doc_id", "node", "row"]), height)
    upper = group_paths(levels[-1], height)
    for level in levels[-2:0:-1]:
        upper = settle(extended_paths(level, upper, height), "paths")
    return levels[0], upper


def witnesses(docs: DataFrame, height: int = HEIGHT, **options) -> DataFrame:
    """Per row its leaf, subroot, root and whole witness: at every height the place among its run, and the
    other nodes of the run one after another.
    """
    nodes, upper = _built(docs, height, **options)
    paths = extended_paths(nodes, upper, height)
    own = nodes.select("grp", "ordinal", "doc_id", F.col("node").alias("leaf"))
    return own.join(paths, ["grp", "ordinal"]).drop("grp", "ordinal")


def verified_manifest(docs: DataFrame, height: int = HEIGHT, **options) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, digest of its witness, the root that what is ``held`` now folds to,
    and whether that is the root.
    """
    found = folded_leaves(*_built(docs, height, **options), height)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
