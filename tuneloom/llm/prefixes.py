"""The trie of the beginnings that conversations share."""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .tables import map_arrow, stored

#: The most turns that a conversation takes over from another one, and how many
#: conversations in a row take theirs from the same.
HEAD = 8
FAMILY = 5
#: Rows of a shard, and turns of one conversation that stay together in a shard.
SHARD_ROWS = 200_000
SEGMENT = 50_000
#: Bytes of numbers that are hashed in one piece.
CHUNK_BYTES = 1 << 20
#: Slots for each key in a level of the hash.
ROOM = 2
ROOT = bytes(16)


class NodeTable:
    """A minimal perfect hash of distinct 16-byte keys: each has a slot of its own
    between 0 and their number.

    Level by level the keys are hashed into twice as many places as there are
    keys. Those alone in their place stay, the others go on to the next level;
    a slot is the rank of a taken place. The key of every slot is kept and
    compared, so that a key that is not in the table never gets another's slot.
    """

    def __init__(self, keys: np.ndarray):
        """``keys``: two unsigned 64-bit numbers for each key."""
        self.levels: list[np.ndarray] = []
        self.first = [0]
        self.keys = np.empty_like(keys)
        left = keys
        while len(left):
            place = self._place(left, len(self.levels), ROOM * len(left))
            alone = np.bincount(place, minlength=ROOM * len(left)) == 1
            rank = np.cumsum(alone)
            stays = alone[place]
            self.keys[self.first[-1] + rank[place[stays]] - 1] = left[stays]
            self.levels.append(np.where(alone, rank, 0))
            self.first.append(self.first[-1] + int(rank[-1]))
            left = left[~stays]
            if len(self.levels) > 100:
                raise ValueError("keys are repeated")

    @staticmethod
    def _place(keys: np.ndarray, level: int, places: int) -> np.ndarray:
        mixed = keys[:, 0] + keys[:, 1] * np.uint64(2 * level + 1) + np.uint64(level)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed >> np.uint64(16)) % np.uint64(places)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for those that are not in the table."""
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, ranks in enumerate(self.levels):
            rank = ranks[self._place(keys[open_], level, len(ranks))]
            at = self.first[level] + rank - 1
            own = (rank > 0) & (self.keys[at] == keys[open_]).all(axis=1)
            found[open_[own]] = at[own]
            open_ = open_[~own]
        return found


def pairs_of(column) -> np.ndarray:
    """16-byte keys as two numbers each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def raw(keys: np.ndarray) -> pa.Array:
    data = pa.py_buffer(np.ascontiguousarray(keys))
    return pa.Array.from_buffers(pa.binary(16), len(keys), [None, data]).cast(pa.binary())


def rebuilt(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, place, said, n_bytes: the turns of the rebuilt conversations, and for
    every conversation a row with place 0 and nothing else.

    Conversation c starts with the first h turns of conversation c - c % 5, all
    if there are fewer, h being crc32(c) % 9; its own turns after its first h
    follow. said is a digest of role and text (null: empty), n_bytes the text's
    length in UTF-8. Turns go by their number, null first, and by said if that is
    equal; repeated rows are turns of their own. Rows without a conversation are
    left out. Texts are not shuffled, only their digests.
    """
    who, what = F.coalesce(turns[role], F.lit("")), F.coalesce(turns[text], F.lit(""))
    said = F.unhex(F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what)))
    rows = turns.select(
        turns[key].cast("bigint").alias("conv"),
        turns[turn].alias("turn"),
        said.alias("said"),
        F.octet_length(what).cast("bigint").alias("n_bytes"),
    ).where("conv IS NOT NULL")
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "said")
    rows = stored(rows.withColumn("place", F.row_number().over(order).cast("bigint")).drop("turn"), "turns")

    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)
    every = rows.select("conv").distinct().withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    heads = rows.where((F.col("conv") % FAMILY == 0) & (F.col("place") <= HEAD))
    lent = heads.groupBy("conv").agg(F.count("*").alias("n")).withColumnRenamed("conv", "base")
    every = stored(every.join(lent, "base", "left").withColumn("taken", F.least("h", F.coalesce("n", F.lit(0)))), "conversations")
    taken = every.select("conv", "base", "taken").join(heads.withColumnRenamed("conv", "base"), "base")
    taken = taken.where(F.col("place") <= F.col("taken")).select("conv", "place", "said", "n_bytes")
    own = rows.join(every.select("conv", "h", "taken"), "conv").where(F.col("place") > F.col("h"))
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "said", "n_bytes")
    zero = F.lit(0).cast("bigint")
    start = every.select("conv", zero.alias("place"), F.unhex(F.lit("")).alias("said"), zero.alias("n_bytes"))
    return start.union(taken).union(own)


def beginnings(said: DataFrame) -> DataFrame:
    """conv, depth, node, parent, n_bytes, ends: a row for each beginning of each
    conversation. node is a digest of all turns so far, sixteen zeros for none;
    ends is 1 for the whole conversation. ``said`` is as ``rebuilt`` returns it.
    A conversation's turns are read one after the other; of a long one no more
    than a batch is held at a time."""
    schema = "conv bigint, depth bigint, node binary, parent binary, n_bytes bigint, ends bigint"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, names = ROOT, ["conv", "depth", "node", "parent", "n_bytes", "ends"]
        for batch in batches:
            nodes, parents = [], []
            for place, words in zip(batch.column("place").to_pylist(), batch.column("said").to_pylist()):
                parents.append(node if place else None)
                node = hashlib.blake2b(node + words, digest_size=16).digest() if place else ROOT
                nodes.append(node)
            columns = [batch.column("conv"), batch.column("place"), pa.array(nodes, pa.binary())]
            columns += [pa.array(parents, pa.binary()), batch.column("n_bytes"), batch.column("ends")]
            yield pa.RecordBatch.from_arrays(columns, names)

    after = F.lead("place").over(Window.partitionBy("conv").orderBy("place"))
    ordered = said.withColumn("ends", after.isNull().cast("bigint")).sortWithinPartitions("conv", "place")
    return map_arrow(ordered.select("conv", "place", "said", "n_bytes", "ends"), digest, schema)


def sharded(rows: DataFrame, shards: int, segment: int) -> DataFrame:
    """The rows with a shard: that of the conversation, or of a part of a long one."""
    part = F.floor(F.col("depth") / segment)
    return rows.withColumn("shard", F.pmod(F.xxhash64("conv", part), F.lit(shards)).cast("int"))


def node_table(rows: pa.Table) -> tuple[NodeTable, np.ndarray, np.ndarray]:
    """The table of the nodes that a shard's rows have, the slot of every row,
    and one row of every slot."""
    keys = pairs_of(rows.column("node"))
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.concatenate([[True], (keys[order[1:]] != keys[order[:-1]]).any(axis=1)])
    table = NodeTable(keys[order[new]])
    slot = table.slots(keys)
    one = np.empty(len(table.keys), np.int64)
    one[slot] = np.arange(len(keys))
    return table, slot, one


def numbers(rows: pa.Table, column: str) -> np.ndarray:
    return rows.column(column).to_numpy()


def nodes(rows: DataFrame, shards: int, segment: int = SEGMENT) -> DataFrame:
    """node, parent, depth, n_bytes, conv (smallest member), n_convs, n_ends and
    n_children of every node. The beginnings of a shard are counted in flat
    arrays, one number for each slot of its table; the shards' counts are added
    up by node, so the root has as many rows in the shuffle as there are shards.
    """
    schema = "node binary, parent binary, depth bigint, n_bytes bigint, conv bigint, n_convs bigint, n_ends bigint"

    def count(rows: pa.Table) -> pa.Table:
        table, slot, one = node_table(rows)
        n_convs, n_ends = np.bincount(slot), np.zeros(len(one), np.int64)
        np.add.at(n_ends, slot, numbers(rows, "ends"))
        least = numbers(rows, "conv")[one]
        np.minimum.at(least, slot, numbers(rows, "conv"))
        of_one = rows.take(pa.array(one))
        columns = [raw(table.keys), of_one.column("parent"), of_one.column("depth"), of_one.column("n_bytes")]
        columns += [pa.array(least), pa.array(n_convs), pa.array(n_ends)]
        return pa.table(columns, [c.split()[0] for c in schema.split(", ")])

    counted = sharded(rows, shards, segment).groupBy("shard").applyInArrow(count, schema)
    same = [F.first(c, ignorenulls=True).alias(c) for c in ("parent", "depth", "n_bytes")]
    added = [F.sum(c).alias(c) for c in ("n_convs", "n_ends")]
    found = stored(counted.groupBy("node").agg(*same, F.min("conv").alias("conv"), *added), "nodes")
    children = found.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    joined = found.join(children.withColumnRenamed("parent", "node"), "node", "left")
    return joined.withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def subtree_sums(rows: DataFrame, found: DataFrame, shards: int, segment: int = SEGMENT) -> DataFrame:
    """node, n_leaves, saved: sums over each node's subtree.

    Every node belongs to its smallest member, whose beginnings are its
    ancestors. A shard takes the beginnings of some conversations that own
    nodes, scatters what the nodes are worth into flat arrays and adds every
    slot to its parent's, the deepest first. The shards' sums are added up by
    node. What the later parts of a long conversation are worth is added to the
    last beginning before them, so that a shard needs no other part.
    """
    worth = found.select(
        "conv",
        "depth",
        (F.col("n_children") == 0).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
    )
    owners = rows.join(worth.select("conv"), "conv", "left_semi").select("conv", "depth", "node", "parent")
    zero = F.lit(0).cast("bigint")
    path = owners.join(worth, ["conv", "depth"], "left").select(
        "conv", "depth", "node", "parent", *[F.coalesce(c, zero).alias(c) for c in ("leaf", "saved")]
    )
    path = stored(path, "path")
    long = path.where(F.col("depth") >= segment)
    if not long.isEmpty():
        part = F.floor(F.col("depth") / segment).alias("part")
        totals = long.groupBy("conv", part).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        onwards = Window.partitionBy("conv").orderBy(F.desc("part"))
        later = totals.select(
            "conv",
            (F.col("part") * segment - 1).alias("depth"),
            F.sum("leaf").over(onwards).alias("later_leaf"),
            F.sum("saved").over(onwards).alias("later_saved"),
        )
        more = [(F.col(c) + F.coalesce(f"later_{c}", zero)).alias(c) for c in ("leaf", "saved")]
        path = path.join(later, ["conv", "depth"], "left").select("conv", "depth", "node", "parent", *more)

    def add_up(rows: pa.Table) -> pa.Table:
        table, slot, one = node_table(rows)
        depth = numbers(rows, "depth")[one]
        parent = np.full(len(one), -1)
        inner = np.flatnonzero(depth % segment != 0)  # the others' parents are in another part
        parent[inner] = table.slots(pairs_of(rows.column("parent").take(pa.array(one[inner]))))
        if (parent[inner] < 0).any():
            raise ValueError("a node without its parent")
        sums = {c: np.zeros(len(one), np.int64) for c in ("leaf", "saved")}
        for c in sums:
            np.add.at(sums[c], slot, numbers(rows, c))
        order = inner[np.argsort(-depth[inner], kind="stable")]
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            for c in sums:
                np.add.at(sums[c], parent[level], sums[c][level])
        return pa.table([raw(table.keys), *map(pa.array, sums.values())], ["node", "n_leaves", "saved"])

    schema = "node binary, n_leaves bigint, saved bigint"
    added = sharded(path, shards, segment).groupBy("shard").applyInArrow(add_up, schema)
    return added.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def ends_digests(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """node, ends_sha256: SHA-256 of the conversations that end at a node, in
    numerical order with commas between. They are sorted by ranges of node and
    number, so those of one node may be in many tasks; each makes pieces of
    bounded size, which are then hashed one after the other."""
    schema = "node binary, first bigint, text binary"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, text, size, ready = None, None, [], 0, []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*ready), (pa.binary(), pa.int64(), pa.binary()))]
            ready.clear()
            return pa.RecordBatch.from_arrays(columns, ["node", "first", "text"])

        for rows in batches:
            for key, conv in zip(rows.column("node").to_pylist(), rows.column("conv").to_pylist()):
                if text and (key != node or size > chunk_bytes):
                    ready.append((node, first, b",".join(text)))
                    if size > chunk_bytes or len(ready) > 5000:
                        yield batch()
                    text, size = [], 0
                if not text:
                    node, first = key, conv
                text.append(b"%d" % conv)
                size += len(text[-1]) + 1
        if text:
            ready.append((node, first, b",".join(text)))
            yield batch()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, so_far = None, None
        for rows in batches:
            done = []
            for key, text in zip(rows.column("node").to_pylist(), rows.column("text").to_pylist()):
                if key == node:
                    so_far.update(b",")
                else:
                    if node is not None:
                        done.append((node, so_far.hexdigest()))
                    node, so_far = key, hashlib.sha256()
                so_far.update(text)
            yield ended(done)
        if node is not None:
            yield ended([(node, so_far.hexdigest())])

    def ended(done: list) -> pa.RecordBatch:
        columns = [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["node", "ends_sha256"])

    last = rows.where("ends = 1").select("node", "conv")
    in_order = last.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    pieces = map_arrow(in_order, chunks, schema)
    together = pieces.repartition("node").sortWithinPartitions("node", "first")
    return map_arrow(together.select("node", "text"), digest, "node binary, ends_sha256 string")


def trie(
    turns: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    shard_rows: int = SHARD_ROWS,
    segment: int = SEGMENT,
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256: a row for every different beginning of the rebuilt
    conversations, the empty one included (see ``rebuilt`` for nulls, ties and
    repeated rows).

    conv_id is the smallest conversation that begins so, n_convs how many do,
    n_leaves how many nodes of its subtree have no child, saved_tokens the sum of
    (n_convs - 1) times the bytes of the last text over its subtree, ends_sha256
    stands for the conversations that end there. A conversation of no turns is
    one of the root's. An empty table has no node. Beginnings are told apart by
    128-bit digests; other columns are not read.
    """
    rows = stored(beginnings(rebuilt(turns, key, turn, role, text)), "beginnings")
    shards = max(1, -(-rows.count() // shard_rows))
    found = stored(nodes(rows, shards, segment), "trie")
    above = found.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    named = found.join(above, "parent", "left").join(subtree_sums(rows, found, shards, segment), "node")
    named = named.join(ends_digests(rows), "node", "left")
    return named.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
