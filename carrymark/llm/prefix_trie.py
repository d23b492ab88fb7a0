"""Operator 12: the prefix trie of conversations, built as a burst trie.

1. Conversations become sequences of turn digests; equal sequences become one row with
   their number, so a group of copies of any size is one suffix in the trie.
2. All sequences start in the root's container. A container that holds more than
   ``max_container`` sequences is burst: its longest common prefix becomes trie heads at
   once, sequences that end there leave it, and the others are dealt to containers by
   the id of their next turn. This is repeated until no container is oversized; each
   round handles all oversized containers together.
3. Containers are shards: their rows meet in one task, sorted. One sweep over the sorted
   suffixes keeps the path of open nodes and emits each node when its parent closes.
4. Heads get their leaves and their subtree's savings as sums over the containers and
   heads below them.

A sequence is one row of a digest and a length for each turn. Nothing is collected to
the driver; a burst container is counted, not listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrymark.llm.common import join_groups, stored

NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Conversations share what their group's first one opens with.
GROUP, DEPTHS = 5, 9
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
        "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")
PIECE = 1 << 16


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id with ``ids`` and ``sizes`` of its turns in order.

    A turn's id is a digest of role and text, its size the bytes of its text; a null
    role or text is empty. Turns are ordered by turn (null first), ties by role and
    id. Turns without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter("conv_id is not null").select(
        "conv_id", F.struct("turn", role.alias("role"), F.md5(name.cast("binary")).alias("id"),
                            F.octet_length(text).cast("long").alias("size")).alias("at"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("at")).alias("t")).select(
        "conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Each conversation with the opening of the first one of its group of five.

    The first h turns come from that one (all if it has fewer, none if it is absent),
    the rest are the conversation's own after its first h; h is crc32(conv_id) % 9.
    ``convs`` is read twice.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(DEPTHS)).cast("int")
    opening = convs.select(F.col("conv_id").alias("base"), *(
        F.slice(c, 1, DEPTHS - 1).alias(f"base_{c}") for c in ("ids", "sizes")))
    rows = (convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % GROUP})
            .join(opening, "base", "left"))

    def joined(c: str):
        first = F.slice(F.coalesce(f"base_{c}", F.array().cast(rows.schema[c].dataType)),
                        F.lit(1), F.col("h"))
        own = F.slice(c, F.col("h") + 1, F.greatest(F.size(c) - F.col("h"), F.lit(0)))
        return F.concat(first, own).alias(c)

    return rows.select("conv_id", joined("ids"), joined("sizes"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sequence, conv_id) rows as strings of ids, at most about PIECE bytes each."""
    def row():
        return pa.RecordBatch.from_pydict({"sequence": [now], "first": [first],
                                           "text": [",".join(held)]}, schema=schema)

    schema = pa.schema([("sequence", pa.string()), ("first", pa.int64()), ("text", pa.string())])
    now, first, held, size = None, None, [], 0
    for batch in batches:
        for sequence, conv in zip(batch.column("sequence").to_pylist(),
                                  batch.column("conv_id").to_pylist(), strict=True):
            if sequence != now or size > PIECE:
                if held:
                    yield row()
                now, first, held, size = sequence, conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        yield row()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each sequence, which arrive in order."""
    def row():
        return pa.RecordBatch.from_pydict({"sequence": [now], "ends": [digest.hexdigest()]})

    now, digest = None, None
    for batch in batches:
        for sequence, text in zip(batch.column("sequence"), batch.column("text"), strict=True):
            sequence = sequence.as_py()
            if sequence != now:
                if now is not None:
                    yield row()
                now, digest = sequence, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.as_py().encode())
    if now is not None:
        yield row()


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """One row for each sequence: ids, sizes, n, conv_id (the smallest) and ends.

    ``ends`` is the digest of all its conv_ids in order, joined by commas. Ids of many
    copies are ordered by range over all tasks; only long strings of them, no single
    rows, then meet for the digest, which reads them one after another.
    """
    rows = stored(convs.withColumn("sequence", F.md5(F.concat_ws("", "ids").cast("binary"))),
                  "sequences")
    one = stored(rows.groupBy("sequence").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id")), "sequence-sizes")
    several = one.filter("n > 1").select("sequence", "n")
    ids = join_groups(rows.select("sequence", "conv_id"), several, "sequence", "n",
                      rows.count()).select("sequence", "conv_id")
    ordered = ids.repartitionByRange("sequence", "conv_id").sortWithinPartitions(
        "sequence", "conv_id")
    strings = ordered.mapInArrow(_pieces, "sequence string, first bigint, text string")
    ends = stored(strings.repartition("sequence").sortWithinPartitions("sequence", "first")
                  .mapInArrow(_hashes, "sequence string, ends string"), "sequence-ends")
    own = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    return (rows.join(one.select("sequence", "n", "conv_id"), ["sequence", "conv_id"])
            .join(ends, "sequence", "left")
            .select("ids", "sizes", "n", "conv_id", F.coalesce("ends", own).alias("ends")))


def burst(seqs: DataFrame, max_container: int) -> tuple[DataFrame, DataFrame]:
    """Containers of at most ``max_container`` sequences, and the heads above them.

    Rows of the first carry container, depth (turns in its head and its own first one),
    above (the burst containers it lies under, outermost first) and parent (the smallest
    conversation of the head). The second has one row for each burst container.
    """
    rows = seqs.select("*", F.lit("").alias("container"), F.lit(0).alias("depth"),
                       F.array().cast("array<string>").alias("above"),
                       F.lit(None).cast("long").alias("parent"))
    done, heads = [], []
    while True:
        rows = stored(rows, "containers")
        low, high = (f(F.struct("ids", "sizes")) for f in (F.min, F.max))
        total = rows.count()
        groups = stored(rows.groupBy("container").agg(
            F.count("*").alias("rows"), low.alias("low"), high.alias("high"),
            F.sum("n").alias("all"), F.min("conv_id").alias("least"))
            .filter(F.col("rows") > max_container), "oversized")
        if groups.isEmpty():
            return _united(done, rows), _united(heads, None)
        # The common prefix of the first and the last sequence is that of all.
        same = F.array_position(F.transform(
            F.arrays_zip(F.col("low.ids").alias("a"), F.col("high.ids").alias("b")),
            lambda x: x["a"].eqNullSafe(x["b"])), F.lit(False)) - 1
        size = F.least(F.size("low.ids"), F.size("high.ids"))
        groups = groups.withColumn("common", F.when(same >= 0, same).otherwise(size).cast("int"))
        marks = groups.select("container", "rows", "all", "least", "common",
                              F.slice("low.sizes", F.lit(1), F.col("common")).alias("path"))
        big = stored(join_groups(rows, marks, "container", "rows", total), "bursting")
        done.append(rows.join(groups.select("container"), "container", "left_anti")
                    .select(*rows.columns))
        ending = F.size("ids") == F.col("common")
        ends = F.max(F.when(ending, F.col("ends"))).alias("ends")
        heads.append(stored(big.groupBy("container").agg(
            ends, *(F.first(c).alias(c) for c in ("all", "least", "common", "path", "depth",
                                                  "above", "parent"))), "heads"))
        turn = F.element_at("ids", F.col("common") + 1)
        rows = big.filter(~ending).select(
            *seqs.columns, F.md5(F.concat("container", turn).cast("binary")).alias("container"),
            (F.col("common") + 1).alias("depth"),
            F.concat("above", F.array("container")).alias("above"),
            F.col("least").alias("parent"))


def _united(parts: list[DataFrame], last: DataFrame | None) -> DataFrame | None:
    parts = parts + ([last] if last is not None else [])
    whole = parts[0] if parts else None
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


class _Node:
    __slots__ = ("conv", "n", "size", "children", "leaves", "saved", "ends", "closed")

    def __init__(self, conv: int, size: int):
        self.conv, self.size = conv, size
        self.n = self.children = self.leaves = self.saved = 0
        self.ends, self.closed = NO_ENDS, []


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose rows arrive one container after another, sorted by ids.

    A node is emitted when its parent closes, since the parent's smallest conversation is
    known only then. A container's top node also names the container's ``above``.
    """
    schema = pa.schema([(n, pa.int64()) for n in
                        ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                         "n_leaves", "saved_tokens")]
                       + [("ends_sha256", pa.string()), ("above", pa.list_(pa.string()))])
    out: list[tuple] = []
    path: list[_Node] = []
    now, before, top, above, parent = None, [], 0, None, None

    def row(node: _Node, depth: int, parent_conv, heads) -> tuple:
        return (node.conv, depth, parent_conv, node.n, node.children, node.leaves, node.saved,
                node.ends, heads)

    def close() -> None:
        """The deepest open node ends; its children are complete."""
        node, depth = path.pop(), top + len(path)
        node.saved += (node.n - 1) * node.size
        node.leaves = node.leaves or 1
        out.extend(row(child, depth + 1, node.conv, None) for child in node.closed)
        node.closed = []
        if path:
            over = path[-1]
            over.closed.append(node)
            over.conv, over.n = min(over.conv, node.conv), over.n + node.n
            over.children += 1
            over.leaves += node.leaves
            over.saved += node.saved
        else:
            out.append(row(node, depth, parent, above))

    def emitted() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        columns = [batch.column(c) for c in ("container", "depth", "ids", "sizes", "n",
                                             "conv_id", "ends", "above", "parent")]
        for values in zip(*columns, strict=True):
            container, depth, ids, sizes, n, conv, ends, heads, over = (
                v.as_py() for v in values)
            shared = -1
            if container == now:
                shared = next((i for i, (a, b) in enumerate(zip(before, ids, strict=False))
                               if a != b), min(len(before), len(ids)))
            keep = 0 if container != now else shared - top + 1
            while len(path) > keep:
                close()
            now, before, top, above, parent = container, ids, depth, heads, over
            for d in range(top + len(path), len(ids) + 1):
                path.append(_Node(conv, sizes[d - 1] if d else 0))
            path[-1].n, path[-1].ends = path[-1].n + n, ends
            path[-1].conv = min(path[-1].conv, conv)
        if len(out) > 4096:
            yield emitted()
            out.clear()
    while path:
        close()
    if out:
        yield emitted()


def _head_nodes(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes of the burst containers: a chain down to where each was burst."""
    heads = heads.withColumn("chain", (F.col("all") - 1) * F.aggregate(
        F.slice("path", F.greatest("depth", F.lit(1)), F.size("path")),
        F.lit(0).cast("long"), lambda a, x: a + x))
    below = tops.select("above", "n_leaves", "saved_tokens").unionByName(heads.select(
        "above", F.lit(0).cast("long").alias("n_leaves"), F.col("chain").alias("saved_tokens")))
    sums = below.select(F.posexplode("above").alias("at", "container"), "n_leaves",
                        "saved_tokens", F.size("above").alias("deep")).groupBy("container").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("under"),
        F.sum((F.col("at") + 1 == F.col("deep")).cast("long")).alias("children"))
    levels = heads.join(sums, "container").select(
        "*", F.explode(F.sequence("depth", "common")).alias("level"))
    rest = F.aggregate(F.slice("path", F.greatest("level", F.lit(1)), F.size("path")),
                       F.lit(0).cast("long"), lambda a, x: a + x)
    last = F.col("level") == F.col("common")
    return levels.select(
        F.col("least").alias("conv_id"), F.col("level").cast("long").alias("depth"),
        F.when(F.col("level") == F.col("depth"), F.col("parent")).otherwise(F.col("least"))
        .alias("parent_conv_id"), F.col("all").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).alias("n_children"), "n_leaves",
        (F.col("under") + (F.col("all") - 1) * rest).alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(F.lit(NO_ENDS))
        .alias("ends_sha256"))


def prefix_trie(convs: DataFrame, max_container: int = 1000) -> DataFrame:
    """One row for each node of the trie of ``convs`` (conv_id, ids, sizes).

    conv_id is the node's smallest member and names it together with depth. A
    conversation without turns ends at the root. Without conversations there is no node.
    """
    containers, heads = burst(distinct_sequences(convs), max_container)
    swept = (containers.repartition("container").sortWithinPartitions("container", "ids")
             .mapInArrow(sweep, NODE + ", above array<string>"))
    if heads is None:
        return swept.drop("above")
    swept = stored(swept, "nodes")
    tops = swept.filter("above is not null")
    return swept.drop("above").unionByName(_head_nodes(heads, tops))


def op12_prefix_trie(turns: DataFrame, max_container: int = 1000) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations.

    Nulls, ties and turns without a conversation: see ``sequences``. Repeated rows are
    turns each. Other columns are not used. An empty table gives no rows.
    """
    convs = stored(sequences(turns), "conversations")
    return prefix_trie(rebuilt(convs), max_container)
