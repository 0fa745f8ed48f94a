"""Prefix trie of conversations by ROLLUP over positional columns of turn ids.

Every conversation is first rebuilt: some turns are taken from the conversation
that leads its hundred, and its own follow.  A turn's id is the digest of its
role and text with the length of the text.  A rebuilt conversation is cut into
blocks of WIDTH turns, one row each, with the turn ids in positional columns;
``GROUP BY block, key, ROLLUP (t1, ..., tn)`` aggregates the prefixes of all
lengths together, and ``grouping_id`` tells how long each is.  A further block
is keyed by the node that the block before ended in: the exclusive or, over the
turns so far, of 128-bit hashes of position and turn id, which needs no join and
no pass from block to block.

Sums over subtrees are a second ROLLUP, over the nodes.  What hangs below a
block is first summed over the tree of blocks by pointer doubling, in as many
rounds as the logarithm of the longest chain of blocks.

No conversation, node or set of children is gathered in one task: positions and
keys are counted within ranges with offsets between them, nodes with many
children are joined by broadcast, and the ids that end in a node are hashed as a
sorted stream of pieces, whose digest state is all that a task holds.

Defined results: turns are ordered by turn, NULL first; turns with the same
number, which the order leaves open, by their digest.  A NULL role or text
counts as empty.  Rows that repeat a turn are turns.  A row without a
conversation id belongs to none and is left out.  An empty table has no nodes,
not even a root.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.common import attach_groups, store
from shelfcast.operators.ordering import ranged_index

WIDTH = 6
# Conversations that share their first turns' source, and one more than the most turns taken from it.
HUNDRED, HEADS = 100, 6
# Ids, and characters, in one piece of a list of ends.
PIECE = 65_536
EMPTY = hashlib.sha256(b"").hexdigest()


def columns(width: int) -> list[str]:
    return [f"t{k}" for k in range(1, width + 1)]


def turn_id(role: Column, text: Column) -> Column:
    """A struct of a 128-bit digest and the text's code points."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.struct(F.unhex(F.md5(named.cast("binary"))).alias("digest"), F.char_length(text).cast("long").alias("n"))


def numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, pos, t``: the turns of each conversation in order, from 0."""
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), turn_id(F.col(role), F.col(text)).alias("t")
    )
    placed = ranged_index(rows, [F.col("turn").asc_nulls_first(), F.col("t.digest").asc()], ["conv_id"], "pos")
    return store(placed.select("conv_id", "pos", "t"), "trie-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (``conv_id, total, pos, t``) and the conversations (``conv_id, total``), turnless ones too."""
    leader = F.col("conv_id") - F.col("conv_id") % HUNDRED
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    heads = turns.filter((F.col("conv_id") == leader) & (F.col("pos") < HEADS - 1)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("head")
    )
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    head = F.slice(F.coalesce("head", F.expr("array()").cast(heads.schema["head"].dataType)), F.lit(1), taken)
    convs = store(
        sizes.withColumn("leader", leader)
        .join(heads.withColumnRenamed("conv_id", "leader"), "leader", "left")
        .select("conv_id", "n", taken.alias("taken"), head.alias("head"))
        .select("*", (F.size("head") + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).alias("total")),
        "trie-conversations",
    )
    facts = convs.select("conv_id", "n", "taken", F.size("head").alias("lead"), "total")
    own = attach_groups(turns, facts, "conv_id", "n").filter("pos >= taken").select(
        "conv_id", "total", (F.col("pos") - F.col("taken") + F.col("lead")).cast("long").alias("pos"), "t"
    )
    led = convs.select("conv_id", "total", F.explode("head").alias("h")).select(
        "conv_id", "total", F.col("h.pos").cast("long").alias("pos"), "h.t"
    )
    return led.unionByName(own), convs.select("conv_id", "total")


def mark(depth: Column, turn: Column) -> Column:
    """128 bits for a turn at a depth, from 1; the exclusive or along a path names the node."""
    return F.struct(*[F.xxhash64(F.lit(s), depth.cast("long"), turn).alias(f"k{s}") for s in (1, 2)])


def either(a: Column, b: Column) -> Column:
    """Exclusive or of two marks; a NULL one changes nothing."""
    zero = F.lit(0).cast("long")
    return F.struct(*[
        F.coalesce(a[k], zero).bitwiseXOR(F.coalesce(b[k], zero)).alias(k) for k in ("k1", "k2")
    ])


def path(key: Column, block: Column, turns: list[Column], width: int) -> Column:
    """The mark of the node reached from ``key`` by the turns of a block that are not NULL."""
    steps = [F.when(t.isNotNull(), mark(block * width + k + 1, t)) for k, t in enumerate(turns)]
    return reduce(either, steps, key)


def blocks(turns: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """``conv_id, total, block, key, t1, ...``: a row for each block of a conversation, and one for a turnless one."""
    names = columns(width)
    wide = turns.withColumn("block", F.floor(F.col("pos") / width)).groupBy("conv_id", "block").agg(
        F.first("total").alias("total"),
        *[F.max(F.when(F.col("pos") % width == k, F.col("t"))).alias(t) for k, t in enumerate(names)],
    )
    bare = convs.filter("total = 0").select("conv_id", F.lit(0).cast("long").alias("block"), "total")
    rows = wide.unionByName(bare, allowMissingColumns=True)
    nothing = F.struct(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    ranged = store(
        rows.withColumn("own", path(nothing, F.col("block"), [F.col(t) for t in names], width))
        .repartitionByRange("conv_id", "block").withColumn("_range", F.spark_partition_id()),
        "trie-blocks",
    )

    def before(over) -> Column:
        earlier = over.rowsBetween(Window.unboundedPreceding, -1)
        return F.struct(*[F.bit_xor(f"own.{k}").over(earlier).alias(k) for k in ("k1", "k2")])

    parts = ranged.groupBy("conv_id", "_range").agg(
        F.struct(F.bit_xor("own.k1").alias("k1"), F.bit_xor("own.k2").alias("k2")).alias("own"))
    offsets = parts.select("conv_id", "_range", before(Window.partitionBy("conv_id").orderBy("_range")).alias("offset"))
    here = before(Window.partitionBy("conv_id", "_range").orderBy("block"))
    return store(
        ranged.withColumn("here", here).join(offsets, ["conv_id", "_range"])
        .select("conv_id", "total", "block", either(F.col("offset"), F.col("here")).alias("key"), *names),
        "trie-keyed",
    )


def rolled(rows: DataFrame, width: int, aggregates: str) -> DataFrame:
    """Aggregates over every prefix of the rows' turns within their block; ``level`` is the prefix's length there."""
    names = columns(width)
    tried = rows.sparkSession.sql(
        f"""SELECT block, key, {", ".join(names)}, CAST({width} - bit_count(grouping_id()) AS INT) AS level, {aggregates}
            FROM {{rows}} GROUP BY block, key, ROLLUP ({", ".join(names)})""",
        rows=rows,
    )
    # a row that ends before a level has no prefix of that length; a later block's empty prefix is the node it hangs on
    last = F.coalesce(*[F.when(F.col("level") == k, F.col(t).isNotNull()) for k, t in enumerate(names, 1)], F.col("block") == 0)
    return tried.filter(last)


def trie_nodes(rows: DataFrame, width: int) -> DataFrame:
    """One row per node: its block, key, turns and level there, ``node``, ``parent``, least member and members."""
    names = columns(width)
    found = rolled(rows, width, "min(conv_id) AS conv_id, count(*) AS n_convs")
    level, block = F.col("level"), F.col("block")
    depth = (block * width + level).cast("long")
    last = F.coalesce(*[F.when(level == k, F.col(t)) for k, t in enumerate(names, 1)])
    node = path(F.col("key"), block, [F.col(t) for t in names], width)
    known = found.withColumn("depth", depth).withColumn("mark", node).withColumn("last", last)
    parent = either(F.col("mark"), mark(F.col("depth"), F.col("last")))
    return known.select(
        "block", "key", *names, "level", "depth", "conv_id", "n_convs",
        F.struct(F.col("depth"), F.col("mark.k1").alias("k1"), F.col("mark.k2").alias("k2")).alias("node"),
        F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), parent["k1"].alias("k1"), parent["k2"].alias("k2")))
        .alias("parent"),
        ((F.col("n_convs") - 1) * F.coalesce(F.col("last.n"), F.lit(0))).alias("saved"),
    )


def with_family(nodes: DataFrame) -> DataFrame:
    """Stored nodes with ``parent_conv_id`` and ``n_children``."""
    counts = store(nodes.filter("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    counted = store(
        nodes.join(counts, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-counted")
    parents = store(
        counted.filter("n_children > 0").select(
            F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings")),
        "trie-parents",
    )
    grown = attach_groups(counted.filter("depth > 0"), parents, "parent", "siblings").drop("siblings")
    return store(grown.unionByName(counted.filter("depth = 0"), allowMissingColumns=True), "trie-family")


def below(nodes: DataFrame, width: int) -> DataFrame:
    """``node, leaves, saved``: for nodes that further blocks hang on, the sums over all nodes of those blocks and what hangs on them."""
    leaf = (F.col("n_children") == 0).cast("long")
    at = F.struct(F.col("block") * width, F.col("key.k1"), F.col("key.k2"))
    kind = "struct<depth:bigint,k1:bigint,k2:bigint>"
    sums = nodes.filter("block > 0").groupBy(at.cast(kind).alias("node")).agg(
        F.sum(leaf).alias("leaves"), F.sum("saved").alias("saved"))
    # the node each block hangs on lies in a block that hangs on another one
    up = nodes.filter((F.col("level") == width) & (F.col("n_children") > 0)).select(
        "node", F.when(F.col("block") > 0, at.cast(kind)).alias("anchor"))
    total = store(sums, "trie-below")
    jump = store(up, "trie-anchor")
    while jump.filter("anchor IS NOT NULL").limit(1).count():
        added = total.join(jump.filter("anchor IS NOT NULL"), "node").groupBy(F.col("anchor").alias("node")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        grown = store(
            total.join(added, "node", "left").select(
                "node", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")),
            "trie-below",
        )
        counts = store(jump.filter("anchor IS NOT NULL").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), "trie-jumps")
        further = store(
            counts.join(jump.select(F.col("node").alias("anchor"), F.col("anchor").alias("next")), "anchor"), "trie-further")
        jumped = attach_groups(jump.filter("anchor IS NOT NULL"), further, "anchor", "n")
        jump = store(jumped.select("node", F.col("next").alias("anchor")), "trie-anchor")
        total = grown
    return total


def ends(rows: DataFrame, width: int) -> DataFrame:
    """``node, ends_sha256`` of the nodes that conversations end in."""
    final = rows.filter(F.greatest((F.col("total") - 1), F.lit(0)).cast("long") < (F.col("block") + 1) * width)
    reached = path(F.col("key"), F.col("block"), [F.col(t) for t in columns(width)], width)
    ending = final.withColumn("mark", reached).select(
        "conv_id", F.struct(F.col("total").cast("long").alias("depth"), F.col("mark.k1").alias("k1"), F.col("mark.k2").alias("k2")).alias("node"))
    pieces = (
        ending.select(*flat(F.col("node")), "conv_id").repartitionByRange("depth", "k1", "k2", "conv_id")
        .sortWithinPartitions("depth", "k1", "k2", "conv_id")
        .mapInArrow(id_pieces, "depth long, k1 long, k2 long, first long, ids string")
    )
    hashed = (
        pieces.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "first")
        .mapInArrow(piece_digests, "depth long, k1 long, k2 long, ends_sha256 string")
    )
    return store(hashed.select(F.struct("depth", "k1", "k2").alias("node"), "ends_sha256"), "trie-ends")


def flat(node: Column) -> list[Column]:
    return [node[k].alias(k) for k in ("depth", "k1", "k2")]


def id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted rows with one node as rows with their ids comma-joined, PIECE at most together."""
    for batch in batches:
        node, rows = None, []
        for depth, k1, k2, conv in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if node != (depth, k1, k2) or len(rows[-1][4]) >= PIECE:
                node = (depth, k1, k2)
                rows.append((*node, conv, []))
            rows[-1][4].append(str(conv))
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([r[k] for r in rows], pa.int64()) for k in range(4)), pa.array([",".join(r[4]) for r in rows], pa.string())],
            ["depth", "k1", "k2", "first", "ids"],
        )


def piece_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which arrive in order; only a digest's state is held."""
    node, state = None, None
    for batch in batches:
        done = []
        for depth, k1, k2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
            if node == (depth, k1, k2):
                state.update(b",")
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (depth, k1, k2), hashlib.sha256()
            state.update(ids.encode())
        yield digest_rows(done)
    if node is not None:
        yield digest_rows([(*node, state.hexdigest())])


def digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.string())],
        ["depth", "k1", "k2", "ends_sha256"],
    )


def prefix_trie(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", width: int = WIDTH,
) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    rows = blocks(*rebuilt(numbered(turns, conv, turn, role, text)), width)
    nodes = with_family(store(trie_nodes(rows, width), "trie-nodes"))
    hanging = below(nodes, width)
    names = columns(width)
    own = nodes.join(hanging.withColumnsRenamed({"leaves": "more_leaves", "saved": "more_saved"}), "node", "left").select(
        "block", "key", *names,
        F.struct("level", "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children").alias("top"),
        ((F.col("n_children") == 0).cast("long") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
    )
    # the prefix itself is the shortest of the nodes that begin with it
    whole = rolled(own, width, "min(top) AS top, sum(leaves) AS n_leaves, sum(saved) AS saved_tokens")
    told = whole.select("top.*", "n_leaves", "saved_tokens").drop("level")
    return told.join(ends(rows, width), "node", "left").select(
        F.col("conv_id").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


SQL = r"""
WITH named AS (
    SELECT conv_id, turn, length(coalesce(text, '')) AS n,
           md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id
    FROM conversations WHERE conv_id IS NOT NULL
), original AS MATERIALIZED (
    SELECT conv_id, list({'id': id, 'n': n} ORDER BY turn NULLS FIRST, id) AS turns FROM named GROUP BY conv_id
), taken AS (  -- crc32 of the decimal id, bit by bit
    SELECT *, (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 6)::INT AS h
    FROM original
), rebuilt AS MATERIALIZED (
    SELECT t.conv_id, coalesce(o.turns[1:h], []) || t.turns[h + 1:] AS turns
    FROM taken t LEFT JOIN original o ON o.conv_id = t.conv_id - t.conv_id % 100
), prefixes AS (
    SELECT conv_id, len(turns) AS total, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS MATERIALIZED (
    SELECT depth, turns[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '') AS ends
    FROM prefixes GROUP BY 1, 2
), children AS (
    SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), known AS MATERIALIZED (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
           CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * n.prefix[n.depth].n END AS saved
    FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix
), sums AS (
    SELECT d AS depth, prefix[1:d] AS prefix, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM known) GROUP BY 1, 2
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, sha256(k.ends) AS ends_sha256
FROM known k JOIN sums s ON s.depth = k.depth AND s.prefix = k.prefix
LEFT JOIN known p ON p.depth = k.depth - 1 AND p.prefix = k.prefix[1:k.depth - 1]
"""
