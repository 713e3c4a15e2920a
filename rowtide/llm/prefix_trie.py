"""The prefix trie of conversations, with totals of every subtree, by a depth-band rollup.

A node is a distinct sequence of first turns. Its key is the exclusive or of 128-bit hashes of its turns, each with
its place, so a turn's own hash leads back from a node to its parent. A node is owned by its least conversation, and
a conversation owns all nodes of its path below the first that it owns.

The trie is cut into bands of ``HEIGHT`` depths. Nodes explode only to their ancestors in their own band. The sums
at the top nodes of the bands then form a trie that is ``HEIGHT`` times lower; its totals come by the same step, and
every completed band top is added to the nodes of the one band above it. So a node is exploded to at most ``HEIGHT``
ancestors in each step, and the number of rounds grows with the logarithm of the depth.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.frames import col, drop, kept, looked_up
from rowtide.session import pinned

#: Depths in a band.
HEIGHT = 16
#: Turns of a conversation that are summed up in one group, and ids of conversations that are joined to one text.
STRETCH, IDS = 1024, 4096

#: Words of a turn's text.
WORD = r"[^\x20\x09-\x0D]+"

KEY = ["k1", "k2"]


def placed(conversations: DataFrame) -> tuple[DataFrame, str]:
    """``conv_id, place, role, digest, n_words`` of every turn, and the path of the table; ``place`` counts from 0.

    Turns are ordered by ``turn`` (null first), equal ones by role and then by the MD5 of their text, so the order
    does not depend on how rows are read; rows alike in all of this may take either place. Null role or text is
    empty. Rows without ``conv_id`` are of no conversation and left out.

    Rows are sorted by range, so a conversation of any length is spread over tasks; they are numbered inside each
    range, and a conversation that goes on in the next range goes on with its number.
    """
    rows = conversations.select(*[col(x).alias(x) for x in ("conv_id", "turn", "role", "text")]).filter("conv_id IS NOT NULL")
    text = F.coalesce("text", F.lit(""))
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    spread = rows.repartitionByRange(F.col("conv_id"), *order, F.monotonically_increasing_id())
    ranged, path = kept(spread.withColumn("part", F.spark_partition_id()), "ranged")
    ends = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row for each range: a conversation that began in an earlier one.
    begun = pinned(ends.withColumn("begun", F.sum("n").over(before)).filter("begun IS NOT NULL").drop("n"))
    inside = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order)) - 1
    numbered = ranged.withColumn("inside", inside).join(F.broadcast(begun), ["part", "conv_id"], "left")
    place = (F.col("inside") + F.coalesce("begun", F.lit(0))).cast("long").alias("place")
    out = kept(numbered.select("conv_id", place, "role", "digest", "n_words"), "placed")
    drop(conversations, path)
    return out


def paths(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, str]:
    """A row for each conversation and depth: the node's key, its parent's, and the words of its last turn."""
    own = turns.select(
        "conv_id",
        (F.col("place") + 1).alias("depth"),
        F.xxhash64("place", "role", "digest").alias("h1"),
        F.xxhash64("digest", "role", "place", F.lit("second")).alias("h2"),
        "n_words",
    ).withColumn("stretch", F.floor(F.col("depth") / STRETCH))
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("depth")
    sums = [F.bit_xor(h).alias(h) for h in ("h1", "h2")]
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = own.groupBy("conv_id", "stretch").agg(*sums)
    carried = whole.select("conv_id", "stretch", *[F.bit_xor(h).over(before).alias(f"b{h}") for h in ("h1", "h2")])
    keyed = own.withColumns({"x1": F.bit_xor("h1").over(so_far), "x2": F.bit_xor("h2").over(so_far)})
    keyed = keyed.join(carried.filter("stretch > 0"), ["conv_id", "stretch"], "left")
    keys = [F.col(x).bitwiseXOR(F.coalesce(b, F.lit(0))) for x, b in (("x1", "bh1"), ("x2", "bh2"))]
    found = keyed.select(
        "conv_id",
        "depth",
        keys[0].alias("k1"),
        keys[1].alias("k2"),
        keys[0].bitwiseXOR(F.col("h1")).alias("p1"),
        keys[1].bitwiseXOR(F.col("h2")).alias("p2"),
        "n_words",
    )
    none = [F.lit(0).cast("long").alias(x) for x in ("depth", "k1", "k2")]
    top = conversations.select("conv_id", *none, *[F.lit(None).cast("long").alias(x) for x in ("p1", "p2")], F.lit(0).cast("long"))
    return kept(found.unionAll(top), "paths")


def rolled_up(along: DataFrame, nodes: DataFrame, deepest: int, height: int = HEIGHT) -> tuple[DataFrame, str]:
    """``nodes`` (key, owner ``conv_id``, ``depth``, ``n_leaves``, ``saved_tokens``) with the two sums over their subtrees.

    ``along`` holds ``conv_id, depth`` and key of the path of every owner. A node is exploded to its ancestors in its
    band by a join with its owner's path there; what they get is summed up before it is shuffled.
    """
    band = F.floor(F.col("depth") / height)
    steps = along.select("conv_id", band.alias("band"), F.col("depth").alias("at"), *KEY)
    sums = [F.sum(x).alias(x) for x in ("n_leaves", "saved_tokens")]
    below = nodes.drop(*KEY).withColumn("band", band).join(steps, ["conv_id", "band"]).filter("at <= depth")
    itself = F.min(F.when(F.col("at") == F.col("depth"), F.col("conv_id"))).alias("conv_id")
    summed, path = kept(below.groupBy(*KEY).agg(itself, F.min("at").alias("depth"), *sums), "summed")
    if deepest < height:
        return summed, path
    lower = (F.col("depth") / height).cast("long")
    tops = [x.filter(F.col("depth") % height == 0).withColumn("depth", lower) for x in (along, summed)]
    complete, complete_path = rolled_up(*tops, deepest // height, height)
    added = complete.filter("depth > 0").select("conv_id", (F.col("depth") - 1).alias("band"), "n_leaves", "saved_tokens")
    added = added.join(steps, ["conv_id", "band"]).select(*KEY, "n_leaves", "saved_tokens")
    every = summed.unionByName(added, allowMissingColumns=True).groupBy(*KEY)
    out = kept(every.agg(F.max("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums), "rolled")
    drop(along, path, complete_path)
    return out


def digests(ends: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256``: the hash of the ascending ids of the conversations that end at a node, comma-joined.

    Ids are joined in runs of at most ``IDS`` by many tasks; the runs of a node, which are in one task as a hash has
    to go through them in order, stream through it.
    """
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    runs = ends.groupBy(*KEY, F.floor(F.col("conv_id") / IDS).alias("run")).agg(ids)

    def digest(batches):
        before, state = None, None
        for batch in batches:
            done = []
            for key, ids in zip(zip(*(batch.column(x).to_pylist() for x in KEY), strict=True), batch.column("ids").to_pylist(), strict=True):
                if key == before:
                    state.update(b"," + ids.encode())
                    continue
                if before is not None:
                    done.append((*before, state.hexdigest()))
                before, state = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], [*KEY, "ends_sha256"])
        if before is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*before, state.hexdigest())], [*KEY, "ends_sha256"])

    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "run").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """A row per node: ``k1, k2`` (its key), ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes in the subtree, itself included),
    ``saved_tokens`` (over the subtree, members but one times words of the last turn) and ``ends_sha256``.

    ``turns`` is as of ``placed``, ``conversations`` has a row for each ``conv_id``; those without turns are members
    of the root only. Without conversations there is no node, not even the root.
    """
    along, along_path = paths(turns, conversations)
    found = along.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.count("*").alias("n_convs"),
        ((F.count("*") - 1) * F.min("n_words")).alias("saved_tokens"),
    )
    found, found_path = kept(found, "nodes")
    kids = found.filter("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    kids, kids_path = kept(kids, "kids")
    nodes = found.join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes, nodes_path = kept(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "nodes")
    size = nodes.agg(F.count("*").alias("n"), F.max("depth").alias("deepest")).first()
    totals, _ = rolled_up(along.select("conv_id", "depth", *KEY), nodes.select(*KEY, "conv_id", "depth", "n_leaves", "saved_tokens"), size["deepest"] or 0, height)
    ends = along.groupBy("conv_id").agg(*[F.max_by(k, "depth").alias(k) for k in KEY])
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    weights = kids.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("n_children").alias("n"))
    known = looked_up(nodes.drop("n_leaves", "saved_tokens"), parents, ["p1", "p2"], weights, size["n"])
    out = known.join(totals.select(*KEY, "n_leaves", "saved_tokens"), KEY).join(digests(ends), KEY, "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    out = out.select(
        *KEY, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    return out
