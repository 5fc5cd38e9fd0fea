"""Conversation prefix trie, with sums over subtrees rolled up in bands of depths.

1. Turns are hashed to 128 bits where they are read; no text is shuffled.  Their places are ranks in a
   range-partitioned order, so a long conversation is spread over tasks.
2. A node is a depth and the running XOR of its turns' hashes, each mixed with its depth; taking a turn's
   own hash off gives the parent.  Running values are made in blocks of turns, then over blocks.
3. Sums over subtrees.  Each node adds its values to its ancestors within its band of ``BAND`` depths.  Band roots then stand for their bands, in bands of
   their own, and so on until one band is left.  Back down, the completed sum of each band root goes to its
   at most ``BAND`` ancestors in the band above.  So ``2 log(depth)`` rounds, and no node is copied to more
   than ``BAND`` rows in any of them.
4. The ids that end in a node are joined to text in blocks of ids and digested as a sorted stream.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.session import staged

BAND = 16
#: turns whose running hash is made by one window
BLOCK = 1024
#: ids ``x`` to ``x + 2**ID_BITS - 1`` are joined to one text
ID_BITS = 10
KEY = ["depth", "k1", "k2"]
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def mixed(depth: Column, t1: Column, t2: Column) -> list[Column]:
    return [F.xxhash64(depth, t1, t2), F.xxhash64(t2, depth, t1)]


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, t1, t2, size`` of every turn: place from 1 in the order of ``turn`` (null first).

    Turns of one number come in the order of their hashes.  Rows without ``conv_id`` belong to no
    conversation; null role or text is empty; repeated rows are turns like others.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), text, role).alias("t2"),
        F.octet_length(text).cast("long").alias("size"))
    # the number of the range partition is written with the rows: it's the same for all that read it
    dealt = staged(turns.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "t1", "t2")
                   .withColumn("deal", F.spark_partition_id()), "turns")
    deals = dealt.groupBy("conv_id", "deal").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1))
    offsets = deals.withColumn("before", before).where("before is not null").select("conv_id", "deal", "before")
    order = [F.col("turn").asc_nulls_first(), "t1", "t2"]
    rank = F.row_number().over(Window.partitionBy("conv_id", "deal").orderBy(*order))
    return dealt.withColumn("rank", rank).join(offsets, ["conv_id", "deal"], "left").select(
        "conv_id", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("place"), "t1", "t2", "size")


def with_shared_openings(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on another one's opening: ``(conv_id, depth, t1, t2, size)`` and ``(conv_id, n)``.

    Conversation c takes the first h turns of ``c - c % family`` (all it has, if fewer), then its own
    after its first h; ``h = crc32(c as text) % most``.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    opening = F.crc32(F.col("conv_id").cast("string")) % most
    convs = own.select("conv_id", "n", opening.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = staged(convs.join(bases, "base", "left").select(
        "conv_id", "base", "n", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")), "conversations")
    first = (convs.where("taken > 0").select("conv_id", "base", "taken")
             .join(turns.where(F.col("place") < most).select(F.col("conv_id").alias("base"), "place", "t1", "t2", "size"), "base")
             .where("place <= taken").select("conv_id", F.col("place").alias("depth"), "t1", "t2", "size"))
    rest = (turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place > h")
            .select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "t1", "t2", "size"))
    length = F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))
    return first.unionAll(rest), convs.select("conv_id", length.cast("long").alias("n"))


def steps(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, k1, k2, p1, p2, size``: the node that each conversation reaches with each turn, and its parent."""
    x = turns.select("conv_id", F.col("depth").cast("long").alias("depth"), "size",
                     *[c.alias(n) for c, n in zip(mixed(F.col("depth").cast("long"), F.col("t1"), F.col("t2")), ("x1", "x2"))])
    block = F.floor(F.col("depth") / BLOCK).alias("block")
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = staged(x.select("*", block).select("conv_id", "depth", "block", "size", "x1", "x2", F.bit_xor("x1").over(upto).alias("k1"),
                                             F.bit_xor("x2").over(upto).alias("k2")), "runs")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = (run.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"))
             .select("conv_id", "block", F.bit_xor("b1").over(earlier).alias("b1"), F.bit_xor("b2").over(earlier).alias("b2")))
    later = (run.where("block > 0").join(total.where("block > 0"), ["conv_id", "block"])
             .withColumns({"k1": F.col("k1").bitwiseXOR(F.col("b1")), "k2": F.col("k2").bitwiseXOR(F.col("b2"))}))
    out = ["conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"),
           F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "size"]
    return run.where("block = 0").select(*out).unionAll(later.select(*out))


def nodes_of(walked: DataFrame, convs: DataFrame) -> DataFrame:
    """``depth, k1, k2, conv_id, n_convs, size, p1, p2`` of every node, the root included if there is a conversation."""
    below = walked.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                     F.min("size").alias("size"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    none = F.lit(None).cast("long")
    root = (convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
            .select(*[F.lit(0).cast("long").alias(c) for c in KEY], "conv_id", "n_convs", F.lit(0).cast("long").alias("size"),
                    none.alias("p1"), none.alias("p2")))
    return below.unionAll(root)


def ancestors(walked: DataFrame, nodes: DataFrame, unit: int) -> DataFrame:
    """Per node at a depth divisible by ``unit`` (its key as ``depth, k1, k2``): ``above``, its ancestors at such depths.

    The nearest ``2 * BAND - 1`` of them, in ascending order, read off the steps of its first
    conversation; without the root.  A conversation is the first one of all its nodes from some
    depth on, so only its steps near these are looked at.
    """
    from_ = nodes.where("depth > 0").groupBy("conv_id").agg(F.min("depth").alias("from"))
    near = (walked.where(F.col("depth") % unit == 0).join(from_, "conv_id")
            .where(F.col("depth") > F.col("from") - 2 * BAND * unit))
    # windows hold a block of depths each, with the end of the block before for context
    home = F.floor(F.col("depth") / (BLOCK * unit))
    near_end = F.col("depth") % (BLOCK * unit) >= (BLOCK - 2 * BAND) * unit
    blocks = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    spread = near.withColumn("block", F.explode(blocks)).withColumn("own", F.col("block") == home)
    window = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(-(2 * BAND - 1), -1)
    above = F.collect_list(F.struct(*KEY)).over(window)
    return spread.withColumn("above", above).where("own and depth >= from").select(*KEY, "above")


def rolled_up(walked: DataFrame, nodes: DataFrame, values: list[str], deepest: int) -> DataFrame:
    """``depth, k1, k2`` and the sums of ``values`` over each node's subtree, itself included."""
    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values])

    def added(paths: DataFrame, wanted: Column) -> DataFrame:
        """Values of ``paths`` rows at each of the ancestors ``wanted``."""
        return paths.select(F.explode(wanted).alias("x"), *values).select("x.*", *values)

    root = F.struct(*[F.lit(0).cast("long").alias(c) for c in KEY])
    no_nodes = F.array().cast("array<struct<depth:bigint,k1:bigint,k2:bigint>>")
    unit, levels = 1, []
    here = nodes.select(*KEY, *values)
    while True:
        band = unit * BAND
        with_root = F.when((F.col("depth") > 0) & (F.col("depth") < 2 * band), F.array(root)).otherwise(no_nodes)
        paths = staged(here.join(ancestors(walked, nodes, unit), KEY, "left")
                       .withColumn("above", F.concat(with_root, F.coalesce("above", no_nodes))), "paths")
        start = F.col("depth") - F.col("depth") % band
        within = F.filter("above", lambda a: a["depth"] >= start)
        mine = paths.select(*KEY, *values)
        total = staged(sums(mine.unionAll(added(paths, within))), "bands")
        levels.append((unit, paths.select(*KEY, "above"), total))
        if band > deepest:
            break
        here, unit = total.where(F.col("depth") % band == 0), band
    done = total
    for unit, paths, total in reversed(levels[:-1]):
        # band roots' completed sums go to the band above; their own places have them already
        band = unit * BAND
        lowest = F.col("depth") - band
        before = F.filter("above", lambda a: a["depth"] >= lowest)  # noqa: B023
        roots = done.where("depth > 0").join(paths.where(F.col("depth") % band == 0), KEY)
        done = staged(sums(total.unionAll(added(roots, before))), "sums")
    return done


def digests(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256``: the digest of the ids (``conv_id``) in each node, ascending, comma-joined.

    Ids are put together in blocks of a bounded number; a node's blocks then pass one task in
    order, which keeps nothing but the running digest.
    """
    blocks = (ends.groupBy(*KEY, F.shiftright("conv_id", ID_BITS).alias("block"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))

    def digest(batches):
        now, running = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if key != now:
                    if now is not None:
                        done.append((*now, running.hexdigest()))
                    now, running = key, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield as_rows(done)
        if now is not None:
            yield as_rows([(*now, running.hexdigest())])

    def as_rows(done):
        columns = list(zip(*done)) if done else [[], [], [], []]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                                          [*KEY, "ends_sha256"])

    return (blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")
            .mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv_id, depth, t1, t2, size``) and ``convs`` (``conv_id, n``).

    ``conv_id`` (the smallest member's), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.  Conversations without turns are members of the root.  Equal hashes
    (128 bits) count as equal sequences.  No conversation, no rows.
    """
    walked = staged(steps(turns), "steps")
    nodes = nodes_of(walked, convs)
    children = (nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
                .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children")))
    nodes = staged(nodes.join(children, KEY, "left").select(
        *KEY, "conv_id", "n_convs", "p1", "p2", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")), "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = rolled_up(walked, nodes, ["n_leaves", "saved_tokens"], deepest)
    zero = F.lit(0).cast("long")
    last = (walked.join(convs, "conv_id").where("depth = n").select("conv_id", *KEY)
            .unionAll(convs.where("n = 0").select("conv_id", *[zero.alias(c) for c in KEY])))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    return (nodes.drop("n_leaves", "saved_tokens").join(sums, KEY).join(digests(last), KEY, "left")
            .join(parents, ["depth", "p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)).alias("ends_sha256")))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of :func:`placed_turns` with :func:`with_shared_openings`."""
    turns = staged(placed_turns(conversations), "places")
    built, convs = with_shared_openings(turns)
    return prefix_trie(built, convs)


# crc32 by its definition: bytes of the decimal id, eight shifts each; node ids by lists of turns
ORACLE = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list(turn ORDER BY place) AS turns,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: xor(v >> 1, (v & 1) * 3988292384::BIGINT)))) % 9 AS h
  FROM t GROUP BY c
), rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 5
), steps AS (
  SELECT c, d, md5(CAST(to_json(turns[1:d]) AS VARCHAR)) AS k, CASE WHEN d > 0 THEN turns[d].x ELSE '' END AS x, len(turns) = d AS ends
  FROM rebuilt, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)
), nodes AS (
  SELECT d, k, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * strlen(any_value(x)) AS saved,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
  FROM steps GROUP BY d, k
), up AS (
  SELECT n.d, n.c, n.saved, n.n_convs, n.ends_sha256, p.c AS parent
  FROM nodes n JOIN steps s ON s.c = n.c AND s.d = n.d - 1 JOIN nodes p ON p.d = s.d AND p.k = s.k
), children AS (
  SELECT d - 1 AS d, parent AS c, count(*) AS n FROM up GROUP BY ALL
), all_nodes AS (
  SELECT n.d, n.c, n.k, n.n_convs, n.saved, n.ends_sha256, u.parent, coalesce(ch.n, 0) AS n_children
  FROM nodes n LEFT JOIN up u ON u.d = n.d AND u.c = n.c LEFT JOIN children ch ON ch.d = n.d AND ch.c = n.c
), sums AS (
  SELECT a.d, a.k, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(n.saved) AS saved
  FROM all_nodes n JOIN steps a ON a.c = n.c AND a.d <= n.d GROUP BY a.d, a.k
)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, n.parent AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM all_nodes n JOIN sums s ON s.d = n.d AND s.k = n.k
"""
