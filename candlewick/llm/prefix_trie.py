"""Prefix trie of conversations by ROLLUP over positional turn columns (operator 11).

A turn is known by 120 bits of a SHA-256 of its role and text. Conversations are laid out in blocks of ``WIDTH``
positions: a row per conversation and block, a column per position. One ``GROUP BY block, prior, ROLLUP (t0, ..., t7)``
then aggregates all prefixes together; ``grouping_id`` tells how many positions a group has. A longer conversation goes
on in further blocks, keyed by the node that the block before ended in (``p1``, ``p2``), so that equal continuations meet
only behind equal beginnings. That node's key is the exclusive or of the blocks before, each hashed with its number; it is
a running aggregate, so all blocks take part in the same ROLLUP, whatever the number of blocks.

What holds for a node's whole subtree comes from sums over its members, without a pass per depth. The smallest member of
a node owns it; a conversation owns the end of its path from some depth on. With T the words of a member, N the words of
the nodes it owns, P the words before the node, o the node's owner: the words that the members have from the node on are
sum(T) - n P, the words of the nodes in the subtree sum(N) - N(o) + T(o) - P, and the difference is what sharing saves.
Childless nodes are counted at their owners.

The list of members that end in a node is hashed in pieces: ids are joined per ``PIECE`` neighbouring ids, a bounded
group, and a task streams a node's pieces through one SHA-256.

Defined results: rows without conversation id belong to none; turns are ordered by turn, null first, and turns with the
same number by the hash of what they say; a null role or text is an empty one; repeated rows are repeated turns; a table
without conversations has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.common import WORD, ship, stored
from candlewick.operators.ranking import global_row_number

#: Positions of a block; blocks that a running aggregate takes at a time; a power of two of ids that are joined at once.
WIDTH, RUN, PIECE_BITS = 8, 512, 10


def turns(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """conv, pos (from 1), and the turn: a, b (its hash), words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), "turn",
        F.conv(F.substring(said, 1, 15), 16, 10).cast("long").alias("a"), F.conv(F.substring(said, 16, 15), 16, 10).cast("long").alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    return global_row_number(rows, order, "pos", group="conv").drop("turn")


def rebuilt(turn_rows: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c behind the first crc32(c) % most turns of conversation c - c % family, in place of as many of
    its own: ``turns`` rows with m, the number of turns, and a row without position for one that has none."""
    sizes = turn_rows.groupBy("conv").agg(F.max("pos").alias("n"))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    plan = sizes.withColumn("h", head).withColumn("base", F.col("conv") - F.col("conv") % family).join(
        sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left")
    plan = plan.withColumn("kept", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn(
        "m", F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("kept"))
    own = turn_rows.join(plan.select("conv", "h", "kept", "m"), "conv").where("pos > h").withColumn("pos", F.expr("pos - h + kept"))
    heads = turn_rows.where((F.col("pos") < most) & (F.col("conv") % family == 0)).withColumnRenamed("conv", "base")
    lent = plan.where("kept > 0").join(heads, "base").where("pos <= kept")
    none = plan.where("m = 0").withColumns({"pos": F.lit(None).cast("long"), **{c: F.lit(None).cast("long") for c in ("a", "b", "words")}})
    columns = ["conv", F.col("pos").cast("long").alias("pos"), "a", "b", "words", F.col("m").cast("long").alias("m")]
    return own.select(*columns).union(lent.select(*columns)).union(none.select(*columns))


def _t(k: int) -> str:
    return f"t{k}"


def _hash(salt: int, block: Column, columns: list[Column]) -> Column:
    return F.xxhash64(F.lit(salt), block, *columns)  # a null column changes nothing


def blocks(rows: DataFrame, width: int, run: int) -> DataFrame:
    """A row per conversation and block: t0 ... (the turns), p1, p2 (the node before), pw (words before), w (own words), m."""
    place = F.coalesce(F.col("pos") - 1, F.lit(0))
    placed = rows.withColumn("block", F.floor(place / width).cast("long")).withColumn("slot", F.pmod(place, F.lit(width)))
    wide = placed.groupBy("conv", "block").agg(
        F.max("m").alias("m"), F.coalesce(F.sum("words"), F.lit(0)).alias("w"),
        *[F.max(F.when(F.col("slot") == k, F.col(c))).alias(f"{c}{k}") for k in range(width) for c in ("a", "b", "words")])
    whole = [F.when(F.col(f"a{k}").isNotNull(), F.struct(F.col(f"a{k}").alias("a"), F.col(f"b{k}").alias("b"), F.col(f"words{k}").alias("words"))).alias(_t(k))
             for k in range(width)]
    wide = wide.select("conv", "block", "m", "w", *whole)
    nothing = {c: F.lit(0).cast("long") for c in ("p1", "p2", "pw")}
    short = wide.where(F.col("m") <= width).withColumns(nothing)
    # running aggregates over the blocks of a longer conversation, RUN at a time
    long = wide.where(F.col("m") > width).withColumn("run", F.floor(F.col("block") / run))
    steps = {"p1": F.bit_xor("x1"), "p2": F.bit_xor("x2"), "pw": F.sum("w")}
    long = long.withColumns({f"x{s}": _hash(s, F.col("block"), [F.col(_t(k)) for k in range(width)]) for s in (1, 2)})
    within = W.partitionBy("conv", "run").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    runs = long.groupBy("conv", "run").agg(*[f.alias(c) for c, f in (("x1", steps["p1"]), ("x2", steps["p2"]), ("w", steps["pw"]))])
    before = W.partitionBy("conv").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("conv", "run", *[F.coalesce(f.over(before), F.lit(0)).alias(f"{c}_before") for c, f in steps.items()])
    long = long.withColumns({c: F.coalesce(f.over(within), F.lit(0)) for c, f in steps.items()}).join(runs, ["conv", "run"])
    long = long.withColumns({"p1": F.col("p1").bitwiseXOR(F.col("p1_before")), "p2": F.col("p2").bitwiseXOR(F.col("p2_before")),
                             "pw": F.col("pw") + F.col("pw_before")})
    columns = ["conv", "block", "m", "w", "p1", "p2", "pw", *map(_t, range(width))]
    return short.select(*columns).union(long.select(*columns))


def _nodes(rows: DataFrame, width: int, aggregates: str) -> DataFrame:
    """All prefixes of all blocks: the aggregates, depth, words (of the last turn), before (words before it), k1, k2 (the
    node), q1, q2 (its parent)."""
    names = [_t(k) for k in range(width)]
    rolled = rows.sparkSession.sql(
        f"SELECT block, p1, p2, pw, {', '.join(names)}, grouping_id() AS gid, {aggregates} "
        f"FROM {{rows}} GROUP BY block, p1, p2, pw, ROLLUP ({', '.join(names)})", rows=rows)
    level = F.lit(width) - F.bit_count("gid")
    # a group whose last position is empty is no prefix; a later block's group without positions is the node before it
    real = F.when(level == 0, F.col("block") == 0).otherwise(
        F.coalesce(*[F.when(level == k + 1, F.col(names[k]).isNotNull()) for k in range(width)]))
    rolled = rolled.where(real).withColumn("level", level)
    last = F.coalesce(*[F.when(F.col("level") == k + 1, F.col(f"{names[k]}.words")) for k in range(width)], F.lit(0))
    ahead = sum((F.when(F.col("level") > k + 1, F.col(f"{names[k]}.words")).otherwise(0) for k in range(width)), F.col("pw"))
    out = rolled.withColumns({"depth": F.col("block") * width + F.col("level"), "words": last, "before": ahead})
    parents = [F.when(F.col("level") > k + 1, F.col(names[k])) for k in range(width)]
    for s in (1, 2):
        p = F.col(f"p{s}")
        own = p.bitwiseXOR(_hash(s, F.col("block"), [F.col(n) for n in names]))
        up = p.bitwiseXOR(_hash(s, F.col("block"), parents))
        out = out.withColumn(f"k{s}", F.when(F.col("level") > 0, own).otherwise(p)).withColumn(
            f"q{s}", F.when(F.col("level") > 1, up).when(F.col("level") == 1, p))
    return out.drop("block", "p1", "p2", "pw", "gid", "level", *names)


def _joined_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, part, ids), sorted -> (k1, k2, sha): the hash of a node's parts, joined by commas, as they stream by."""
    now, sha, done = None, None, []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                                           pa.array([d[2] for d in done], pa.string())], names=["k1", "k2", "sha"])
    for b in batches:
        for k1, k2, ids in zip(*(b.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
            if (k1, k2) == now:
                sha.update(b",")
            else:
                if now is not None:
                    done.append((*now, sha.hexdigest()))
                now, sha = (k1, k2), hashlib.sha256()
            sha.update(ids.encode())
        if done:
            yield batch()
            done = []
    if now is not None:
        done = [(*now, sha.hexdigest())]
        yield batch()


def ends(rows: DataFrame, width: int) -> DataFrame:
    """(k1, k2, sha) of each node that conversations end in."""
    last = rows.where(F.col("block") == F.floor(F.greatest(F.col("m") - 1, F.lit(0)) / width))
    key = [F.when(F.col("m") > 0, F.col(f"p{s}").bitwiseXOR(_hash(s, F.col("block"), [F.col(_t(k)) for k in range(width)]))).otherwise(F.lit(0).cast("long")).alias(f"k{s}")
           for s in (1, 2)]
    parts = last.select(*key, "conv").groupBy("k1", "k2", F.shiftright("conv", PIECE_BITS).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    return parts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part").mapInArrow(_joined_hash, "k1 long, k2 long, sha string")


def trie(conversation_turns: DataFrame, width: int = WIDTH, run: int = RUN) -> DataFrame:
    """``rebuilt`` rows (conv, pos, a, b, words, m) -> a row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and last_words, words_before (words of its last turn and before it)."""
    ship(conversation_turns.sparkSession)
    rows = stored(blocks(conversation_turns, width, run), "trie-blocks")
    first = stored(_nodes(rows, width, "min(conv) AS owner").select("owner", "depth", "words", "k1", "k2", "q1", "q2"), "trie-nodes")
    children = first.where("depth > 0").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    owned = first.join(children, ["k1", "k2"], "left").groupBy(F.col("owner").alias("conv")).agg(
        F.sum("words").alias("new_words"), F.max(F.col("n_children").isNull().cast("long")).alias("leaf"))
    facts = rows.groupBy("conv").agg(F.sum("w").alias("all_words")).join(owned, "conv", "left").select(
        "conv", "all_words", F.coalesce("new_words", F.lit(0)).alias("new_words"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    nodes = _nodes(rows.join(facts, "conv"), width,
                   "count(*) AS n_convs, min(struct(conv, all_words, new_words)) AS o, sum(all_words) AS t, sum(new_words) AS n, sum(leaf) AS n_leaves")
    saved = F.expr("(t - n_convs * before) - (n - o.new_words + o.all_words - before)")
    parent = first.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("owner").alias("parent_conv_id"))
    whole = nodes.join(children, ["k1", "k2"], "left").join(ends(rows, width), ["k1", "k2"], "left").join(parent, ["q1", "q2"], "left")
    return whole.select(
        F.col("o.conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), saved.cast("long").alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.col("words").alias("last_words"), F.col("before").alias("words_before"))
