"""Prefix trie of conversations by fixed-length block hashing.

Conversations are first rebuilt (``rebuild``): a conversation starts with the
first h turns of the conversation that leads its id range of ``GROUP`` ids
and goes on with its own turns after the h-th, h being crc32(decimal id)
mod ``MAX_SHARED``.

``trie`` then groups sequences by successive blocks of ``BLOCK`` turns:

1. A turn is a 128-bit hash of its depth, role and text; a block's digest is
   the xor over its turns, a prefix's the running xor over its blocks.
2. Conversations that agree on all earlier blocks are a block group.  If all
   of them agree on the next block too, its turns have the group's members
   each and one *cell* stands for them.  Only where siblings diverge (or a
   sequence ends inside the block) are the block's turns hashed one by one
   and every turn is a cell of its own.
3. A node belongs to its least member, and a conversation owns the nodes
   from some depth to its end, a chain.  So sums over a subtree are sums over
   the node's members of what each owns: no node is ever expanded to its
   ancestors, however deep the trie is.

Everything is aggregated by cell or by conversation with map-side partial
results.  A hot first turn is one skewed key of narrow joins, which adaptive
execution splits; a very long conversation is scanned in ranges.  The ids of
the conversations that end at a node are joined into bounded pieces before
they meet, and one pass of constant memory hashes the pieces in order.

Edge cases: rows without a conv_id belong to no conversation and are left
out; null role or text is empty; turns go by number (null first), ties by
role and text, repeated rows are turns of their own; an empty table has no
node, not even a root; extra columns are ignored."""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.order import SEG, attach, local_window, pin, position, prepare, running, running_sums, seg_window
from .common import stored

BLOCK = 4
GROUP, MAX_SHARED = 100, 6
PIECE = 4096
_CELL = ["d0", "ha", "hb"]
_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, " \
        "saved_tokens bigint, ends_sha256 string"


def rebuild(conversations: DataFrame, conv="conv_id", turn="turn", role="role", text="text"):
    """(turns, ids): the rebuilt turns (c, d from 1, role, text) and every conversation id (c, turnless ones too)."""
    t = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("c"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # the helper sorts nulls last; the flag puts a null turn first
    t = t.withColumn("known", F.col("turn").isNotNull())
    t = position(t, ["c"], ["known", "turn", "role", "text"], pos="at", total="m").select("c", "at", "m", "role", "text")
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(MAX_SHARED)).cast("int")
    ids = t.groupBy("c").agg(F.max("m").alias("m")) \
        .select("c", "m", h.alias("h"), (F.col("c") - F.col("c") % GROUP).alias("lead"))
    heads = t.where((F.col("c") % GROUP == 0) & (F.col("at") < MAX_SHARED)) \
        .select(F.col("c").alias("lead"), "at", F.col("m").alias("lead_m"), "role", "text")
    first = ids.join(heads, "lead").where("at <= h").select("c", F.col("at").alias("d"), "role", "text")
    size = heads.where("at = 1").select("lead", "lead_m")
    shared = ids.join(size, "lead", "left") \
        .select("c", "h", F.least("h", F.coalesce("lead_m", F.lit(0))).alias("taken"))
    own = t.where(F.col("at") > 0).join(shared, "c").where("at > h") \
        .select("c", (F.col("at") - F.col("h") + F.col("taken")).alias("d"), "role", "text")
    return first.union(own), ids.select("c")


def _running_xor(df, keys, order, cols):
    """Inclusive running xor per key, in ranges if a key is hot."""
    resolved, d = prepare(df, keys, order)
    w = running(local_window(keys, order))
    d = d.withColumns({f"run_{c}": F.bit_xor(c).over(w) for c in cols})
    if resolved == "window":
        return d.drop(SEG)
    d = pin(d)
    before = seg_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    s = d.groupBy(*keys, SEG).agg(*[F.bit_xor(c).alias(c) for c in cols])
    s = s.select(*keys, SEG, *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"car_{c}") for c in cols])
    d = attach(d, s, keys)
    return d.withColumns({f"run_{c}": F.col(f"run_{c}").bitwiseXOR(F.col(f"car_{c}")) for c in cols}) \
        .drop(SEG, *[f"car_{c}" for c in cols])


def _cells(turns: DataFrame, block: int) -> DataFrame:
    """Memberships (c, d0, d1, ha, hb, single): each conversation's cells."""
    blocks = turns.groupBy("c", "k").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
                                         F.count("*").cast("int").alias("nt"))
    blocks = _running_xor(blocks, ["c"], ["k"], ["a", "b"])
    blocks = blocks.select("c", "k", "nt", "a", "b", F.col("run_a").bitwiseXOR(F.col("a")).alias("pa"),
                           F.col("run_b").bitwiseXOR(F.col("b")).alias("pb"))
    blocks = stored(blocks, "trie-blocks")
    digest = F.struct("a", "b", "nt")
    groups = blocks.groupBy("k", "pa", "pb").agg(F.min(digest).alias("lo"), F.max(digest).alias("hi")) \
        .select("k", "pa", "pb", (F.col("lo") == F.col("hi")).alias("single"))
    blocks = blocks.join(groups, ["k", "pa", "pb"])
    whole = blocks.where("single").select(
        "c", (F.col("k") * block + 1).alias("d0"), (F.col("k") * block + F.col("nt")).alias("d1"),
        F.col("pa").bitwiseXOR(F.col("a")).alias("ha"), F.col("pb").bitwiseXOR(F.col("b")).alias("hb"))
    apart = turns.join(blocks.where("not single").select("c", "k", "pa", "pb"), ["c", "k"])
    w = Window.partitionBy("c", "k").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)  # at most `block` rows
    one = apart.select("c", F.col("d").alias("d0"), F.col("d").alias("d1"),
                       F.col("pa").bitwiseXOR(F.bit_xor("a").over(w)).alias("ha"),
                       F.col("pb").bitwiseXOR(F.bit_xor("b").over(w)).alias("hb"))
    return stored(whole.union(one), "trie-members")


def _hash_ends(pieces: DataFrame) -> DataFrame:
    """(d0, ha, hb, ends): SHA-256 over each cell's pieces in id order, streamed."""
    def run(batches):
        key, h = None, None
        for b in batches:
            out = []
            for d0, ha, hb, ids in zip(*[b.column(i).to_pylist() for i in (0, 1, 2, 4)], strict=True):
                if (d0, ha, hb) != key:
                    if key is not None:
                        out.append((*key, h.hexdigest()))
                    key, h = (d0, ha, hb), hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=[*_CELL, "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, h.hexdigest())], names=[*_CELL, "ends"])

    return pieces.repartition(*_CELL).sortWithinPartitions(*_CELL, "piece") \
        .mapInArrow(run, "d0 bigint, ha bigint, hb bigint, ends string")


def trie(turns: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie over rebuilt turns (c, d, role, text) of the conversations ``ids`` (c):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    h = lambda seed: F.xxhash64(F.lit(seed), "d", "role", F.lit("\x00"), "text")
    turns = stored(turns.select(F.col("c"), F.col("d").cast("bigint").alias("d"),
                                F.floor((F.col("d") - 1) / block).cast("bigint").alias("k"), h("first").alias("a"),
                                h("second").alias("b"), F.char_length("text").cast("bigint").alias("len")), "trie-turns")
    members = _cells(turns, block)
    cells = stored(members.groupBy(*_CELL).agg(F.min("c").alias("o"), F.count("*").alias("n"), F.max("d1").alias("d1")),
                   "trie-cells")
    # chains: where a conversation's own nodes start, and the node above
    chains = cells.groupBy("o").agg(F.min("d0").alias("s"))
    above = members.join(chains, (F.col("c") == F.col("o")) & (F.col("d1") == F.col("s") - 1)) \
        .select(F.col("o").alias("chain"), "s", *_CELL) \
        .join(cells.select(*_CELL, F.col("o").alias("p")), _CELL).select("chain", "p")
    chains = stored(chains.join(above.withColumnRenamed("chain", "o"), "o", "left"), "trie-chains")
    hung = chains.where("p is not null").groupBy("p", (F.col("s") - 1).alias("at")).agg(F.count("*").alias("hung"))
    # per conversation: length, all and own code points, whether it owns a leaf
    summed = running_sums(turns.select("c", "d", "len"), ["c"], ["d"], ["len"])
    summed = stored(summed.select("c", "d", "len", (F.col("cum_len") - F.col("len")).alias("before")), "trie-sums")
    facts = summed.join(chains.select(F.col("o").alias("c"), "s"), "c", "left") \
        .groupBy("c").agg(F.max("d").alias("m"), F.sum("len").alias("total"),
                          F.sum(F.when(F.col("d") >= F.col("s"), F.col("len")).otherwise(0)).alias("own"),
                          F.any_value("s").alias("s"))
    facts = facts.join(hung.select(F.col("p").alias("c"), F.col("at").alias("m"), "hung"), ["c", "m"], "left")
    facts = stored(facts.select("c", "m", (F.col("total") - F.col("own")).alias("x"),
                                (F.col("s").isNotNull() & F.col("hung").isNull()).cast("bigint").alias("leaf")), "trie-facts")
    sums = members.join(facts, "c").groupBy(*_CELL).agg(F.sum("x").alias("x"), F.sum("leaf").alias("leaves"))
    # ids of the conversations that end at a cell, in bounded pieces
    piece = F.floor(F.col("c") / PIECE)
    ends = members.join(facts.select("c", "m"), "c").where("d1 = m") \
        .groupBy(*_CELL, piece.alias("piece")) \
        .agg(F.array_join(F.sort_array(F.collect_list("c")), ",").alias("ids"))
    nothing = hashlib.sha256(b"").hexdigest()
    cells = cells.join(sums, _CELL).join(_hash_ends(ends), _CELL, "left") \
        .join(facts.select(F.col("c").alias("o"), "m", F.col("x").alias("x_o")), "o")
    nodes = cells.select("*", F.explode(F.sequence("d0", "d1")).alias("d"))
    nodes = nodes.join(summed.select(F.col("c").alias("o"), "d", "before"), ["o", "d"]) \
        .join(chains.select("o", "s", "p"), "o") \
        .join(hung.select(F.col("p").alias("o"), F.col("at").alias("d"), "hung"), ["o", "d"], "left")
    root = _root(ids, facts, chains, nothing)
    least = root[0][0] if root else None
    parent = F.when(F.col("d") > F.col("s"), F.col("o")).otherwise(F.coalesce("p", F.lit(least).cast("bigint")))
    kids = F.coalesce("hung", F.lit(0)) + F.when(F.col("d") < F.col("m"), 1).otherwise(0)
    saved = F.col("x") - F.col("x_o") - (F.col("n") - 1) * F.col("before")
    nodes = nodes.select(
        F.col("o").alias("conv_id"), F.col("d").alias("depth"), parent.alias("parent_conv_id"),
        F.col("n").alias("n_convs"), kids.cast("bigint").alias("n_children"), F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce(F.when(F.col("d") == F.col("d1"), F.col("ends")), F.lit(nothing)).alias("ends_sha256"))
    return turns.sparkSession.createDataFrame(root, _NODE).union(nodes)


def _root(ids, facts, chains, nothing) -> list[tuple]:
    """The root's row (none without conversations): a few totals, and the turnless ones' ids hashed like any other."""
    every = ids.agg(F.min("c").alias("c"), F.count("*").alias("n")).first()
    if not every["n"]:
        return []
    kids = chains.where("s = 1").count()
    sums = facts.agg(F.sum("leaf").alias("leaves"), F.sum("x").alias("x")).first()
    zero = F.lit(0).cast("bigint")
    pieces = ids.join(facts.select("c"), "c", "left_anti") \
        .groupBy(zero.alias("d0"), zero.alias("ha"), zero.alias("hb"), F.floor(F.col("c") / PIECE).alias("piece")) \
        .agg(F.array_join(F.sort_array(F.collect_list("c")), ",").alias("ids"))
    ends = _hash_ends(pieces).first()
    return [(every["c"], 0, None, every["n"], kids, sums["leaves"] if kids else 1, sums["x"] or 0,
             ends["ends"] if ends else nothing)]


def conversation_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuild(conversations), block=block)
