"""Prefix trie of conversations by fixed-length block hashing.

A conversation is cut into blocks of BLOCK turns.  The digest of a block is the sum of digests of its turns, each keyed
by its position, so a prefix of any length has the sum of what it holds as its digest: 128 bits in four sums that
cannot overflow.  Conversations are grouped by prefix and next block.  Where all conversations of a group go on with the same
block, its nodes are read off one of them; only where siblings diverge are turn boundaries inside the block compared,
and there once per distinct block, however many conversations have it.

Every node is named by its smallest member and its depth.  The nodes that one conversation names form a chain from its
first one down to its last turn, and a chain hangs from a node of another one.  Sums over subtrees are sums along chains
plus those of the chains below, which are added up by doubling the distance to the ancestor in each round: the number
of rounds grows with the logarithm of the number of chains on a path, not with the number of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import buckets_of, tuned

BLOCK = 4
# So many positions of one conversation are summed or ranked by one window; what lies before them comes as one row.
PIECE = 1024
FAMILY = 20
HEADS = 4
SUMS = ["s0", "s1", "s2", "s3"]
BEFORE = ["p0", "p1", "p2", "p3"]
LOW = 0xFFFFFFFF


def _summed_before(rows: DataFrame, key: str, position: str, values: list[str], later: bool = False) -> DataFrame:
    """before_<v>: sum of v over the rows of the key at smaller (later: larger) positions, 0 if there are none.

    Sums inside pieces of PIECE positions and sums of whole pieces, so that one long conversation is no single group.
    """
    end = (lambda c: F.col(c).desc()) if later else F.col
    pieced = rows.withColumn("_piece", F.floor(F.col(position) / PIECE))
    inside = Window.partitionBy(key, "_piece").orderBy(end(position)).rowsBetween(Window.unboundedPreceding, -1)
    outside = Window.partitionBy(key).orderBy(end("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieced.groupBy(key, "_piece").agg(*[F.sum(v).alias(v) for v in values])
    pieces = pieces.select(key, "_piece", *[F.sum(v).over(outside).alias(f"_o_{v}") for v in values]).where(f"_o_{values[0]} IS NOT NULL")
    summed = pieced.withColumns({f"_i_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}).join(pieces, [key, "_piece"], "left")
    return summed.select(*rows.columns, *[(F.col(f"_i_{v}") + F.coalesce(f"_o_{v}", F.lit(0))).alias(f"before_{v}") for v in values])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and words of every turn.

    Turns are ordered by number, null first; rows of one number by the digest of role and text, equal ones count each.
    Null roles and texts are empty; rows without conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), digest.alias("digest"), words.alias("words")
    )
    pieced = turns.withColumn("_piece", F.coalesce(F.shiftright("turn", 10), F.lit(-(1 << 62))))
    rank = F.row_number().over(Window.partitionBy("conv_id", "_piece").orderBy(F.col("turn").asc_nulls_first(), "digest"))
    earlier = Window.partitionBy("conv_id").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieced.groupBy("conv_id", "_piece").agg(F.count("*").alias("n"))
    offsets = offsets.select("conv_id", "_piece", F.sum("n").over(earlier).alias("offset")).where("offset IS NOT NULL")
    placed = pieced.withColumn("rank", rank).join(offsets, ["conv_id", "_piece"], "left")
    return placed.select("conv_id", (F.col("rank") + F.coalesce("offset", F.lit(0))).alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and members (conv_id, n_turns) after every conversation has got the opening of its family.

    Conversation c opens with the first h turns of conversation c - c % FAMILY, with h = crc32 of c in decimals modulo
    HEADS, and goes on after its own first h turns.  A member may be left without turns.
    """
    turns = stored(turns)
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    bases = counts.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    members = counts.withColumns({"base": base, "h": head}).join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    members = stored(members.select("conv_id", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")))
    own = turns.join(members.select("conv_id", "h", "k"), "conv_id").where("pos > h").withColumn("pos", F.expr("pos - h + k"))
    openings = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    opened = members.where("k > 0").select("conv_id", "base", "k").join(openings, "base").where("pos <= k")
    columns = ["conv_id", "pos", "digest", "words"]
    return own.select(columns).unionByName(opened.select(columns)), members.select("conv_id", "n_turns")


def _sums(columns: list[str], out: list[str], plus: list[str] | None = None) -> list[Column]:
    return [(F.col(c) + F.col(p) if plus else F.col(c)).alias(o) for c, o, p in zip(columns, out, plus or columns)]


def _blocks(turns: DataFrame) -> DataFrame:
    """A row per conversation and block: digest s*, digest p* of what comes before, and length."""
    summed = turns.groupBy("conv_id", "block").agg(*[F.sum(s).alias(s) for s in SUMS], F.count("*").alias("length"))
    placed = _summed_before(summed, "conv_id", "block", SUMS)
    return placed.select("conv_id", "block", "length", *SUMS, *_sums([f"before_{s}" for s in SUMS], BEFORE))


def _nodes(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every node but the root: conv_id (smallest member), depth, n_convs, words, digest s*, parent's digest p*."""
    variants = stored(blocks.groupBy("block", "length", *BEFORE, *SUMS).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")))
    groups = stored(variants.groupBy("block", *BEFORE).agg(F.count("*").alias("variants"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id")))
    agreed = groups.where("variants = 1").select("conv_id", "block", "n", *BEFORE, F.lit(False).alias("diverged"))
    parted = variants.join(groups.where("variants > 1").select("block", *BEFORE), ["block", *BEFORE], "left_semi")
    read = agreed.unionByName(parted.select("conv_id", "block", "n", *BEFORE, F.lit(True).alias("diverged")))
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    path = turns.withColumns({f"_i_{s}": F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in SUMS}).join(read, ["conv_id", "block"])
    path = path.withColumns({p: F.col(p) + F.col(f"_i_{s}") for s, p in zip(SUMS, BEFORE)}).withColumns({s: F.col(s) + F.col(p) for s, p in zip(SUMS, BEFORE)})
    path = stored(path.select("conv_id", F.col("pos").alias("depth"), F.col("n").alias("n_convs"), "words", *SUMS, *BEFORE, "diverged"))
    refined = path.where("diverged").groupBy("depth", *SUMS, *BEFORE).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.min("words").alias("words"))
    return path.where("NOT diverged").drop("diverged").unionByName(refined)


def _subtree_sums(chains: DataFrame, values: list[str], root: int) -> DataFrame:
    """conv_id and, for each value, its sum over a chain (conv_id, up: the chain it hangs from) and all chains below it."""
    state = stored(chains.select("conv_id", "up", *values))
    while not state.where("up IS NOT NULL").isEmpty():
        given = state.where("up IS NOT NULL").groupBy("up").agg(*[F.sum(v).alias(f"_{v}") for v in values]).withColumnRenamed("up", "conv_id")
        # The root's own pointer is known, so the many chains that reach it need no look-up.
        moved = state.where(F.col("up") != root).select("conv_id", "up").join(state.select(F.col("conv_id").alias("up"), F.col("up").alias("next")), "up")
        added = state.drop("up").join(given, "conv_id", "left").select("conv_id", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values])
        state = stored(added.join(moved.select("conv_id", F.col("next").alias("up")), "conv_id", "left"))
    return state.drop("up")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, s*, conv_id) to a row per (depth, s*); ids go into the hash as they come, none is kept."""
    names = ["depth", *SUMS]
    key, digest = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in names])
        starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
        ids = list(map(str, batch.column("conv_id").to_pylist()))
        done = []
        for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist()):
            now = tuple(keys[:, start].tolist())
            joined = ",".join(ids[start:stop]).encode()
            if now == key:
                digest.update(b"," + joined)
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = now, hashlib.sha256(joined)
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), names=[*names, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, digest.hexdigest())], names=[*names, "ends_sha256"])


def _ends_of(members: DataFrame, blocks: DataFrame) -> DataFrame:
    """depth, s*, ends_sha256 of every node at which a conversation ends.

    SHA-256 reads one byte after the other, so the ids of one node pass through one task, sorted, in bounded memory.
    """
    last = F.max(F.struct("block", (F.col("block") * BLOCK + F.col("length")).alias("depth"), *_sums(SUMS, SUMS, BEFORE))).alias("last")
    ended = blocks.groupBy("conv_id").agg(last).select("conv_id", "last.depth", *[f"last.{s}" for s in SUMS])
    none = members.where("n_turns = 0").select("conv_id", *[F.lit(0).cast("bigint").alias(c) for c in ("depth", *SUMS)])
    names = ["depth", *SUMS]
    dealt = ended.unionByName(none).repartition(buckets_of(members.sparkSession), *names).sortWithinPartitions(*names, "conv_id")
    return dealt.select(*names, "conv_id").mapInArrow(_ends, ", ".join(f"{n} bigint" for n in names) + ", ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row per distinct sequence of first turns, from the empty one on.

    turns: conv_id, pos (1, 2, .. without gaps), digest (of what the turn says), words; members: every conversation
    with its n_turns, 0 allowed.  Returns conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.  Without members there is no root and no row.
    """
    tuned(turns.sparkSession)
    members = stored(members)
    keyed = [F.xxhash64("pos", "digest"), F.xxhash64(F.lit(BLOCK), "digest", "pos")]
    parts = [half for h in keyed for half in (h.bitwiseAND(LOW), F.shiftrightunsigned(h, 32))]
    block = F.floor((F.col("pos") - 1) / BLOCK)
    turns = stored(turns.select("conv_id", "pos", block.alias("block"), "words", *[p.alias(s) for p, s in zip(parts, SUMS)]))
    blocks = stored(_blocks(turns))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    zeros = [F.lit(0).cast("bigint").alias(c) for c in ("depth", "words", *SUMS, *BEFORE)]
    tops = members.where(F.col("conv_id") == root["conv_id"]).select("conv_id", F.lit(root["n_convs"]).cast("bigint").alias("n_convs"), *zeros).limit(1)
    nodes = stored(_nodes(turns, blocks).unionByName(tops))

    saved = (F.col("n_convs") - 1) * F.col("words")
    top = F.min(F.struct("depth", *BEFORE)).alias("top")
    chains = stored(nodes.groupBy("conv_id").agg(top, F.max("depth").alias("last"), F.sum(saved).alias("saved")).select("conv_id", "top.*", "last", "saved"))
    # Chains from the root's turns on need no look-up of the node that they hang from; there can be very many.
    below = chains.where("depth > 1").withColumns({"depth": F.col("depth") - 1}).join(nodes.select("depth", *_sums(SUMS, BEFORE), F.col("conv_id").alias("up")), ["depth", *BEFORE])
    first = chains.where("depth = 1").select("conv_id", F.lit(root["conv_id"]).cast("bigint").alias("up"), F.lit(0).cast("bigint").alias("up_depth"))
    hung = stored(first.unionByName(below.select("conv_id", "up", F.col("depth").alias("up_depth"))))
    places = hung.groupBy(F.col("up").alias("conv_id"), F.col("up_depth").alias("depth")).agg(F.count("*").alias("branches"))
    chains = chains.join(hung, "conv_id", "left").join(places.select("conv_id", F.col("depth").alias("last"), "branches"), ["conv_id", "last"], "left")
    chains = stored(chains.select("conv_id", "depth", "last", "up", "up_depth", "saved", F.col("branches").isNull().cast("bigint").alias("leaves")))
    totals = _subtree_sums(chains, ["leaves", "saved"], root["conv_id"])
    under = hung.join(totals, "conv_id").groupBy(F.col("up").alias("conv_id"), F.col("up_depth").alias("depth"))
    under = under.agg(F.count("*").alias("branches"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    of_chain = chains.select("conv_id", F.col("depth").alias("_top"), "last", "up", F.col("leaves").alias("_last_leaf"))
    found = nodes.select("conv_id", "depth", "n_convs", "words", *SUMS).join(under, ["conv_id", "depth"], "left")
    values = {"branches": F.coalesce("branches", F.lit(0)), "leaves": F.coalesce("leaves", F.lit(0)), "saved": F.coalesce("saved", F.lit(0)) + saved}
    found = _summed_before(found.withColumns(values), "conv_id", "depth", ["leaves", "saved"], later=True).join(of_chain, "conv_id")
    found = found.join(_ends_of(members, blocks), ["depth", *SUMS], "left")
    return found.select(
        "conv_id", "depth",
        F.when(F.col("depth") == F.col("_top"), F.col("up")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        (F.col("branches") + (F.col("depth") < F.col("last")).cast("bigint")).alias("n_children"),
        (F.col("leaves") + F.col("before_leaves") + F.col("_last_leaf")).alias("n_leaves"),
        (F.col("saved") + F.col("before_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) after each has got the opening of its family.

    Very long conversations are cut into pieces wherever they are ordered or summed; other columns are ignored.
    """
    tuned(conversations.sparkSession)
    return prefix_trie(*rebuilt(ordered_turns(conversations)))
