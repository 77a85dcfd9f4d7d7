"""Prefix trie of conversations by whole-sequence collapse.

Conversations are rebuilt (a head from another one, then their own turns) and
identified as a whole: equal ones are one weighted sequence with the list of
those that end there. Only one conversation of each sequence is taken apart
into prefixes. A sequence that is a proper prefix of another is no leaf (an
anti-join finds them); everything else is a sum of weighted prefixes.

A prefix is known by its length and two 64-bit numbers: the exclusive or of a
hash of (position, role, text) over its turns. Such a sum can be cut into
blocks, so a conversation with a third of all turns is numbered, hashed and
summed in ranges and blocks, not by one task.

Shared turns are counted without joining nodes to all their members: each node
belongs to one sequence, that of its smallest member, and a sequence owns the
lower end of its path. With T the sum of what a sequence owns, a node's subtree
holds the T of all sequences through it, less what its own sequence owns above
it.

End lists are hashed in chunks of up to a thousand neighbouring ids, streamed
in order, so that a sequence with a third of all conversations is neither
gathered nor held.

Defined results: a null role or text is the empty string; a null turn comes
first; turns of equal number are ordered by role, then by the hash of role and
text; repeated rows are turns of their own; rows without conv_id belong to no
conversation; an empty table gives an empty result; further columns are not
read. Prefixes are told apart by 128 bits of hash.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import staged
from marketlake.llm.merkle import CRC32_SQL, crc32_sql
from marketlake.llm.ranks import numbered

BLOCK = 4_096          # turns summed in one window
CHUNK = 1_000          # ids in one piece of an end list

# A head comes from the conversation whose id ends in 00; it has fewer than 6 turns.
HEAD_STEP = 100
HEAD_TURNS = 6

_KEY = ["depth", "a", "b"]


def _head(conv: Column) -> Column:
    return (F.crc32(conv.cast("string")) % HEAD_TURNS).cast("long")


def own_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos from 1, n turns, digest, chars) of every turn, in order."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("at"), role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    placed = numbered(staged(rows, "turns"), ["conv"], ["at", "role", "digest"])
    return staged(placed.select("conv", (F.col("pos") + 1).alias("pos"), "n", "digest", "chars"), "placed")


def rebuild(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv) of all conversations, and their rebuilt turns (conv, pos, h1, h2, chars)."""
    conv = F.col("conv")
    firsts = own.where(F.col("pos") < HEAD_TURNS).select(F.col("conv").alias("base"), F.col("pos"), F.col("n").alias("base_n"), "digest", "chars")
    convs = staged(own.where("pos = 1").select("conv", _head(conv).alias("h"), (conv - conv % HEAD_STEP).alias("base"))
                   .join(firsts.where("pos = 1").select("base", "base_n"), "base", "left")
                   .select("conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("head")), "convs")
    # at most HEAD_STEP conversations meet fewer than HEAD_TURNS turns of their base
    heads = convs.join(firsts.drop("base_n"), "base").where("pos <= h").select("conv", "pos", "digest", "chars")
    tails = (own.where(F.col("pos") > _head(conv)).join(convs.select("conv", "h", "head"), "conv")
             .select("conv", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "digest", "chars"))
    turns = heads.unionByName(tails).select("conv", "pos", *[F.xxhash64(F.lit(n), "pos", "digest").alias(f"h{n}") for n in (1, 2)], "chars")
    return convs.select("conv"), staged(turns, "rebuilt")


def running(rows: DataFrame, key: str, pos: str, values: dict[str, tuple], inclusive: bool) -> DataFrame:
    """``rows`` plus running aggregates along ``pos`` within ``key``, by blocks of positions.

    ``values``: new column -> (aggregate function, column). Each block is one
    window; what comes before a block is the same aggregate over whole blocks.
    """
    cut = rows.withColumn("block", F.expr(f"{pos} div {BLOCK}"))
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.groupBy(key, "block").agg(*[f(c).alias(f"{name}_own") for name, (f, c) in values.items()])
    blocks = blocks.select(key, "block", *[F.coalesce(f(f"{name}_own").over(before), F.lit(0)).alias(f"{name}_before") for name, (f, _) in values.items()])
    inside = Window.partitionBy(key, "block").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = cut.withColumns({name: F.coalesce(f(c).over(inside), F.lit(0)) for name, (f, c) in values.items()}).join(blocks, [key, "block"])
    joined = {name: F.col(name).bitwiseXOR(F.col(f"{name}_before")) if f is F.bit_xor else F.col(name) + F.col(f"{name}_before")
              for name, (f, _) in values.items()}
    return out.withColumns(joined).drop("block", *[f"{name}_before" for name in values])


def _hash_ends(batches):
    """Digest of each sequence's list of ids; its pieces come one after another, in order."""
    key, state = None, None
    for batch in batches:
        done = []
        for depth, a, b, ids in zip(batch["depth"], batch["a"], batch["b"], batch["ids"]):
            if (depth, a, b) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (depth, a, b), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pd.DataFrame(done, columns=[*_KEY, "ends"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=[*_KEY, "ends"])


def collapse(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row a distinct sequence: (depth, a, b, weight, conv: its smallest conversation, ends)."""
    whole = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor("h1").alias("a"), F.bit_xor("h2").alias("b"))
    known = staged(convs.join(whole, "conv", "left").select("conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _KEY]), "wholes")
    pieces = (known.groupBy(*_KEY, F.expr(f"conv div {CHUNK}").alias("piece")).agg(F.array_sort(F.collect_list("conv")).alias("ids"))
              .select(*_KEY, "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids")))
    ends = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece").mapInPandas(_hash_ends, "depth long, a long, b long, ends string")
    sequences = known.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv"))
    return staged(sequences.join(ends, _KEY), "sequences")


def trie(sequences: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie over weighted sequences."""
    whole = sequences.select("conv", F.col("depth").alias("length"), "weight", "ends")
    taken = turns.join(whole, "conv")
    ids = running(taken, "conv", "pos", {"a": (F.bit_xor, "h1"), "b": (F.bit_xor, "h2")}, True)
    last = F.when(F.col("depth") == F.col("length"), F.col("ends"))
    below = ids.select("conv", F.col("pos").alias("depth"), "a", "b", F.col("a").bitwiseXOR(F.col("h1")).alias("up_a"),
                       F.col("b").bitwiseXOR(F.col("h2")).alias("up_b"), "chars", "length", "weight", "ends")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    tops = whole.select("conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), none.alias("up_a"), none.alias("up_b"), zero.alias("chars"),
                        "length", "weight", "ends")
    prefixes = staged(below.unionByName(tops).withColumn("ends", last), "prefixes")

    leaves = sequences.join(prefixes.where("depth < length").select(_KEY).distinct(), _KEY, "left_anti").select("conv", F.lit(1).alias("leaf"))
    nodes = staged(prefixes.groupBy(_KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("ends").alias("ends"), F.max("up_a").alias("up_a"),
        F.max("up_b").alias("up_b"), ((F.sum("weight") - 1) * F.max("chars")).alias("value")), "nodes")

    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("value").alias("owned"))
    facts = sequences.select("conv").join(owned, "conv", "left").join(leaves, "conv", "left").select(
        "conv", F.coalesce("owned", F.lit(0)).alias("owned"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    through = prefixes.select("conv", *_KEY).join(facts, "conv").groupBy(_KEY).agg(F.sum("owned").alias("through"), F.sum("leaf").alias("n_leaves"))
    above = running(nodes.select("conv_id", *_KEY, "value"), "conv_id", "depth", {"above": (F.sum, "value")}, False).select(*_KEY, "above")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    facts_of = nodes.join(through, _KEY).join(above, _KEY).join(children, _KEY, "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return facts_of.join(parents, ["depth", "up_a", "up_b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), (F.col("through") - F.col("above")).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    convs, turns = rebuild(own_turns(conversations))
    return trie(collapse(convs, turns), turns)


def op12_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    """Contract 12."""
    return prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


OP12_SQL = f"""
WITH {CRC32_SQL.strip()},
own AS (
  SELECT conv_id AS c, list([sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), length(coalesce(text, ''))::VARCHAR]
    ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS items
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.items, [])[1:o.h], o.items[o.h + 1:]) AS items
  FROM (SELECT own.*, CAST({crc32_sql("c::VARCHAR")} % 6 AS INTEGER) AS h FROM own, crc_table) o LEFT JOIN own b ON b.c = o.c - o.c % 100),
prefix AS (
  SELECT c, d, len(items) AS length, sha256(array_to_string(list_transform(items[1:d], lambda x: x[1]), ',')) AS id,
    CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(items[1:d - 1], lambda x: x[1]), ',')) END AS up,
    CASE WHEN d > 0 THEN items[d][2]::BIGINT ELSE 0 END AS chars
  FROM rebuilt, LATERAL (SELECT unnest(range(0, 1 + len(items))) AS d)),
nodes AS (
  SELECT d, id, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = length), '')) AS ends_sha256
  FROM prefix GROUP BY d, id),
childs AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.up = n.id) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.id = n.up)
SELECT a.conv_id, a.d AS depth, a.parent_conv_id, a.n_convs, a.n_children, s.n_leaves, s.saved_tokens, a.ends_sha256
FROM childs a JOIN (
  SELECT p.d, p.id, count(*) FILTER (v.n_children = 0) AS n_leaves, CAST(sum((v.n_convs - 1) * v.chars) AS BIGINT) AS saved_tokens
  FROM childs v JOIN prefix p ON p.c = v.conv_id AND p.d <= v.d GROUP BY p.d, p.id) s USING (d, id)
"""
