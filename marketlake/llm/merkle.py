"""Merkle manifest of a dataset as a tree of SHA states.

Every row is a leaf. The leaves of a source, in the order of their ids, are cut
into runs of 16; a run's node is the hash of its children, and so on up to the
source's subroot; the subroots, in the order of the sources, give the root the
same way. A digest of 64 hexadecimal digits is one block of SHA-256, and each
node keeps a copy of the hash state in front of every child (``states``). To
check or replace a leaf, a fold resumes that state with the leaf's new digest
and the siblings to the right of it only, level by level.

Nodes are rows of one table a level; a level has a sixteenth of the rows of the
one below, and a node is built from at most 16 rows. Positions come from ranges
of (source, id), so a source with a third of all rows is spread over tasks. The
steps from a node up to the root are handed down by joins from level to level;
the last of these joins has one row for 16 leaves.

Defined results: a null field hashes as ``-``; null ids come first and are never
tampered with; rows of equal id are ordered by their leaves, equal rows get
neighbouring places and have equal leaves; a null source is a source of its
own, before all others; an empty table gives an empty result; further columns
are not hashed.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import documents, staged
from marketlake.llm.ranks import numbered
from marketlake.llm.sha import BLOCK, START, closed, resume

ARITY_BITS = 4
ARITY = 1 << ARITY_BITS
SLICE = 256            # runs folded at once

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = T.StructType([T.StructField("digest", T.StringType()), T.StructField("states", T.BinaryType())])
_PATH = {"path_kids": "string", "path_slots": "int", "path_states": "binary"}
FOLDED = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("leaf", T.StringType()), T.StructField("subroot", T.StringType()),
    T.StructField("proof_sha256", T.StringType()), T.StructField("folded_root", T.StringType())])


def hashed(values: list[Column]) -> Column:
    """Digest of a row: each value as byte count, colon and value, or ``-``."""
    def one(value):
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[one(v) for v in values]), 256)


def _children(text: str) -> np.ndarray:
    return np.frombuffer(text.encode().ljust(ARITY * BLOCK, b"0"), dtype=np.uint8).reshape(ARITY, BLOCK)


@F.pandas_udf(_NODE)
def _node(kids: pd.Series) -> pd.DataFrame:
    """A run's digest and its hash states in front of each child."""
    count = kids.str.len().to_numpy(dtype=np.int64) // BLOCK
    blocks = np.stack([_children(k) for k in kids])
    state = np.tile(START, (len(kids), 1))
    kept = np.zeros((len(kids), ARITY, 8), dtype=np.uint32)
    for slot in range(ARITY):
        kept[:, slot] = state
        rows = np.flatnonzero(count > slot)
        state[rows] = resume(state[rows], blocks[rows, slot])
    digests = closed(state, count)
    return pd.DataFrame({"digest": [d.tobytes().decode() for d in digests],
                         "states": [s[:c].tobytes() for s, c in zip(kept, count)]})


def _climb(bottom: DataFrame, most: int) -> list[DataFrame]:
    """The nodes of each level above the runs of ``bottom`` (key, pos, n, kids), as stored tables.

    ``n`` is the number of nodes of the key on that level; a key ends where it is 1.
    """
    levels, runs = [], bottom.select("key", "pos", "n", "kids")
    while most > 1:
        nodes = runs.where("n > 1").withColumn("node", _node("kids"))
        up = F.expr(f"(n + {ARITY - 1}) >> {ARITY_BITS}").alias("n")
        levels.append(staged(nodes.select("key", "pos", up, "kids", "node.digest", "node.states"), "nodes"))
        most = (most + ARITY - 1) >> ARITY_BITS
        runs = _runs(levels[-1].select("key", "pos", "n", "digest"), [])
    return levels


def _runs(nodes: DataFrame, more: list[str]) -> DataFrame:
    """Nodes in runs of 16: their digests one after another, other columns as arrays."""
    run = F.shiftright("pos", ARITY_BITS).alias("pos")
    each = F.array_sort(F.collect_list(F.struct("pos", "digest", *more)))
    return (nodes.groupBy("key", run, "n").agg(each.alias("all"))
            .select("key", "pos", "n", F.array_join("all.digest", "").alias("kids"), *[F.col(f"all.{c}").alias(c) for c in more]))


def _ends(bottom: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(key, digest) of what remains of each key."""
    ends = bottom.where("n = 1").select("key", F.col("kids").alias("digest"))
    for level in levels:
        ends = ends.unionByName(level.where("n = 1").select("key", "digest"))
    return ends


def _stepped(nodes: DataFrame, up: DataFrame | None, above: DataFrame | None) -> DataFrame:
    """``nodes`` of one level plus the path columns: the steps from each one up to the root.

    ``up`` is the level above with its own paths, ``above`` the paths of each
    key's last node, which is the root itself without it. A step is a run's
    children, the slot in it and the hash state in front of that slot.
    """
    along = list(_PATH) if above is None else [c for c in above.columns if c != "key"]
    ends = nodes.where("n = 1")
    if above is None:
        ends = ends.withColumns({c: F.expr(f"cast(array() as array<{kind}>)") for c, kind in _PATH.items()})
    else:
        ends = ends.join(above, "key")
    if up is None:
        return ends
    parents = up.select("key", F.col("pos").alias("run"), F.col("kids").alias("up_kids"), F.col("states").alias("up_states"), *along)
    slot = F.expr(f"cast(pos & {ARITY - 1} as int)")
    step = {"path_kids": F.array("up_kids"), "path_slots": F.array(slot), "path_states": F.array(F.substring("up_states", slot * 32 + 1, F.lit(32)))}
    inner = (nodes.where("n > 1").withColumn("run", F.shiftright("pos", ARITY_BITS)).join(parents, ["key", "run"])
             .withColumns({c: F.concat(first, c) for c, first in step.items()}))
    return ends.unionByName(inner.select(ends.columns))


def _paths(levels: list[DataFrame], above: DataFrame | None) -> DataFrame | None:
    """The lowest of ``levels`` with the path of each node."""
    up = None
    for level in reversed(levels):
        up = _stepped(level, up, above)
    return up


@dataclass
class Manifest:
    """Stored tables: ``runs`` of 16 leaves, the nodes above them by level, the subroots, the nodes above those; the root."""

    runs: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    tops: list[DataFrame]
    root: str | None


def build_manifest(leaves: DataFrame) -> Manifest:
    """The tree over ``leaves``: (source, id long, leaf hexadecimal digest, alt: a replacement or null)."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = staged(leaves.select(key.alias("key"), "id", "leaf", "alt"), "leaves")
    placed = numbered(rows, ["key"], ["id", "leaf"]).withColumnRenamed("leaf", "digest")
    runs = staged(_runs(placed, ["id", "alt"]), "runs")
    levels = _climb(runs, runs.agg(F.max("n")).head()[0] or 0)

    ends = staged(_ends(runs, levels).withColumn("tree", F.lit("")), "ends")
    subroots = staged(numbered(ends, ["tree"], ["key"]).select(F.col("tree").alias("key"), "pos", "n", F.col("key").alias("source_key"), "digest"), "subroots")
    top = _runs(subroots, [])
    tops = _climb(top, subroots.agg(F.max("n")).head()[0] or 0)
    last = _ends(top, tops).select("digest").head()
    return Manifest(runs, levels, subroots, tops, last["digest"] if last else None)


def _resumed(states, leaf, slots, kids, counts):
    """Digests of parents: the state in front of the slot, then the new child, then the siblings to its right.

    One row each: state (8 words), child digest (64 bytes), slot, the run's
    children (16 x 64 bytes) and their number.
    """
    states = resume(states, leaf)
    for right in range(1, ARITY):
        rows = np.flatnonzero(slots + right < counts)
        if not len(rows):
            break
        states[rows] = resume(states[rows], kids[rows, slots[rows] + right])
    return closed(states, counts)


def _others(kids: str, slot: int) -> str:
    return kids[:slot * BLOCK] + kids[(slot + 1) * BLOCK:]


def _fold_runs(runs: pd.DataFrame) -> list[tuple]:
    """(leaf, proof digest, folded root) of every leaf of the runs, in order."""
    count = (runs["kids"].str.len() // BLOCK).to_numpy(dtype=np.int64)
    row = np.repeat(np.arange(len(runs)), count)
    slot = np.concatenate([np.arange(c) for c in count])
    kids = np.stack([_children(k) for k in runs["kids"]])
    leaf = kids[row, slot]
    new = leaf.copy()
    alt = [a for alts in runs["alts"] for a in alts]
    for i, a in enumerate(alt):
        if a is not None:
            new[i] = np.frombuffer(a.encode(), dtype=np.uint8)
    # the run of leaves itself is the first step, unless the source has one leaf only
    held = np.flatnonzero(runs["states"].notna().to_numpy()[row])
    if len(held):
        states = np.zeros((len(runs), ARITY, 8), dtype=np.uint32)
        for i, s in enumerate(runs["states"]):
            if s is not None:
                states[i, :count[i]] = np.frombuffer(s, dtype=np.uint32).reshape(-1, 8)
        new[held] = _resumed(states[row[held], slot[held]], new[held], slot[held], kids[row[held]], count[row[held]])
    steps = np.array([len(p) for p in runs["path_slots"]])
    for step in range(int(steps.max(initial=0))):
        has = np.flatnonzero(steps > step)
        index = np.zeros(len(runs), dtype=np.int64)
        index[has] = np.arange(len(has))
        up = [runs["path_kids"].iat[i][step] for i in has]
        at = np.array([runs["path_slots"].iat[i][step] for i in has], dtype=np.int64)
        state = np.stack([np.frombuffer(runs["path_states"].iat[i][step], dtype=np.uint32) for i in has])
        above = np.stack([_children(k) for k in up])
        size = np.array([len(k) // BLOCK for k in up], dtype=np.int64)
        mine = np.flatnonzero(steps[row] > step)
        i = index[row[mine]]
        new[mine] = _resumed(state[i], new[mine], at[i], above[i], size[i])
    beside = ["".join(_others(k, s) for k, s in zip(ks, ss)) for ks, ss in zip(runs["path_kids"], runs["path_slots"])]
    out = []
    texts = runs["kids"].tolist()
    for i, (r, s) in enumerate(zip(row.tolist(), slot.tolist())):
        proof = hashlib.sha256((_others(texts[r], s) + beside[r]).encode()).hexdigest()
        out.append((texts[r][s * BLOCK:(s + 1) * BLOCK], proof, new[i].tobytes().decode()))
    return out


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in FOLDED]
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            part = batch.slice(begin, SLICE)
            ids = part.column("ids").flatten()
            runs = part.drop_columns(["ids"]).to_pandas()
            leaf, proof, root = zip(*_fold_runs(runs))
            subroot = np.repeat(runs["subroot"].to_numpy(), [len(a) for a in runs["alts"]])
            yield pa.RecordBatch.from_arrays([ids, pa.array(leaf), pa.array(subroot, type=pa.string()), pa.array(proof), pa.array(root)], names=names)


def fold(manifest: Manifest) -> DataFrame:
    """Each leaf's proof and the root folded from its replacement (``alt``) or itself."""
    own = list(_PATH)
    above = _stepped(manifest.subroots, _paths(manifest.tops, None), None).select(
        F.col("source_key").alias("key"), F.col("digest").alias("subroot"), *own)
    runs = manifest.runs.select("key", "pos", "n", "kids", F.col("id").alias("ids"), F.col("alt").alias("alts"))
    none = F.lit(None).cast("binary").alias("states")
    columns = ["ids", "kids", "alts", "states", "subroot", *own]
    rows = runs.where("n = 1").join(above, "key").withColumn("states", none).select(columns)
    if manifest.levels:
        lowest = _paths(manifest.levels, above).drop("n", "kids")
        rows = rows.unionByName(runs.where("n > 1").join(lowest, ["key", "pos"]).select(columns))
    return rows.mapInArrow(_fold, FOLDED)


def op11_merkle(spark, folder):
    """Contract 11."""
    docs = documents(spark, folder)
    doc_id, text = F.col("doc_id"), F.col("text")
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    fields = [F.col(c) for c in FIELDS]
    tampered = F.when(F.crc32(doc_id.cast("string")) % 5 == 0, hashed([*fields[:-1], lowered]))
    manifest = build_manifest(docs.select("source", doc_id.cast("long").alias("id"), hashed(fields).alias("leaf"), tampered.alias("alt")))
    root = F.lit(manifest.root).cast("string")
    return fold(manifest).select(F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                                 (F.col("folded_root") == root).alias("verified"))


# Fixed value: the polynomial of CRC-32.
CRC32_SQL = """
crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1))) ORDER BY i) AS crc FROM range(256) t(i))"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text; ``crc_table`` must be joined."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 1 + length({text})), "
            f"lambda j: ord(substring({text}, j, 1))::BIGINT)), lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])))")


def _field_sql(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


OP11_SQL = f"""
WITH RECURSIVE {CRC32_SQL},
docs AS (
  SELECT doc_id, source, sha256({" || ".join(_field_sql(c) for c in FIELDS)}) AS leaf,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 5 = 0
         THEN sha256({" || ".join(_field_sql(c) for c in FIELDS[:-1])} || {_field_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS alt
  FROM documents, crc_table),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM docs),
nodes AS (
  SELECT source, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 16),
subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 16),
heights AS (SELECT source, max(level) AS height FROM nodes GROUP BY source),
-- one tree for all: a level, the place on it and the run above; the levels over the subroots come after a source's own
walk AS (
  SELECT p.doc_id, p.source, p.leaf, p.pos AS at, p.n, 0 AS step, coalesce(p.alt, p.leaf) AS digest, '' AS beside, false AS over
  FROM placed p
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, any_value(w.at // 16), any_value((w.n + 15) // 16), w.step + 1,
    sha256(string_agg(CASE WHEN x.pos = w.at THEN w.digest ELSE x.digest END, '' ORDER BY x.pos)),
    any_value(w.beside) || coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos <> w.at), ''), false
  FROM walk w JOIN nodes x ON x.source IS NOT DISTINCT FROM w.source AND x.level = w.step AND x.pos // 16 = w.at // 16
  WHERE w.n > 1 GROUP BY w.doc_id, w.source, w.leaf, w.step),
up AS (
  SELECT w.doc_id, w.source, w.leaf, s.digest AS subroot, s.pos AS at, s.n, 0 AS step, w.digest, w.beside
  FROM walk w JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source WHERE w.n = 1
  UNION ALL
  SELECT u.doc_id, u.source, u.leaf, any_value(u.subroot), any_value(u.at // 16), any_value((u.n + 15) // 16), u.step + 1,
    sha256(string_agg(CASE WHEN x.pos = u.at THEN u.digest ELSE x.digest END, '' ORDER BY x.pos)),
    any_value(u.beside) || coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos <> u.at), '')
  FROM up u JOIN tops x ON x.level = u.step AND x.pos // 16 = u.at // 16
  WHERE u.n > 1 GROUP BY u.doc_id, u.source, u.leaf, u.step)
SELECT u.doc_id, u.leaf, u.subroot, t.digest AS root, sha256(u.beside) AS proof_sha256, u.digest AS folded_root, u.digest = t.digest AS verified
FROM up u, (SELECT digest FROM tops WHERE n = 1) t WHERE u.n = 1
"""
