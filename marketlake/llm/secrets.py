"""Secret scan with multipart credential linking, in built-in functions only.

Three base kinds are always reported. Weaker candidates (a login, a short
password, a mail address, a blob, an address of a service) are no secrets on
their own; they are reported only when a part that completes them lies in their
scope: a secret for an identifier or an endpoint, an identifier or an endpoint
for a secret, at most ``REACH`` code points away, beside it and not inside it.
The link is an interval join: both sides are laid out on cells of ``REACH`` code
points of their document, joined on (document, cell) and checked for nearness;
as a semi join, so that a crowded document makes no pairs. A weak candidate that
overlaps a base span is left out, and so is a weak secret that overlaps a weak
identifier or endpoint: it is a piece of that address.

Positions come from the lengths of the matches and of the text between them;
only these numbers are shuffled, never a text. A document is one task's work at
the most in the pass over its own matches.

Defined results: a null or empty text has no spans and the digest of the empty
string; a null doc_id is kept; equal rows are judged each by itself; an empty
table gives an empty result; positions are code points of the whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import documents, staged

REACH = 160

# The base kinds and their least lengths, in the order of the report.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"      # the same as runs of 18 or more characters
HEX = r"[0-9a-f]{16,}"             # the same as maximal runs of 16 or more characters

#: (kind, pattern, role); a look-behind ties each run to its start, so that a long run is read once.
KINDS = [
    ("assign", ASSIGN, "secret"),
    ("access", ACCESS, "identifier"),
    ("hex", HEX, "secret"),
    ("login", r"""(?i)(user_?name|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", "identifier"),
    ("mail", r"(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+", "identifier"),
    ("blob", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}", "secret"),
    ("url", r"""https?://[^\x20\x09-\x0D"'<>]+""", "endpoint"),
    ("ipv4", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "endpoint"),
    ("short", ASSIGN, "secret"),
]
BASE = 3


def _matches(text, number, pattern):
    """Array of (kind, position in the kind, length before, length, valid) of one kind's matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    kind = KINDS[number][0]

    def one(match, i):
        if kind == "assign":
            valid = F.length(F.regexp_extract(match, pattern, 2)) >= ASSIGN_VALUE
        elif kind == "short":
            valid = F.length(F.regexp_extract(match, pattern, 2)) < ASSIGN_VALUE
        elif kind == "blob":
            valid = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
        else:
            valid = F.lit(True)
        return F.struct(F.lit(number).alias("kind"), i.alias("i"), F.length(F.get(between, i)).alias("before"),
                        F.length(match).alias("length"), valid.alias("valid"))

    return F.when(text.rlike(pattern), F.transform(found, one))


def find_spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` with a column ``found``: array of (start, kind, stop), sorted, of all reported spans.

    ``kind`` is the position in ``KINDS``. Other columns stay; give narrow frames.
    """
    columns = [f"`{c}`" for c in docs.columns if c.lower() != "found"]
    text = F.coalesce(F.col("text"), F.lit(""))
    keep = F.struct(*[F.col(c) for c in columns if c.lower() != "`text`"]).alias("keep")
    marks = F.concat(*[F.coalesce(_matches(text, n, p), F.expr("array()").cast(
        "array<struct<kind:int,i:int,before:int,length:int,valid:boolean>>")) for n, (_, p, _) in enumerate(KINDS)])
    rows = staged(docs.select(keep, marks.alias("marks")).withColumn("row", F.monotonically_increasing_id()), "marks")

    each = rows.where(F.size("marks") > 0).select("row", F.inline("marks"))
    order = Window.partitionBy("row", "kind").orderBy("i")
    # the running lengths cover a kind's invalid matches too
    spans = (each.withColumn("stop", F.sum(F.col("before") + F.col("length")).over(order)).where("valid")
             .select("row", "kind", (F.col("stop") - F.col("length")).alias("start"), "stop"))
    spans = staged(spans, "spans")

    roles = F.create_map(*[F.lit(x) for n, (_, _, role) in enumerate(KINDS) for x in (n, role)])
    spans_ = spans.withColumn("secret", roles[F.col("kind")] == "secret")

    def cells(df, before, after, margin=0):
        """One row a cell that the interval, widened by ``margin``, touches."""
        low, high = F.greatest(F.lit(0), F.col(before) - margin), F.col(after) + margin - 1
        return df.withColumn("cell", F.explode(F.sequence(F.floor(low / reach), F.floor(high / reach))))

    weak = spans_.where(F.col("kind") >= BASE)
    stronger = cells(spans_, "start", "stop").select(
        F.col("row").alias("r"), F.col("cell").alias("c"), F.col("start").alias("s"), F.col("stop").alias("e"),
        (F.col("kind") < BASE).alias("is_base"), F.col("secret").alias("other_secret"))
    covered = (cells(weak, "start", "stop")
               .join(stronger, (F.col("row") == F.col("r")) & (F.col("cell") == F.col("c"))
                     & (F.col("start") < F.col("e")) & (F.col("s") < F.col("stop"))
                     & (F.col("is_base") | (F.col("secret") & ~F.col("other_secret"))), "left_semi")
               .select("row", "kind", "start").distinct())
    weak = weak.join(covered, ["row", "kind", "start"], "left_anti")
    parts = spans_.where(F.col("kind") < BASE).unionByName(weak)
    other = cells(parts, "start", "stop").select(
        F.col("row").alias("r"), F.col("cell").alias("c"), F.col("start").alias("s"), F.col("stop").alias("e"),
        F.col("secret").alias("other_secret"))
    linked = (cells(weak, "start", "stop", reach)
              .join(other, (F.col("row") == F.col("r")) & (F.col("cell") == F.col("c"))
                    & (F.col("secret") != F.col("other_secret"))
                    & ((F.col("e") <= F.col("start")) | (F.col("s") >= F.col("stop")))
                    & (F.col("start") - reach < F.col("e")) & (F.col("s") < F.col("stop") + reach), "left_semi")
              .select("row", "kind", "start", "stop").distinct())
    reported = spans.where(F.col("kind") < BASE).select("row", "kind", "start", "stop").unionByName(linked)
    per_row = reported.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop"))).alias("found"))
    none = F.expr("array()").cast("array<struct<start:bigint,kind:int,stop:bigint>>")
    return (rows.select("row", "keep").join(per_row, "row", "left")
            .select("keep.*", F.coalesce(F.col("found").cast("array<struct<start:bigint,kind:int,stop:bigint>>"), none).alias("found")))


def _joined(found):
    names = F.array(*[F.lit(k) for k, _, _ in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def op10_secrets(spark, folder):
    """Contract 10."""
    found = find_spans(documents(spark, folder).select("doc_id", "text"))
    base = F.filter("found", lambda x: x["kind"] < BASE)

    def count(number):
        return F.size(F.filter("found", lambda x: x["kind"] == number)).cast("long").alias(f"n_{KINDS[number][0]}")

    counts = [count(number) for number in range(BASE)]
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("found")).alias("spans"))
