"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: a share of the whole mix by its
weight, at most ``max_repeats`` times its own words, the excess going to the
other sources by weight. Within a source a document of length class l expects
``m = min(max_repeats, lam * (1 + l))`` copies, with l the bit length of its
word count, so longer documents are somewhat likelier; ``lam`` is solved so that
the expected words equal the target. floor(m) copies are certain. The rest,
``p = m - floor(m)``, is the inclusion probability of one more copy: documents
are ranked by (u / (1 - u)) / (p / (1 - p)) with u a hash of the row, and the
lowest are taken while their words fit what the target still lacks; later ones
of the same bin that still fit close the gap, and one more that goes beyond it
if that brings the words nearer.

Nothing is sorted globally: words are summed in bins of the rank, the bin in
which a source reaches its target is found from the sums, and only that bin's
ranks are put in order. Equal rows share one rank and count as one entry of so
many rows, of which as many are taken as fit: n of m, by their number.

Defined results: a null or empty text has size 0 and takes nothing; null
sources form one source, last in order; which of equal rows are taken is
arbitrary, how many is not, so reruns give the same rows; a table without
words has targets of 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import documents, staged, word_count
from marketlake.llm.ranks import numbered

WEIGHTS = (3, 1, 2)       # by position of the source, repeating
SHARE = 1.5               # words of the mix per word of the input
MAX_REPEATS = 2.0
BIN_ROWS = 20_000         # documents put in order in one task, on average
SEED = 20


def row_hash(ids: Column, text: Column) -> Column:
    return F.xxhash64(ids, F.xxhash64(text), F.lit(SEED))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) of a frame with one row a source: source, source_size.

    The number of rows is that of sources. Raising the common level x of
    target = min(weight * x, cap) until the targets use up the mix is a search
    over the sources ordered by cap / weight: running sums only.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", max_repeats * F.col("source_size")).withColumn("level", F.col("cap") / F.col("weight"))
    every = Window.partitionBy(F.lit(0))
    up = Window.orderBy("level", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    mix = (F.sum("source_size").over(every) * share).alias("mix")
    ranked = ranked.select("*", mix, F.sum("cap").over(up).alias("capped"), F.sum("weight").over(up).alias("weight_up"),
                           F.sum("weight").over(every).alias("weight_all"))
    # used up at the level of this row: sources up to it at their cap, the others at weight x level
    used = F.col("capped") + F.col("level") * (F.col("weight_all") - F.col("weight_up"))
    full = used <= F.col("mix")
    ranked = ranked.withColumn("full", full)
    rest = F.col("mix") - F.max(F.when(F.col("full"), F.col("capped")).otherwise(0.0)).over(every)
    weight_left = F.col("weight_all") - F.max(F.when(F.col("full"), F.col("weight_up")).otherwise(0.0)).over(every)
    open_level = rest / F.when(weight_left > 0, weight_left).otherwise(1.0)
    return ranked.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("weight") * open_level)).alias("target"))


def expected_copies(classes: DataFrame, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """Add ``copies`` (expected) to a frame of (source, class, words, target), at most 64 classes a source."""
    longest = Window.partitionBy("source").orderBy(F.col("class").desc()).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("source")
    pull = F.col("words") * (F.col("class") + 1)
    sums = classes.select("*", F.sum(max_repeats * F.col("words")).over(longest).alias("held"),
                          F.sum(pull).over(longest).alias("pull_down"), F.sum(pull).over(every).alias("pull_all"))
    # lam at which this class just reaches the limit, and the words that level takes
    at = max_repeats / (F.col("class") + 1)
    used = F.col("held") + at * (F.col("pull_all") - F.col("pull_down"))
    sums = sums.withColumn("full", used <= F.col("target"))
    rest = F.col("target") - F.max(F.when(F.col("full"), F.col("held")).otherwise(0.0)).over(every)
    left = F.col("pull_all") - F.max(F.when(F.col("full"), F.col("pull_down")).otherwise(0.0)).over(every)
    lam = rest / F.when(left > 0, left).otherwise(1.0)
    copies = F.when(F.col("full"), max_repeats).otherwise(F.least(F.lit(max_repeats), F.greatest(F.lit(0.0), lam * (F.col("class") + 1))))
    return sums.withColumn("copies", copies).drop("held", "pull_down", "pull_all", "full")


def plan_mix(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS,
             bin_rows: int = BIN_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources, classes, closing) that decide every document's copies, from one narrow stored row a document.

    ``sizes``: source, size (words), hash. ``sources``: source, source_size,
    target, cut (last rank taken in order). ``classes``: source, class, certain,
    chance. ``closing``: source, rank, n of the rows of that rank beyond the cut, whole: all of them.
    """
    rows = sizes.withColumn("class", length_class(F.col("size")))
    summed = rows.groupBy("source", "class").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    by_source = summed.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(by_source, weights, share, max_repeats)
    classes = expected_copies(join_source(summed, targets), max_repeats)
    classes = staged(classes.select(
        "source", "source_size", "target", "class", "words", "n", F.floor("copies").cast("int").alias("certain"),
        (F.col("copies") - F.floor("copies")).alias("chance")), "mix-classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    bins = max(1, math.ceil(total / bin_rows))

    open_ = ranked(rows, classes).where("chance > 0 and size > 0").withColumn("bin", F.floor(F.col("rank") * bins).cast("long"))
    lacking = classes.groupBy("source").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                                            F.sum(F.col("certain") * F.col("words")).alias("given"))
    by_bin = open_.groupBy("source", "bin").agg(F.sum("size").alias("in_bin"))
    reached = F.coalesce(F.sum("in_bin").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    need = F.col("target") - F.col("given")
    # the last bin that starts below the need is the one that meets it
    edge = (join_source(by_bin.withColumn("before", reached), lacking.select("source", (F.col("target") - F.col("given")).alias("need")))
            .where("before < need").groupBy("source").agg(F.max("bin").alias("bin"), F.max_by("before", "bin").alias("before"),
                                                          F.max("need").alias("need")))
    edge = edge.select(F.col("source").alias("e_source"), F.col("bin").alias("e_bin"), "before", "need")
    inside = open_.join(edge, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("bin") == F.col("e_bin")))
    # equal rows are one entry
    entries = inside.groupBy(F.col("e_source").alias("source"), "rank", "size").agg(
        F.count(F.lit(1)).alias("m"), F.first("before").alias("before"), F.first("need").alias("need"), (F.first("e_bin") / bins - 1e-15).alias("start"))
    order, every = Window.partitionBy("source").orderBy("rank", "size"), Window.partitionBy("source")
    steps = entries.withColumn("after", F.col("before") + F.sum(F.col("size") * F.col("m")).over(order))
    fits = F.col("after") <= F.col("need")
    steps = steps.withColumn("gap", F.col("need") - F.greatest(F.max(F.when(fits, F.col("after"))).over(every), F.col("before")))
    edges = steps.groupBy("source").agg(
        F.coalesce(F.max(F.when(fits, F.col("rank"))), F.max("start")).alias("cut"), F.max("gap").alias("gap"),
        F.array_sort(F.collect_list(F.when(~fits, F.struct("rank", "size", "m")))).alias("late"))
    edges = staged(edges.select("source", "cut", F.inline(F.array(_closing(F.col("late"), F.col("gap"))))), "mix-edges")
    closing = (edges.select("source", F.inline("picks")).groupBy("source", "rank").agg(F.sum("n").alias("n"), (F.sum("n") == F.max("m")).alias("whole")))
    return (staged(join_source(lacking.drop("given"), edges.select("source", "cut"), "left"), "mix-sources"), classes, staged(closing, "mix-closing"))


def _closing(late: Column, gap: Column) -> Column:
    """Struct with ``picks``: (rank, n, m) of entries behind the first one that does not fit, taken while they fit.

    The gap only shrinks, so an entry that is left over does not fit later either;
    the smallest of these is taken once more if it overshoots by less than the gap.
    Where one entry alone comes nearer than all this, it is the only one.
    """
    start = F.struct(gap.cast("double").alias("gap"), F.expr("cast(array() as array<struct<rank:double,n:bigint,m:bigint>>)").alias("picks"),
                     F.lit(None).cast("struct<size:bigint,rank:double,m:bigint>").alias("over"))

    def one(state, entry):
        n = F.least(entry["m"], F.floor(state["gap"] / entry["size"])).cast("long")
        picked = F.concat(state["picks"], F.array(F.struct(entry["rank"].alias("rank"), n.alias("n"), entry["m"].alias("m"))))
        left = F.struct(entry["size"].cast("long").alias("size"), entry["rank"].alias("rank"), entry["m"].alias("m"))
        return F.struct((state["gap"] - n * entry["size"]).alias("gap"), F.when(n > 0, picked).otherwise(state["picks"]).alias("picks"),
                        F.when(n < entry["m"], F.least(state["over"], left)).otherwise(state["over"]).alias("over"))

    done = F.aggregate(late, start, one)
    beyond = F.coalesce(done["over"]["size"] - done["gap"], F.lit(math.inf))
    once = F.array(F.struct(done["over"]["rank"].alias("rank"), F.lit(1).cast("long").alias("n"), done["over"]["m"].alias("m")))
    nearest = F.array_min(F.transform(late, lambda e: F.struct(F.abs(gap - e["size"]).alias("miss"), e["rank"].alias("rank"), e["m"].alias("m"))))
    alone = F.array(F.struct(nearest["rank"].alias("rank"), F.lit(1).cast("long").alias("n"), nearest["m"].alias("m")))
    return F.struct(F.when(nearest["miss"] < F.least(done["gap"], beyond), alone)
                    .when(beyond < done["gap"], F.concat(done["picks"], once)).otherwise(done["picks"]).alias("picks"))


def length_class(size: Column) -> Column:
    """Bit length of a word count: 0 for none, at most 63."""
    return F.length(F.bin(size)).cast("int") - F.when(size == 0, 1).otherwise(0)


def join_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``source`` with nulls equal."""
    renamed = right.withColumnRenamed("source", "_source")
    return left.join(renamed, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def ranked(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Add certain, chance and the Pareto rank, mapped from (0, inf) to (0, 1)."""
    per = classes.select(F.col("source").alias("_source"), F.col("class").alias("_class"), "certain", "chance")
    joined = rows.join(per, F.col("source").eqNullSafe(F.col("_source")) & (F.col("class") == F.col("_class"))).drop("_source", "_class")
    u = (F.pmod("hash", F.lit(1 << 52)) + 0.5) / float(1 << 52)
    odds = (u / (1 - u)) / (F.col("chance") / (1 - F.col("chance")))
    return joined.withColumn("rank", F.when(F.col("chance") > 0, odds / (1 + odds)))


def copies_of(rows: DataFrame, plan: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """Add ``repeats``, ``source_size`` and ``target`` to rows with source, size and hash."""
    sources, classes, closing = plan
    found = join_source(ranked(rows.withColumn("class", length_class(F.col("size"))), classes), sources, "inner")
    closers = closing.select(F.col("source").alias("_source"), F.col("rank").alias("_rank"), F.col("n").alias("_n"), "whole")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("rank") == F.col("_rank"))
    found = found.join(closers, same, "left").drop("_source", "_rank")

    def repeated(df, extra):
        repeats = F.when(F.col("size") > 0, F.col("certain") + F.when(extra, 1).otherwise(0)).otherwise(0)
        return df.withColumn("repeats", repeats.cast("int")).drop("class", "certain", "chance", "rank", "cut", "_n", "whole")

    all_or_none = repeated(found.where("whole is null or whole"), (F.col("rank") <= F.col("cut")) | F.coalesce("whole", F.lit(False)))
    if closing.where("not whole").isEmpty():
        return all_or_none
    # n of m equal rows: they are numbered, in ranges
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    tied = numbered(staged(found.where("not whole").withColumn("_key", key), "mix-tied"), ["_key", "rank"], ["hash"])
    return all_or_none.unionByName(repeated(tied, F.col("pos") < F.col("_n")).drop("_key", "pos", "n"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    def measured(payload):
        return docs.select(*payload, F.col("source").alias("source"), word_count(F.col("text")).alias("size"),
                           row_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    sizes = staged(measured([]), "mix-sizes")
    plan = plan_mix(sizes, **options)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    taken = copies_of(measured([whole]), plan)
    return taken.where("repeats > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select("row.*")


def op7_mixing(spark, folder):
    """Contract 7."""
    docs = documents(spark, folder)
    sizes = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("source"),
                               word_count(F.col("text")).alias("size"),
                               row_hash(F.col("doc_id"), F.col("text")).alias("hash")), "mix-sizes")
    return copies_of(sizes, plan_mix(sizes)).select(
        "doc_id", F.col("size").cast("long").alias("size"), F.col("source_size").cast("long").alias("source_size"),
        F.col("target").cast("double").alias("target"), (F.col("repeats") * F.col("size")).cast("long").alias("taken"),
        F.col("repeats"), F.col("source"))
