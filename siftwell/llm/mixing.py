"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is the number of copies that its documents get on average. The
whole part is allocated with certainty; the rest ``f`` is sampled, with an inclusion probability
of each document's own: ``p = f (1 + tilt (H - h))``, where ``h`` in 0..1 grows with the document's
size (in thousandths, ``h = size / (size + typical size)``) and ``H`` is the mean of ``h`` over the
source's words. So a short text is likelier to enter than a long one, which would spend more of the
target, while the expected words are exactly the target's: ``sum p size = f sum size``.

Documents enter in the order of their random odds over their inclusion odds,
``u / (1 - u) : p / (1 - p)`` for a uniform ``u``, until the sample has its fixed size. That size is
counted in words: the cut is put where the source's words come nearest to its target.

The cut is found without sorting a source: two rounds of histograms over the order (4,096 cells
each, of the odds ratio ``q`` as ``q / (1 + q)``) leave a cell with about one in sixteen million of
a source's documents, and only that cell is ranked. Everything is DataFrame functions. Windows
over sources run in one task and hold one row per source.

Edge cases: a null or empty text has size 0 and is taken 0 words; a null source is a source of its
own, ranked last; the random number depends on seed, identifier and text alone, so reruns agree
and rows equal in both share it: at the cut they are ordered by size, and rows that tie in all
enter or stay out together; a null ``doc_id`` counts as the word "null"; a table of empty texts
has targets of 0; other columns are ignored or, in ``mix``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm.frames import WORD, own_columns
from siftwell.sources.workspace import discard, materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = "mix"
#: By how much inclusion probabilities of a source differ with size, at most, as a share of their mean.
TILT = 0.5
#: Cells of a histogram round, as bits; two rounds and the rank use the top of 52 bits.
CELL_BITS = 12
RANDOM_BITS = 52


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_bits(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """52 bits, fixed by seed, identifier and text."""
    body = F.md5(F.coalesce(text, F.lit("")))
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), body)
    return F.conv(F.substring(F.md5(key), 1, RANDOM_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target``: the share of each source, none above its limit.

    Handing the excess on by weight until no target is above its limit is water filling: sources
    reach their limit in the order of limit over weight, so the level follows from running sums.
    The window runs over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((nth - 1) % len(WEIGHTS)).cast("int") + 1)
    limit = MOST * F.col("source_size")
    rows = totals.withColumn("weight", weight).withColumn("most", limit)
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rows = (
        rows.withColumn("capped", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
    )
    level = (SHARE * F.col("total") - F.col("capped")) / (F.col("weights") - F.col("gone"))
    rows = rows.withColumn("level", level)
    free = F.col("level") * F.col("weight") <= F.col("most")
    rows = rows.withColumn("fill", F.max(F.when(free, F.col("level"))).over(everything))
    filled = F.when(free, F.col("fill") * F.col("weight")).otherwise(F.col("most"))
    return rows.select(
        "source", "source_size", F.when(F.col("total") == 0, 0.0).otherwise(filled).alias("target")
    )


def sizes_of(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, bits``: all that the mix needs of a document."""
    return docs.select(
        "doc_id",
        "source",
        word_count(docs["text"]).alias("size"),
        random_bits(docs["doc_id"], docs["text"], seed).alias("bits"),
    )


def _share(size: Column, typical: Column) -> Column:
    """``h`` in thousandths: a whole number, so that sums do not depend on their order."""
    return F.floor(size * 1000 / (size + typical)).cast("long")


def _plans(sizes: DataFrame) -> DataFrame:
    """Sources with whole copies, the fraction to sample, its words, and what inclusion depends on."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = (
        source_targets(sizes)
        .withColumn("ratio", ratio)
        .withColumn("whole", F.floor("ratio"))
        .withColumn("fraction", F.col("ratio") - F.col("whole"))
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    size = F.col("size")
    typical = F.floor(F.sum(size * size) / F.greatest(F.sum("size"), F.lit(1))).cast("long") + 1
    typicals = sizes.groupBy(F.col("source").alias("t")).agg(typical.alias("typical"))
    targets = targets.join(typicals, F.col("source").eqNullSafe(F.col("t"))).drop("t")
    known = sizes.join(typicals, F.col("source").eqNullSafe(F.col("t")))
    spent = F.sum(size * _share(size, F.col("typical"))) / F.greatest(F.sum("size"), F.lit(1))
    means = known.groupBy(F.col("source").alias("t")).agg(spent.alias("mean_share"))
    return targets.join(means, F.col("source").eqNullSafe(F.col("t"))).drop("t")


def inclusion() -> Column:
    """Inclusion probability of a row of ``size`` with its source's plan."""
    f = F.col("fraction")
    tilt = F.least(F.lit(TILT), F.lit(1.0) / f - 1.0)
    apart = (F.col("mean_share") - _share(F.col("size"), F.col("typical"))) / 1000.0
    return F.when(f > 0, f * (1.0 + tilt * apart)).otherwise(0.0)


def _ranked(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows of ``source, size, bits`` with their place in the Pareto order as ``bits``.

    Random odds over inclusion odds are ``q``; its place is ``q / (1 + q)``, in 52 bits.
    """
    scale = float(1 << RANDOM_BITS)
    u = (F.col("bits") + 0.5) / scale
    p = inclusion()
    ahead, behind = u * (1.0 - p), p * (1.0 - u)
    place = F.when(p > 0, F.floor(ahead / (ahead + behind) * scale)).otherwise(scale - 1)
    used = ("fraction", "mean_share", "typical")
    facts = plans.select(F.col("source").alias("s"), *used)
    joined = rows.join(facts, F.col("source").eqNullSafe(F.col("s")))
    return joined.withColumn("bits", place.cast("long")).drop("s", *used)


def _cell(level: int) -> Column:
    return F.shiftright(F.col("bits"), RANDOM_BITS - level * CELL_BITS)


def _narrow(rows: DataFrame, plans: DataFrame, level: int) -> DataFrame:
    """Plans with the histogram cell in which each source's sample ends; cells are ranges of places."""
    inside = rows if level == 1 else rows.join(
        plans.select(F.col("source").alias("s"), "cell"),
        F.col("source").eqNullSafe(F.col("s")) & (_cell(level - 1) == F.col("cell")),
    ).drop("s", "cell")
    cells = inside.groupBy("source", _cell(level).alias("at")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("at")
    cells = cells.withColumn("passed", F.sum("words").over(upto) - F.col("words"))
    known = plans.select(
        F.col("source").alias("s"), *[c for c in plans.columns if c not in ("source", "cell")]
    )
    started = cells.join(known, F.col("source").eqNullSafe(F.col("s")))
    reached = started.where(F.col("passed") + F.col("before") <= F.col("wanted"))
    last = F.max(F.struct("at", "passed")).alias("last")
    ends = reached.groupBy("source").agg(last).select(
        F.col("source").alias("e"), F.col("last.at").alias("cell"), F.col("last.passed").alias("add")
    )
    return (
        plans.drop("cell")
        .join(ends, F.col("source").eqNullSafe(F.col("e")), "left")
        .withColumn("before", F.col("before") + F.coalesce("add", F.lit(0)))
        .withColumn("cell", F.coalesce("cell", F.lit(-1)))
        .drop("e", "add")
    )


def _cuts(sizes: DataFrame, plans: DataFrame) -> DataFrame:
    """Plans with the last place and size that enter the sample of each source."""
    plans = plans.withColumn("before", F.lit(0).cast("long"))
    plans = _narrow(sizes, plans, 1)
    plans = _narrow(sizes, plans, 2)
    key = F.struct("bits", "size")
    final = sizes.join(
        plans.select(F.col("source").alias("s"), "cell", "before", "wanted"),
        F.col("source").eqNullSafe(F.col("s")) & (_cell(2) == F.col("cell")),
    )
    steps = final.groupBy("source", "bits", "size", "before", "wanted").agg(
        F.sum("size").alias("words")
    )
    order = Window.partitionBy("source").orderBy("bits", "size")
    steps = steps.withColumn("upto", F.col("before") + F.sum("words").over(order))
    nearer = F.abs(F.col("upto") - F.col("wanted")) <= F.abs(
        F.col("upto") - F.col("words") - F.col("wanted")
    )
    cuts = steps.where(nearer & (F.col("words") > 0)).groupBy("source").agg(F.max(key).alias("cut"))
    cuts = cuts.select(F.col("source").alias("c"), "cut")
    return plans.join(cuts, F.col("source").eqNullSafe(F.col("c")), "left").drop("c")


def _learn(docs: DataFrame, seed: str) -> tuple[DataFrame, DataFrame]:
    """Stored sizes and places of all documents, and the stored cuts of all sources."""
    spark = docs.sparkSession
    sizes, sizes_path = materialize(sizes_of(docs, seed), "mix-sizes")
    plans, plans_path = materialize(_plans(sizes), "mix-plans")
    places, _ = materialize(_ranked(sizes, plans), "mix-places")
    cuts, _ = materialize(_cuts(places, plans), "mix-cuts")
    discard(spark, sizes_path)
    discard(spark, plans_path)
    return places, cuts


def _with_copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows of ``source, size`` and place ``bits`` with their source's figures and their ``copies``."""
    joined = rows.join(
        cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    )
    sampled = (F.col("fraction") > 0) & (
        (_cell(2) < F.col("cell"))
        | (
            (_cell(2) == F.col("cell"))
            & F.coalesce(F.struct("bits", "size") <= F.col("cut"), F.lit(False))
        )
    )
    return joined.withColumn("copies", (F.col("whole") + sampled.cast("long")).cast("long"))


def mix_sources(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words that the mix takes of each row."""
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return _with_copies(*_learn(docs, seed)).select("doc_id", "size", "source_size", "target", taken)


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, columns unchanged.

    A document without words is never taken.
    """
    _, cuts = _learn(docs, seed)
    rows = docs.select(
        F.struct("*").alias("d"),
        docs["source"].alias("source"),
        word_count(docs["text"]).alias("size"),
        random_bits(docs["doc_id"], docs["text"], seed).alias("bits"),
    )
    chosen = _with_copies(_ranked(rows, cuts), cuts).where("copies > 0 AND size > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth")
    return chosen.select("d", copies).select(*own_columns(docs))
