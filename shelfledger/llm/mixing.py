"""Mixing sources to target weights by entropy balancing.

Document rates r stay as close as they can to 1 in relative entropy (bounded at 3 copies) while
the words taken from each source meet its target. The solution is an exponential tilt,
r / (3 - r) = exp(lambda * size) / 2, with one dual variable per source. The dual is convex;
Newton steps solve it, each step one grouped sum over the documents' sizes. Rates are then
rounded into 0 to 3 copies of whole documents, near each target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfledger.llm.common import documents, few_files, restored, whole_rows, word_count, written

#: Weights of the sources in code point order, repeating; null comes last.
WEIGHTS = (5.0, 2.0, 1.0)
#: No document is taken more often, and no target exceeds as many times its source.
MOST_COPIES = 3
#: Newton steps end when every source is this near its target, relative to its size.
TOLERANCE = 1e-6
MOST_STEPS = 40
#: Parts of a source's random order that are summed before the order itself is looked at.
PARTS = 4096
#: Rounds in which each source takes the largest document that still fits its remainder.
FILL_ROUNDS = 4


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source of ``sizes(source, size)``: source, source_size, target.

    A target is the source's weighted share of all words, at most MOST_COPIES times its own;
    what exceeds that is shared out again. With sources in order of cap over weight, the capped
    ones are a prefix, and the level of the others follows from sums over that prefix.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("nr") - 1, F.lit(len(WEIGHTS))) + 1)
    )
    ordered = by_source.withColumn(
        "nr", F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    ).withColumn("weight", weight).withColumn("cap", MOST_COPIES * F.col("source_size"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "nr")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onwards = rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (
        ordered.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.sum("weight").over(onwards))
    )
    # the first source whose cap is above its share of the level ends the prefix
    free = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(free, F.struct(
        (F.col("cap") / F.col("weight")).alias("ratio"), "nr", "level"
    ))).over(everything)["level"]
    return levels.withColumn("water", level).select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight")).alias("target"),
    )


def _rate(lam: Column, size: Column) -> Column:
    """The tilted rate of a document, between 0 and MOST_COPIES and 1 without tilt."""
    x = F.least(F.greatest(lam * size, F.lit(-700.0)), F.lit(700.0))
    return MOST_COPIES / (1 + (MOST_COPIES - 1) * F.exp(-x))


def balance(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """The dual variable of each source: (source, lam), by Newton steps within a bracket.

    The documents enter as a table of distinct (source, size) with their number. Sizes are
    divided by the source's root mean square size, so that steps are of one order. A source
    whose target is its cap has every document MOST_COPIES times, in the limit.
    """
    files = few_files(sizes.sparkSession)
    counts = written(
        sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
        .coalesce(files), "sizes",
    )
    scale = counts.groupBy(F.col("source").alias("_s")).agg(
        F.sqrt(F.sum(F.col("size").cast("double") * F.col("size") * F.col("n")) / F.sum("n"))
        .alias("scale"),
        F.max("size").alias("longest"),
    )
    state = written(
        targets.join(scale, targets["source"].eqNullSafe(scale["_s"])).select(
            "source", "target", "source_size", "scale",
            F.lit(0.0).alias("lam"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
            F.lit(1.0).alias("gap"),
        ).coalesce(files), "dual",
    )
    for _ in range(MOST_STEPS):
        s = state.select(*(F.col(c).alias(f"_{c}") for c in state.columns))
        z = F.col("size") / F.col("_scale")
        r = _rate(F.col("_lam"), z)
        sums = (
            counts.join(s, counts["source"].eqNullSafe(s["_source"]))
            .groupBy("source").agg(
                F.sum(F.col("n") * F.col("size") * r).alias("taken"),
                F.sum(F.col("n") * F.col("size") * z * r * (1 - r / MOST_COPIES))
                .alias("slope"),
            ).select(F.col("source").alias("_s"), "taken", "slope")
        )
        off = F.col("taken") - F.col("target")
        low = F.when(off < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - off / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low1")) & (newton < F.col("high1"))
        middle = (F.col("low1") + F.col("high1")) / 2
        # a step may grow the tilt at most fourfold: far out the curve is flat
        reach = 4 * F.abs(F.col("lam")) + 4
        bounded = F.greatest(F.least(
            F.when(inside, newton).otherwise(middle), F.col("lam") + reach
        ), F.col("lam") - reach)
        state = written(
            state.join(sums, state["source"].eqNullSafe(sums["_s"]))
            .withColumn("low1", low).withColumn("high1", high)
            .select(
                "source", "target", "source_size", "scale",
                F.when(F.abs(off) <= TOLERANCE * F.col("source_size"), F.col("lam"))
                .otherwise(bounded).alias("lam"),
                F.col("low1").alias("low"), F.col("high1").alias("high"),
                (F.abs(off) / F.col("source_size")).alias("gap"),
            ).coalesce(files), "dual",
        )
        if (state.agg(F.max("gap")).first()[0] or 0.0) <= TOLERANCE:
            break
    # rounded, so that the order in which sums were added up does not show in a rerun
    return state.select("source", (F.round("lam", 9) / F.col("scale")).alias("lam"))


def mix(docs: DataFrame) -> DataFrame:
    """Each document with how often the mix takes it.

    Takes doc_id, text and source; returns row (a number of the row), doc_id, source, size,
    source_size, target, rate, copies and taken, one row per input row. A null or empty text
    has size 0, rate 1 and no copies. A null source is the last one. Repeated rows are
    separate documents. An empty table gives no rows. Reruns over the same table agree: the
    order of rounding comes from hashes of id and text, and equal rows are interchangeable.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id", "source", word_count(t).alias("size"), F.xxhash64("doc_id", t).alias("key"),
    )
    return mix_sized(written(sized.withColumn("row", F.monotonically_increasing_id()), "sized"))


def mix_sized(sized: DataFrame) -> DataFrame:
    """``mix`` of rows that carry row, doc_id, source, size and key."""
    return taken_by(
        sized.select("row", "doc_id", "source", "size", "key"), *source_rules(sized)
    ).withColumn("taken", F.col("copies") * F.col("size"))


def source_rules(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What decides how often the mix takes each row, and is small against the rows.

    The rules (source, source_size, target, lam, cut), one a source: a row's rate follows from its
    size and lam; it is taken as often as the whole part of that, and once more when its place in
    the source's random order lies in a part up to cut. Then (row, more): the rows that are taken
    more often than that, those of the part in which the target falls and those that fill what
    remains.
    """
    targets = written(source_targets(sized), "targets")
    lam = balance(sized, targets).select(F.col("source").alias("_s"), "lam")
    goals = written(
        targets.join(lam, targets["source"].eqNullSafe(lam["_s"]), "left").drop("_s"), "goals"
    )
    rated = written(
        _rated(sized.select("row", "source", "size", "key"), goals).select(
            "row", "source", "size", "key", "target", "whole", "at", "part"
        ), "rated",
    )
    return _rounded(rated, goals)


def _rated(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``rows(source, size, key, ...)`` with all columns of their source's goal, rate, whole, and
    place and part in the source's random order where a further copy is possible."""
    g = goals.select(F.col("source").alias("_source"), *(
        c for c in goals.columns if c != "source"
    ))
    rate = F.least(F.lit(float(MOST_COPIES)), _rate(F.coalesce("lam", F.lit(0.0)), F.col("size")))
    share = F.col("rate") - F.floor("rate")
    # uniform in (0, 1), over the share: the smallest are rounded up
    u = (F.col("key").bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    order = u / F.greatest(share, F.lit(1e-12))
    return (
        rows.join(g, rows["source"].eqNullSafe(g["_source"]), "left").drop("_source")
        .withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(F.lit(1.0)))
        .withColumns({
            "whole": F.when(F.col("size") > 0, F.floor("rate")).otherwise(0).cast("int"),
            "at": F.when((F.col("size") > 0) & (share > 0), order / (1 + order)),
        })
        .withColumn("part", F.floor(F.col("at") * PARTS).cast("int"))
    )


def taken_by(rows: DataFrame, rules: DataFrame, more: DataFrame) -> DataFrame:
    """``rows(row, source, size, key, ...)`` with rate, source_size, target and copies.

    Rules and further copies are joined to the rows, so that where sources are few the rows, which
    may carry texts, stay where they are.
    """
    once_more = F.when(F.col("part") <= F.col("cut"), 1).otherwise(0)
    m = more.select(F.col("row").alias("_row"), F.col("more").alias("_more"))
    return _rated(rows, rules).join(m, F.col("row") == F.col("_row"), "left").select(
        *rows.columns, "rate", "source_size", "target",
        (F.col("whole") + once_more + F.coalesce("_more", F.lit(0))).cast("int").alias("copies"),
    )


def _rounded(rated: DataFrame, goals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rates to copies: whole parts first, then one more copy each in random order up to the
    target, then a few documents that fill what remains. Returns what ``source_rules`` does."""
    base = rated.groupBy("source").agg(
        F.max("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("whole_words")
    ).select(F.col("source").alias("_s"), (F.col("target") - F.col("whole_words")).alias("room"))
    waiting = rated.where("at is not null")
    # sums of parts first: one window over at most PARTS rows a source, however large it is
    parts = waiting.groupBy("source", "part").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("part")
    parts = parts.withColumn("upto", F.sum("words").over(
        upto.rowsBetween(Window.unboundedPreceding, 0)
    ))
    # sizes are at least 1, so sums rise: the parts that fit whole come first, then at most one more
    cuts = written(
        parts.join(base, F.col("source").eqNullSafe(F.col("_s"))).groupBy("source").agg(
            F.max(F.when(F.col("upto") <= F.col("room"), F.col("part"))).alias("cut"),
            F.min(F.when(
                (F.col("upto") > F.col("room")) & (F.col("upto") - F.col("words") < F.col("room")),
                F.struct("part", (F.col("room") - F.col("upto") + F.col("words")).alias("left")),
            )).alias("last"),
        ).select(F.col("source").alias("_s"), "cut", F.col("last.part").alias("_part"), "last.left"),
        "cuts",
    )
    rules = written(
        goals.join(cuts, goals["source"].eqNullSafe(cuts["_s"]), "left").select(
            *goals.columns, "cut"
        ), "rules",
    )
    # only the part in which the target falls needs the order of its documents
    inner = Window.partitionBy("source", "part").orderBy("at", "key", "row").rowsBetween(
        Window.unboundedPreceding, 0
    )
    crossing = written(
        waiting.join(
            cuts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_part"))
        ).withColumn("upto", F.sum("size").over(inner)).where("upto <= left").select(
            "row", F.lit(1).alias("more")
        ), "crossing",
    )
    chosen = written(
        taken_by(rated.select("row", "source", "size", "key"), rules, crossing).select(
            "row", "source", "size", "key", "target", "copies"
        ), "chosen",
    )
    fill = None
    for _ in range(FILL_ROUNDS):
        now = chosen if fill is None else _with_fill(chosen, fill)
        room = now.groupBy("source").agg(
            (F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("room")
        ).select(F.col("source").alias("_s"), "room").where("room >= 1")
        fits = now.join(room, F.col("source").eqNullSafe(F.col("_s"))).where(
            (F.col("size") > 0) & (F.col("size") <= F.col("room"))
            & (F.col("copies") < MOST_COPIES)
        )
        best = fits.groupBy("source").agg(
            F.max(F.struct("size", "key", F.col("row"))).alias("best")
        ).select("best.row", F.lit(1).alias("more"))
        fill = written(best if fill is None else fill.unionByName(best), "fill")
    return rules, written(
        crossing.unionByName(fill).groupBy("row").agg(F.sum("more").alias("more")), "more"
    )


def _with_fill(chosen: DataFrame, fill: DataFrame) -> DataFrame:
    more = fill.groupBy(F.col("row").alias("_row")).agg(F.sum("more").alias("more"))
    return chosen.join(more, F.col("row") == F.col("_row"), "left").select(
        *(c for c in chosen.columns if c != "copies"),
        (F.col("copies") + F.coalesce("more", F.lit(0))).cast("int").alias("copies"),
    )


def copies_of(docs: DataFrame) -> DataFrame:
    """Documents repeated as often as the mix takes them, with all columns as they are."""
    t = F.coalesce(F.col("text"), F.lit(""))
    numbered = written(whole_rows(
        docs, F.monotonically_increasing_id().alias("row"), "source",
        word_count(t).alias("size"), F.xxhash64("doc_id", t).alias("key"),
    ), "numbered")
    rules, more = source_rules(numbered.drop("_whole"))
    taken = taken_by(numbered, rules, more).where("copies > 0").select(
        "_whole", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    )
    return restored(taken, docs)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"),
        "rate", "copies",
    )
