"""Quality rules whose cutoffs come from mergeable quantile sketches per language and source.

A sketch counts values in buckets whose bounds grow by a constant factor, so a quantile is off
by at most that factor, and sketches of parts add up to the sketch of the whole, whatever the
order. It is a plain grouped count: hot sources combine before the shuffle, and a group has at
most a few hundred buckets however many documents it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfledger.llm.common import BLANKS, documents, let, words, written

#: Relative width of a sketch bucket.
GROWTH = 1.02
#: Values below this share the bucket of zero.
LEAST = 1e-4
#: A group with fewer documents takes the merged sketch of its language, then of everything.
LEAST_GROUP = 200
#: A stretch of values is empty if its length is this many quartile distances, or the step of
#: the feature where the quartiles agree, and it holds less than SPARSE of the documents.
FENCE, SPARSE = 4.0, 0.001
#: Feature -> least length of an empty stretch, in the feature's unit.
STEPS = {
    "symbol_share": 0.1,
    "dup_line_share": 0.1,
    "repeat_share": 0.1,
    "word_length": 0.5,
}
#: Features that are unusual below a cutoff too; a low share is never unusual.
LOW = ("word_length",)


def text_measures(docs: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """Counts of each whole text: words, their characters, symbols, repeated lines and words.

    A null text counts as empty. ``n_repeat_words`` counts words that lie in a three-word
    window which occurs again. Equal windows are found by sorting 64-bit hashes whose lowest
    bits give way to the window's position; neighbours are then compared on the whole hash.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return (
        docs.select(
            *keep, t.alias("_t"), words(t).alias("_w"),
            let(lines, lambda x: F.struct(
                F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")
            )).alias("_lines"),
        )
        .select(
            *keep,
            F.size("_w").cast("long").alias("n_words"),
            F.length(F.translate("_t", BLANKS, "")).cast("long").alias("word_chars"),
            (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", "")))
            .cast("long").alias("n_symbols"),
            F.col("_lines.n").cast("long").alias("n_lines"),
            F.col("_lines.dup").cast("long").alias("n_dup_lines"),
            _repeated(F.col("_w")).cast("long").alias("n_repeat_words"),
        )
    )


def _repeated(w: Column) -> Column:
    def windows(a: Column) -> Column:
        return F.transform(
            F.slice(a, 1, F.greatest(F.size(a) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(a, i + 1), F.get(a, i + 2)),
        )

    def covered(h: Column) -> Column:
        # 2 ** ceil(log2(size + 1)): the room that positions take in a sort key
        room = F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(h).cast("long")))
        )

        def positions(s: Column) -> Column:
            at = F.transform(s, lambda x: (x.bitwiseAND(room - 1)).cast("int"))
            return let(at, lambda p: F.filter(
                p,
                lambda x, i: (F.get(h, x) == F.get(h, F.get(p, i + 1)))
                | ((i > 0) & (F.get(h, x) == F.get(h, F.get(p, F.greatest(i - 1, F.lit(0)))))),
            ))

        ordered = F.sort_array(F.transform(
            h, lambda x, i: x.bitwiseAND(-room).bitwiseOR(i.cast("long"))
        ))
        hit = let(ordered, positions)
        return F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0)
        ).otherwise(F.size(F.array_distinct(F.flatten(
            F.transform(hit, lambda p: F.array(p, p + 1, p + 2))
        ))))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(let(w, windows), covered))


def with_shares(measures: DataFrame) -> DataFrame:
    """Adds the features the cutoffs are set for."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return measures.withColumns({
        "symbol_share": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / n,
        "word_length": F.col("word_chars") / n,
    })


def bucket(value: Column) -> Column:
    """The sketch bucket of a value of at least 0."""
    return F.when(value < LEAST, F.lit(0)).otherwise(
        F.ceil(F.log(value / LEAST) / F.log(F.lit(GROWTH))).cast("int") + 1
    )


def bucket_value(index: Column) -> Column:
    """The middle of a bucket."""
    return F.when(index == 0, F.lit(0.0)).otherwise(
        LEAST * F.pow(F.lit(GROWTH), index - 1.5)
    )


def sketches(shares: DataFrame, group: list[str]) -> DataFrame:
    """One row per group, feature and bucket with its number of documents ``n``."""
    features = F.explode(F.array(*(
        F.struct(F.lit(name).alias("feature"), bucket(F.col(name)).alias("bucket"))
        for name in STEPS
    ))).alias("f")
    return (
        shares.select(*group, features)
        .groupBy(*group, "f.feature", "f.bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def cutoffs(sketch: DataFrame, group: list[str]) -> DataFrame:
    """Per group and feature: documents, quartiles and the cutoffs above and below them.

    What is usual reaches from the quartiles outwards to the first empty stretch, so the values
    of the group alone decide where it ends; the cutoff is the stretch's far end.
    """
    of = Window.partitionBy(*group, "feature")
    upto = of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.select(
        *group, "feature", "n", bucket_value(F.col("bucket")).alias("value"),
        F.sum("n").over(upto).alias("upto"), F.sum("n").over(of).alias("total"),
    )

    def quantile(quarters: int) -> Column:
        reached = F.col("upto") * 4 >= F.col("total") * quarters
        return F.min(F.when(reached, F.col("value"))).over(of)

    step = F.create_map(*(F.lit(x) for kv in STEPS.items() for x in kv))[F.col("feature")]

    def stretch(side: Column) -> Column:
        return F.greatest(step, FENCE * F.abs(side - F.col("median")))

    placed = ranked.withColumns({
        "low": quantile(1), "median": quantile(2), "quartile": quantile(3),
    }).withColumns({"up": stretch(F.col("quartile")), "down": stretch(F.col("low"))})
    above = of.orderBy(F.col("value") / F.col("up")).rangeBetween(0, 1)
    below = of.orderBy(F.col("value") / F.col("down")).rangeBetween(-1, 0)
    few = F.greatest(F.lit(1.0), SPARSE * F.col("total"))
    return (
        placed.withColumns({
            "ends": (F.sum("n").over(above) - F.col("n") < few)
            & (F.col("value") >= F.col("quartile")),
            "starts": (F.sum("n").over(below) - F.col("n") < few)
            & (F.col("value") <= F.col("low")),
        })
        .groupBy(*group, "feature").agg(
            F.max("total").alias("total"), F.max("median").alias("median"),
            F.max("quartile").alias("quartile"),
            F.min(F.when(F.col("ends"), F.col("value") + F.col("up"))).alias("cutoff"),
            F.max(F.when(F.col("starts"), F.col("value") - F.col("down"))).alias("cutoff_low"),
        )
    )


def adaptive_cutoffs(shares: DataFrame, language: str, source: str) -> DataFrame:
    """One row per (language, source) with a column per feature's cutoff, and one named
    ``<feature>_low`` for those of LOW.

    Groups under LEAST_GROUP documents use the sketch merged over their language, and where
    that is still small, over all documents. Nulls are a language or source of their own.
    """
    group = [language, source]
    fine = written(sketches(shares, group), "sketch")
    named = {name: (name, "cutoff") for name in STEPS}
    named |= {f"{name}_low": (name, "cutoff_low") for name in LOW}

    def wide(rows: DataFrame, keys: list[str], tag: str) -> DataFrame:
        found = cutoffs(rows, keys)
        return found.groupBy(*keys).agg(F.max("total").alias(f"_n{tag}"), *(
            F.max(F.when(F.col("feature") == name, F.col(side))).alias(f"_{c}{tag}")
            for c, (name, side) in named.items()
        ))

    def merged(keys: list[str]) -> DataFrame:
        return fine.groupBy(*keys, "feature", "bucket").agg(F.sum("n").alias("n"))

    own = wide(fine, group, "0")
    lang = wide(merged([language]), [language], "1").withColumnRenamed(language, "_l")
    overall = {r["feature"]: r for r in cutoffs(merged([]), []).collect()}  # 4 rows
    return (
        own.join(lang, own[language].eqNullSafe(lang["_l"]), "left")
        .select(language, source, *(
            F.when(F.col("_n0") >= LEAST_GROUP, F.col(f"_{c}0"))
            .when(F.col("_n1") >= LEAST_GROUP, F.col(f"_{c}1"))
            .otherwise(F.lit(overall[name][side] if overall else None).cast("double")).alias(c)
            for c, (name, side) in named.items()
        ))
    )


def judge(docs: DataFrame) -> DataFrame:
    """Documents with their measures, ``base_failed`` and ``kept``; one row each.

    Takes doc_id, text, lang and source; other columns are left out. A null or empty text has
    no words and fails the base rules. Cutoffs are those of the documents that pass the base
    rules. An empty table gives no rows. Repeated rows are judged
    alike, each on its own row.
    """
    measures = written(
        with_shares(text_measures(docs, "text", "doc_id", "lang", "source")), "measures"
    )
    base = (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    bounds = [*STEPS, *(f"{name}_low" for name in LOW)]
    limits = adaptive_cutoffs(measures.where(~base), "lang", "source").select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"),
        *(F.col(name).alias(f"_{name}") for name in bounds),
    )
    usual = F.lit(True)
    for name in STEPS:
        usual = usual & (F.col(name) <= F.col(f"_{name}"))
    for name in LOW:
        usual = usual & (F.col(name) >= F.col(f"_{name}_low"))
    return (
        measures.join(
            limits,
            F.col("lang").eqNullSafe(F.col("_lang"))
            & F.col("source").eqNullSafe(F.col("_source")),
            "left",
        )
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & F.coalesce(usual, F.lit(True)))
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", *STEPS,
    )
