"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

A paragraph is hashed to a wide vector of longs, and a document's vector is the sum of its
paragraphs' vectors modulo 2 ** 60. Equal multisets of paragraphs have equal sums in any order;
adding or taking away a paragraph adds or subtracts its vector. The vector has three parts:

* DIGEST longs hashed from the whole paragraph: equality,
* 2 x 30 longs of two 30-bit counters each. Every clause of the paragraph adds its hash bits,
  one to each counter, so the counters of two documents are as alike as the clauses they share.
  A text of the longest that Spark holds, 2 ** 31 bytes, has fewer than 2 ** 30 clauses, so no
  counter of a text wraps,
* the number of clauses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfledger.llm.common import BLANKS, documents, let, written

#: Sums are taken modulo this.
MODULUS = 1 << 60
FIELD, FIELDS = 30, 2
FIELD_BITS = sum(1 << (FIELD * i) for i in range(FIELDS))
DIGEST = 4
SEEDS = (11, 29)
#: A clause ends at one of these; a paragraph ends at a line break.
CLAUSE_END = r"[.!?,;:|\n]+"
#: Ranges of doc_id that are put in order separately.
RANGES = 64


def _total(values: Column) -> Column:
    """The sum of longs in [0, MODULUS) modulo MODULUS."""
    return F.aggregate(
        values, F.lit(0).cast("long"), lambda a, x: (a + x).bitwiseAND(MODULUS - 1)
    )


def vector(text: Column) -> Column:
    """The document vector as an array of longs; a null or empty text has the zero vector."""
    t = F.coalesce(text, F.lit(""))
    paragraphs = F.filter(F.split(t, "\n"), lambda p: F.btrim(p, F.lit(BLANKS)) != "")
    clauses = F.filter(
        F.transform(F.split(t, CLAUSE_END), lambda c: F.btrim(c, F.lit(BLANKS))),
        lambda c: c != "",
    )

    def digests(ps: Column) -> list[Column]:
        return [
            _total(F.transform(
                ps, lambda p: F.xxhash64(F.lit(s), p).bitwiseAND(MODULUS - 1)
            )) for s in range(DIGEST)
        ]

    def counters(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(FIELD - 1)),
            lambda j: F.aggregate(
                hashes, F.lit(0).cast("long"),
                lambda a, h: (
                    a + F.call_function("shiftright", h, j).bitwiseAND(FIELD_BITS)
                ).bitwiseAND(MODULUS - 1),
            ),
        )

    def clause_part(cs: Column) -> Column:
        return F.concat(
            *(let(
                F.transform(cs, lambda c: F.xxhash64(F.lit(s), c).bitwiseAND(MODULUS - 1)),
                counters,
            ) for s in SEEDS),
            F.array(F.size(cs).cast("long")),
        )

    return F.concat(let(paragraphs, lambda ps: F.array(*digests(ps))), let(clauses, clause_part))


def added(a: Column, b: Column) -> Column:
    """The vector of both documents' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(MODULUS - 1))


def removed(a: Column, b: Column) -> Column:
    """The vector left when the paragraphs of ``b`` are taken out of ``a``."""
    return F.zip_with(a, b, lambda x, y: (x + (MODULUS - y)).bitwiseAND(MODULUS - 1))


def fingerprint(vec: Column) -> Column:
    """A vector as text: 15 hex digits for each long."""
    return F.array_join(F.transform(vec, lambda x: F.lower(F.lpad(F.hex(x), 15, "0"))), "")


def _spread(vec: Column) -> Column:
    """Counters minus half the clauses: the signed sums of random plus and minus ones."""
    n = F.element_at(vec, -1)
    fields = F.flatten(F.transform(
        F.slice(vec, DIGEST + 1, FIELD * len(SEEDS)),
        lambda x: F.array(*(
            F.shiftright(x, FIELD * i).bitwiseAND((1 << FIELD) - 1) for i in range(FIELDS)
        )),
    ))
    return F.transform(fields, lambda c: (2 * c - n).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """How alike two documents are by their vectors, from 0 to 1; equal vectors give 1.

    The inner product of the signed sums estimates the clauses in common; it is taken relative
    to the larger document.
    """
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    def of(x: Column, y: Column) -> Column:
        whole = F.greatest(dot(x, x), dot(y, y))
        return F.when(whole > 0, F.greatest(
            F.lit(0.0), F.least(F.lit(1.0), dot(x, y) / whole)
        )).otherwise(0.0)

    return F.when(a == b, F.lit(1.0)).otherwise(
        let(_spread(a), lambda x: let(_spread(b), lambda y: of(x, y)))
    )


def following(docs: DataFrame) -> DataFrame:
    """(id, blank, need, next_id, next_blank, next_hash): each distinct id with the next lower.

    After the lowest comes the highest; ``blank`` marks the missing id, the lowest of all. Ids
    are put in order in ranges between quantiles, and the ends of the ranges are joined up; a
    range is a few longs per id, and equal ids are one row. ``next_hash`` names the row of the
    next id that is taken: the least text hash. ``need`` is the most that a row of the id takes.
    """
    ids = written(
        docs.groupBy("id", "blank").agg(
            F.min(F.xxhash64("text")).alias("hash"),
            F.max(F.floor(F.length("text") / 3)).cast("int").alias("need"),
        ), "ids",
    )
    cuts = ids.where("not blank").agg(F.percentile_approx(
        "id", [i / RANGES for i in range(1, RANGES)], 10000
    )).first()[0]
    part = F.when(F.col("blank"), -1).otherwise(F.size(F.filter(
        F.array(*(F.lit(c) for c in sorted(set(cuts or [])))).cast("array<long>"),
        lambda c: c < F.col("id"),
    )))
    parted = ids.withColumn("part", part)
    name = F.struct("id", "blank", "hash")
    down = Window.partitionBy("part").orderBy(F.desc("id"))
    inner = parted.select("part", "id", "blank", "need", F.lead(name).over(down).alias("next"))
    # at most RANGES rows: the highest id of each range follows the lowest of the one above
    heads = parted.groupBy("part").agg(F.max_by(name, "id").alias("head"))
    around = Window.orderBy(F.desc("part"))
    ends = heads.select(
        F.col("part").alias("_part"),
        F.coalesce(
            F.lead("head").over(around),
            F.first("head").over(around.rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing
            )),
        ).alias("after"),
    )
    return inner.join(F.broadcast(ends), F.col("part") == F.col("_part")).select(
        "id", "blank", "need", F.coalesce("next", "after").alias("next"),
    ).select(
        "id", "blank", "need", F.col("next.id").alias("next_id"),
        F.col("next.blank").alias("next_blank"), F.col("next.hash").alias("next_hash"),
    )


def edited(docs: DataFrame) -> DataFrame:
    """Each document with its edited text and the next document's vector.

    Takes doc_id and text; returns doc_id, n_chars, text, edited, vec and next_vec, one row per
    input row. The edited text has the last third of the code points replaced by the first as
    many of the next document in descending doc_id; after the last comes the first. A null
    text is empty, a null doc_id comes last. Of several rows with one doc_id, the one with the
    least text hash stands for it as a next document. A single document is its own next. An
    empty table gives no rows.
    """
    # both joins below shuffle exactly these columns by the id, so they share one exchange
    base = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("blank"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    follow = written(following(base), "following").select(
        F.col("id").alias("to_id"), F.col("blank").alias("to_blank"), "need",
        "next_id", "next_blank", "next_hash",
    )
    # the text of each next document, cut to what is needed, goes to the row before it
    patch = base.join(
        follow,
        (F.col("id") == F.col("next_id")) & (F.col("blank") == F.col("next_blank"))
        & (F.xxhash64("text").bitwiseXOR(F.col("next_hash")) == 0),  # no join key of its own
    ).select(
        "to_id", "to_blank", F.expr("substring(text, 1, need)").alias("patch"),
        vector(F.col("text")).alias("next_vec"),
    ).dropDuplicates(["to_id", "to_blank"])
    third = F.floor(F.length("text") / 3).cast("int")
    return base.join(
        patch, (F.col("id") == F.col("to_id")) & (F.col("blank") == F.col("to_blank"))
    ).select(
        F.when(~F.col("blank"), F.col("id")).alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"), "text",
        F.concat(
            F.substr(F.col("text"), F.lit(1), F.length("text") - third),
            F.substr(F.col("patch"), F.lit(1), third),
        ).alias("edited"),
        vector(F.col("text")).alias("vec"), "next_vec",
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "vec", "next_vec",
        vector(F.col("edited")).alias("edited_vec"),
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("vec")).alias("fingerprint"),
        fingerprint(F.col("edited_vec")).alias("edited_fingerprint"),
        likeness(F.col("vec"), F.col("edited_vec")).alias("near_edited"),
        likeness(F.col("vec"), F.col("next_vec")).alias("near_next"),
    )
