"""Divergence between the sources of a language, by hash-consed segment trees of term counts.

A group is the documents of one language and source. Its tree has the kept terms of the language
as leaves, each with the term's count in the group, and a node stands for the counts below it:
subtrees with equal counts are one node, in whatever group or place they occur. To compare two
groups their trees are walked down together, a level at a time; a pair of nodes that is met
again, as are the many pairs of rare terms, only adds to the times of its first meeting, and so
is priced once.

Spark deals the top of the trees out: the leaves of a language are cut into subtrees of about
LEAVES terms, by hash of the term, and the sources into blocks of about BLOCK, so a task holds
one subtree of two blocks at most, whatever the vocabulary and the number of sources. Prices of
subtrees add up to those of trees in a grouped sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfledger.llm.batches import (
    lowered, runs_of, slices, small_batches, text_bytes,
)
from shelfledger.llm.common import documents, written

#: Documents of a language that hold a kept term.
LEAST_DOCS = 10
#: Probabilities are in parts of SCALE.
SCALE_DIGITS = 9
#: Terms that a group lists at most.
TOP = 10
#: About how many terms are the leaves of a subtree.
LEAVES = 4096
#: About how many sources are compared with as many others in a task.
BLOCK = 64
#: Pairs of nodes that are walked at once.
WALKED = 1 << 20

#: Bytes of terms: letters, and everything beyond ASCII.
IS_TERM = np.zeros(256, dtype=bool)
IS_TERM[65:91] = IS_TERM[97:123] = IS_TERM[128:] = True


# ---------------------------------------------------------------------------------- counts

def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, n, docs): occurrences and documents of each term by group."""
    data, starts = text_bytes(batch.column("text"))
    begin, stop, doc = runs_of(IS_TERM[data], starts)
    letters = lowered(data)[IS_TERM[data]]
    ends = np.concatenate([[0], np.cumsum(stop - begin)]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(
        len(begin), pa.py_buffer(ends.tobytes()), pa.py_buffer(letters.tobytes())
    ).dictionary_encode()
    term = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    group = (lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)
             * max(len(source.dictionary), 1) + source.indices.to_numpy(zero_copy_only=False))
    width = max(len(terms.dictionary), 1)
    held, n = np.unique(doc * width + term, return_counts=True)
    keys, at = np.unique(group[held // width] * width + held % width, return_inverse=True)
    times = np.zeros(len(keys), dtype=np.int64)
    np.add.at(times, at, n)
    pair = keys // width
    of = max(len(source.dictionary), 1)
    return pa.RecordBatch.from_arrays(
        [lang.dictionary.take(pa.array(pair // of)), source.dictionary.take(pa.array(pair % of)),
         terms.dictionary.take(pa.array(keys % width)).cast(pa.string()), pa.array(times),
         pa.array(np.bincount(at, minlength=len(keys)).astype(np.int64))],
        names=["lang", "source", "term", "n", "docs"],
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term, and documents that hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield _counted(batch)

    small_batches(docs.sparkSession)
    return docs.select("lang", "source", "text").mapInArrow(
        run, "lang string, source string, term string, n long, docs long"
    ).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---------------------------------------------------------------------------------- trees

class Trees:
    """The trees over ``counts``, a row per group and a power of two of columns; a count of -1
    is no term. ``roots`` are the groups' root nodes, ``below`` the children of each level's
    nodes from the top down, ``leaves`` the counts that leaf nodes stand for."""

    def __init__(self, counts: np.ndarray):
        self.leaves, ids = np.unique(counts, return_inverse=True)
        ids = ids.reshape(counts.shape).astype(np.int64)
        self.below: list[tuple[np.ndarray, np.ndarray]] = []
        size = len(self.leaves)
        while ids.shape[1] > 1:
            pairs, found = np.unique(ids[:, 0::2] * size + ids[:, 1::2], return_inverse=True)
            ids = found.reshape(len(ids), -1).astype(np.int64)
            self.below.insert(0, (pairs // size, pairs % size))
            size = len(pairs)
        self.roots = ids[:, 0]

    def met(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """(walk, count of a, count of b, times): the distinct pairs of leaves that walks down
        from the roots of groups ``a`` and ``b`` meet, and how often."""
        walk, one, two = np.arange(len(a)), self.roots[a], self.roots[b]
        times = np.ones(len(a), dtype=np.int64)
        for left, right in self.below:
            walk, times = np.tile(walk, 2), np.tile(times, 2)
            one = np.concatenate([left[one], right[one]])
            two = np.concatenate([left[two], right[two]])
            size = int(max(one.max(), two.max(), 0)) + 1
            keys, at = np.unique((walk * size + one) * size + two, return_inverse=True)
            again = np.zeros(len(keys), dtype=np.int64)
            np.add.at(again, at, times)
            walk, one, two, times = keys // size // size, keys // size % size, keys % size, again
        return walk, self.leaves[one], self.leaves[two], times


def probability(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10 ** SCALE_DIGITS * (count + 2) / whole), by exact long division."""
    rest, found = count + 2, np.zeros(len(count), dtype=np.int64)
    for digit in range(SCALE_DIGITS + 1):
        found = found * 10 + rest // whole
        rest = rest % whole * 10
    return 1 + found


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def pair_prices(trees: Trees, a: np.ndarray, b: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The price of each pair of groups over the terms of the trees."""
    out = np.zeros(len(a), dtype=np.int64)
    step = max(1, WALKED >> len(trees.below))
    for at in range(0, len(a), step):
        x, y = a[at:at + step], b[at:at + step]
        walk, m, n, times = trees.met(x, y)
        real = m >= 0
        walk, m, n, times = walk[real], m[real], n[real], times[real]
        found = price(probability(m, whole[x[walk]]), probability(n, whole[y[walk]]))
        np.add.at(out, at + walk, found * times)
    return out


def _audited(key: tuple, table: pa.Table) -> pa.Table:
    """Prices of pairs of sources and of terms in one subtree of a language."""
    lang, _, i, j = (k.as_py() for k in key)
    kind = table.column("kind").to_numpy()
    order = pc.sort_indices(table.filter(pa.array(kind == 0)), [("source", "ascending")])
    groups = table.filter(pa.array(kind == 0)).take(order)
    sources = groups.column("source").combine_chunks()
    block = groups.column("block").to_numpy()
    terms = table.filter(pa.array(kind == 2))
    terms = terms.take(pc.sort_indices(terms, [("n", "descending"), ("term", "ascending")]))
    names = terms.column("term").combine_chunks()
    cells = table.filter(pa.array(kind == 1))
    width = 1 << max(len(names) - 1, 0).bit_length()
    counts = np.zeros((len(sources) + 1, width), dtype=np.int64)
    counts[:, len(names):] = -1
    counts[
        pc.index_in(cells.column("source"), sources).to_numpy(),
        pc.index_in(cells.column("term"), names).to_numpy(),
    ] = cells.column("n").to_numpy()
    counts[-1, :len(names)] = terms.column("n").to_numpy()
    whole = np.concatenate([
        groups.column("whole").to_numpy(), groups.column("whole_lang").to_numpy()[:1]
    ])
    trees = Trees(counts)
    a, b = np.triu_indices(len(sources), 1)
    if i != j:
        a, b = (x[block[a] != block[b]] for x in (a, b))
    out = [pa.table({
        "source": sources.take(pa.array(a)), "item": sources.take(pa.array(b)),
        "value": pair_prices(trees, a, b, whole),
    }, schema=_PRICED)]
    if i == j and len(names):
        out += _unusual(counts, whole, sources, names)
    found = pa.concat_tables(out)
    parts = ["pair"] * len(a) + ["term"] * (len(found) - len(a))
    return pa.table({
        "lang": pa.array([lang] * len(found), pa.string()), "source": found.column("source"),
        "part": pa.array(parts, pa.string()), "item": found.column("item"),
        "value": found.column("value"),
    })


_PRICED = pa.schema([("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _unusual(
    counts: np.ndarray, whole: np.ndarray, sources: pa.Array, names: pa.Array
) -> list[pa.Table]:
    """The TOP terms of each group that are more usual there than in the language. Equal pairs
    of counts are priced once."""
    all_counts, rank = counts[-1], np.empty(len(names), dtype=np.int64)
    rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
    out = []
    for g in range(len(sources)):
        at = np.flatnonzero(counts[g] > 0)
        size = int(all_counts.max()) + 1
        pairs, of = np.unique(
            np.stack([counts[g, at], all_counts[at]]), axis=1, return_inverse=True
        ) if size > 1 << 31 else _unique_pairs(counts[g, at], all_counts[at], size)
        p = probability(pairs[0], whole[g])
        q = probability(pairs[1], whole[-1])
        more = (p > q)[of]
        at, value = at[more], price(p, q)[of][more]
        top = np.lexsort((rank[at], -value))[:TOP]
        out.append(pa.table({
            "source": pa.array([sources[g].as_py()] * len(top), pa.string()),
            "item": names.take(pa.array(at[top])), "value": value[top],
        }, schema=_PRICED))
    return out


def _unique_pairs(m: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    keys, of = np.unique(m * size + n, return_inverse=True)
    return np.stack([keys // size, keys % size]), of


# ---------------------------------------------------------------------------------- audit

def _pieces(count: str, size: int) -> Column:
    """Into how many parts of about ``size`` a number goes, 1 at least."""
    return F.greatest(F.ceil(F.col(count) / size), F.lit(1)).cast("int")


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from each
    other (part ``pair``), and the terms it uses more than its language (part ``term``).

    Takes text, lang and source; other columns are left out. A null is an empty string, which is
    a language or source like any other. Terms are runs of letters and of characters beyond
    ASCII, with A to Z lower-cased; those in LEAST_DOCS documents of a language are kept. Groups
    without terms have zero counts; where a language keeps no term all its pairs are at 0. Ties
    rank by item. A language with one source has no pairs; an empty table gives no rows. All
    arithmetic is exact for up to 9 * 10 ** 17 terms in a language.
    """
    docs = docs.select(*(
        F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")
    ))
    counts = written(term_counts(docs), "term-counts")
    kept = written(
        counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "n"), "kept-terms",
    )
    cells = written(
        counts.join(kept.select("lang", "term"), ["lang", "term"]).select(
            "lang", "source", "term", "n"
        ), "term-cells",
    )
    groups = docs.select("lang", "source").distinct().join(
        cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left"
    ).withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    groups = written(groups, "groups")
    langs = written(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("all")),
        "lang", "left",
    ).na.fill(0, ["terms", "all"]).select(
        "lang", _pieces("terms", LEAVES).alias("chunks"), _pieces("sources", BLOCK).alias("blocks"),
        "terms", (F.col("all") + 2 * F.col("terms")).alias("whole_lang"),
    ), "languages")

    def part(name: str, number: str) -> Column:
        return F.pmod(F.xxhash64(name), F.col(number)).cast("int")

    def upto(number: str) -> Column:
        return F.sequence(F.lit(0), F.col(number) - 1)

    def rows(kind: int, **values: Column) -> list[Column]:
        empty = {"source": "string", "term": "string", "n": "long", "whole": "long",
                 "whole_lang": "long", "block": "int"}
        return [
            F.lit(kind).alias("kind"),
            *(values.get(c, F.lit(None)).cast(t).alias(c) for c, t in empty.items()),
        ]

    def met(df: DataFrame, kind: int, **values: Column) -> DataFrame:
        """The rows in each pair of blocks that their own block takes part in."""
        return df.select("lang", "chunk", *rows(kind, block=F.col("own"), **values), F.explode(
            upto("blocks")).alias("other")).select(
                "*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
            ).drop("other")

    # a language with no kept term has one empty chunk, in which all its pairs meet
    members = groups.join(langs, "lang").select(
        "*", part("source", "blocks").alias("own"), F.explode(upto("chunks")).alias("chunk")
    )
    leaves = cells.join(langs, "lang").select(
        "*", part("source", "blocks").alias("own"), part("term", "chunks").alias("chunk")
    )
    # every pair of blocks needs all terms of its chunk
    alphabet = kept.join(langs, "lang").select(
        "lang", part("term", "chunks").alias("chunk"), "term", "n", "blocks",
        F.explode(upto("blocks")).alias("i"),
    ).select(
        "lang", "chunk", *rows(2, term=F.col("term"), n=F.col("n")), "i",
        F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)).alias("j"),
    )
    task = met(
        members, 0, source=F.col("source"),
        whole=F.greatest(F.col("total") + 2 * F.col("terms"), F.lit(1)),
        whole_lang=F.greatest("whole_lang", F.lit(1)),
    ).union(
        met(leaves, 1, source=F.col("source"), term=F.col("term"), n=F.col("n"))
    ).union(alphabet)
    small_batches(docs.sparkSession)
    priced = written(task.groupBy("lang", "chunk", "i", "j").applyInArrow(
        _audited, "lang string, source string, part string, item string, value long"
    ), "prices")
    one_way = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(
        F.sum("value").alias("value")
    )
    pairs = one_way.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("way")).select(
        "lang", F.when(F.col("way"), F.col("source")).otherwise(F.col("item")).alias("source"),
        "part", F.when(F.col("way"), F.col("item")).otherwise(F.col("source")).alias("item"),
        "value",
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(ranked)).union(
        priced.where("part = 'term'").withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= TOP)
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


OP11_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang,
        coalesce(source, '') AS source,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), uses AS (
    SELECT row_no, lang, source, unnest(terms) AS term FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT row_no) AS docs
    FROM uses GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n)::BIGINT AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 10
), sources AS (
    SELECT DISTINCT lang, source FROM docs
), cells AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n
    FROM sources s JOIN kept k ON s.lang = k.lang
        LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), own AS (
    SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 2)
        // (sum(n) OVER w + 2 * count(*) OVER w) AS p
    FROM cells WINDOW w AS (PARTITION BY lang, source)
), overall AS (
    SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2)
        // (sum(n) OVER w + 2 * count(*) OVER w) AS q
    FROM kept WINDOW w AS (PARTITION BY lang)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), terms AS (
    SELECT o.lang, o.source, o.term AS item, (o.p - l.q) * (o.p - l.q) // (o.p + l.q) AS value
    FROM own o JOIN overall l ON o.lang = l.lang AND o.term = l.term
    WHERE o.n > 0 AND o.p > l.q
), priced AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        coalesce(p.value, 0)::BIGINT AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL SELECT lang, source, 'term', item, value::BIGINT FROM terms
), ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM priced
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
