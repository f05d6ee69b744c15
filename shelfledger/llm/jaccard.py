"""Near copies by an exact Jaccard metric-space join of word shingle sets.

1 - Jaccard is a metric, so documents can be parted around pivots. Two kinds are used in turn.

* Pivots of one shingle. A document of n shingles is at distance 1 - 1/n from each shingle it
  holds and at 1 from all others, so its region is that of its rarest shingle, and the window
  of regions it must be replicated to are its n - ceil(t n) + 1 rarest: two documents as alike
  as t share one of them. Unlike pivots that are documents, these tell unrelated texts apart:
  nearly all pairs of documents are at distance 1 and would be in every window.
* Pivots that are documents, in regions that many documents share. There the distances differ:
  all documents of a region are compared with some pivots, and those that links connect
  already need no look at each other. A region with many others is cut into rings around one of
  them as wide as the radius 1 - t: by the triangle inequality a ring's documents link within
  it or to the next ring, whose documents are replicated to it. What is left is compared in
  blocks, the unconnected documents with all.

Every candidate is verified on whole shingle sets, so the result is exact.

Joins have a hint to meet by sorting: ids, labels and the sets of near copies take few bytes in
files, which is what Spark goes by when it sends a table to all tasks through the driver, and an
exploded column adds rows that files don't have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.llm.batches import (
    list_array, lowered, map_texts, mixed, shingle_hashes, slices, small_batches, text_bytes,
    word_hashes,
)
from shelfledger.llm.common import (
    cleared, documents, few_files, noted, null_safe, restored, whole_rows, written, written_by,
)
from shelfledger.llm.graph import components

#: The most frequent shingles come last in the order of rarity; so many at most are told apart
#: from the others, which are in the order of their hashes. Any number gives the same result.
FREQUENT = 1 << 16
#: Classes of counts to a doubling; the driver finds the least count of a frequent one from them.
STEPS = 16
#: Documents from which on a shingle is frequent.
LEAST_FREQUENT = 16
#: Shingles of a document all of which may be in its window.
SHORT = 64
#: Shingles that a task counts before it reports the frequent ones.
STRETCH = 1 << 22
#: Documents of a region that are compared in pairs at once.
REGION = 32
#: Documents of a block in larger regions.
BLOCK = 256
#: Documents of a large region that all others are compared with first.
PIVOTS = 64
#: How often a region with many unconnected documents is parted into rings around one of them.
DEPTH = 2
#: The filter that picks the documents whose sets are needed has 2 to the power of so many bits at
#: most, 32 MB; beyond some 100 million of them more sets than needed leave the scan.
FILTER_BITS = 28
#: The filter's pieces, which executors make, have 2 to the power of so many bits at most, 8 kB.
PIECE_BITS = 16


@dataclass(frozen=True)
class Likeness:
    """Documents link when den * |A and B| >= num * |A or B|, on shingles of ``width`` words."""

    width: int = 4
    num: int = 85
    den: int = 100

    @property
    def radius(self) -> float:
        return 1 - self.num / self.den

    def window(self, n):
        """How many of a document's rarest shingles a linked document must share one of."""
        return n + (-self.num * n // self.den) + 1

    def overlap(self, both):
        """The least intersection of linked documents with ``both`` shingles together."""
        return -(-self.num * both // (self.num + self.den))


# --------------------------------------------------------------------------- shingles

def _sets(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, starts = text_bytes(batch.column("text"))
    words, doc = word_hashes(lowered(data), starts)
    return shingle_hashes(words, doc, batch.num_rows, width)


def _keys(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set: 128 bits that are equal for equal sets."""
    with np.errstate(over="ignore"):
        one = np.concatenate([[np.uint64(0)], np.cumsum(mixed(tokens), dtype=np.uint64)])
        two = np.concatenate([
            [np.uint64(0)],
            np.cumsum(mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64),
        ])
        return one[starts[1:]] - one[starts[:-1]], two[starts[1:]] - two[starts[:-1]]


def frequent_shingles(docs: DataFrame, like: Likeness) -> np.ndarray:
    """The most frequent shingles among those that windows are taken from: those with low hashes,
    and those of short documents.

    All documents are counted; a shingle that a stretch of a task meets once only is left out of
    what the task reports, since most are, and only an order is wanted: any gives the same result.
    How many have which count is looked at first, so the driver gets FREQUENT of them at most, not
    as many from each task.
    """
    zone = np.uint64(int(min(0.999, 1.3 * like.radius + 0.005) * 2.0**64))

    def reported(held: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(held), return_counts=True)
        several = n > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(token[several].view(np.int64)), pa.array(n[several].astype(np.int64))],
            names=["token", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "text"):
            tokens, starts = _sets(batch, like.width)
            n = np.diff(starts)
            held.append(tokens[(tokens < zone) | (np.repeat(n, n) < SHORT)])
            size += len(held[-1])
            if size > STRETCH:
                yield reported(held)
                held, size = [], 0
        if held:
            yield reported(held)

    spark, gone = docs.sparkSession, []
    small_batches(spark)
    with noted(gone):
        counted = written(
            docs.select("text").mapInArrow(run, "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_FREQUENT)
            .coalesce(few_files(spark)), "frequent",
        )
    step = F.floor(F.log2("n") * STEPS)
    least, many = None, 0
    for r in counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        many += r["count"]
        if many > FREQUENT:
            break
        least = r["step"]
    found = counted.where(step >= least).select("token").collect() if least is not None else []
    cleared(spark, gone)
    return np.sort(np.array([r["token"] for r in found], dtype=np.int64).view(np.uint64))


def signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """(doc_id, n, k1, k2, rare): size, key and rarest shingles of each document's set."""
    frequent = frequent_shingles(docs, like)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def signed(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, starts = _sets(batch, like.width)
        n = np.diff(starts)
        k1, k2 = _keys(tokens, starts)
        at = np.searchsorted(frequent, tokens)
        common = (
            frequent[np.minimum(at, len(frequent) - 1)] == tokens if len(frequent)
            else np.zeros(len(tokens), dtype=bool)
        )
        doc = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((tokens, common, doc))
        take = np.where(n > 0, like.window(n), 0)
        rank = np.arange(len(tokens)) - starts[doc]
        rare = tokens[order][rank < take[doc]]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n.astype(np.int32)), pa.array(k1.view(np.int64)),
             pa.array(k2.view(np.int64)),
             list_array(rare.view(np.int64), np.concatenate([[0], np.cumsum(take)]), pa.int64())],
            names=["doc_id", "n", "k1", "k2", "rare"],
        )

    return map_texts(
        docs.select("doc_id", "text"), "text", signed,
        f"doc_id {kind}, n int, k1 long, k2 long, rare array<long>",
    )


def needed_sets(docs: DataFrame, needed: DataFrame, like: Likeness) -> DataFrame:
    """(cid, n, tokens) of the classes ``needed(cid, k1, k2, n, first)``, dealt by cid.

    A filter over keys and ids is made on the executors and sent along, so that of each class
    only the document named ``first`` leaves the scan, with few others; the keys themselves
    decide after that. The filter has 16 bits per class, 2 ** FILTER_BITS bits at most, and comes
    to the driver as bits, in pieces.
    """
    log = min(FILTER_BITS, max(10, (16 * needed.count()).bit_length()))
    piece = min(log, PIECE_BITS)
    slot = F.col("k1").bitwiseXOR(F.xxhash64("first")).bitwiseAND((1 << log) - 1)

    def filled(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << piece, dtype=np.uint8)
        bits[table.column("bit").to_numpy()] = 1
        return pa.table({
            "at": table.column("at").slice(0, 1),
            "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], type=pa.binary()),
        })

    pieces = needed.select(
        F.shiftright(slot, piece).alias("at"), slot.bitwiseAND((1 << piece) - 1).alias("bit")
    ).groupBy("at").applyInArrow(filled, "at long, bits binary").toArrow()
    bits = np.zeros(1 << (log - 3), dtype=np.uint8)
    for at, part in zip(pieces.column("at").to_pylist(), pieces.column("bits"), strict=True):
        start = at << (piece - 3)
        bits[start:start + (1 << (piece - 3))] = np.frombuffer(part.as_buffer(), dtype=np.uint8)

    def passing(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, starts = _sets(batch, like.width)
        k1, k2 = _keys(tokens, starts)
        at = (k1 ^ batch.column("id").to_numpy().view(np.uint64)) & np.uint64((1 << log) - 1)
        hit = (bits[(at >> np.uint64(3)).astype(np.int64)]
               >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        n = np.diff(starts)
        doc = np.repeat(np.arange(len(n)), n)
        return pa.RecordBatch.from_arrays(
            [pa.array(k1[hit].view(np.int64)), pa.array(k2[hit].view(np.int64)),
             pa.array(n[hit].astype(np.int32)),
             list_array(tokens[hit[doc]].view(np.int64),
                        np.concatenate([[0], np.cumsum(n[hit])]), pa.int64())],
            names=["k1", "k2", "n", "tokens"],
        )

    found = map_texts(
        docs.select("text", F.xxhash64("doc_id").alias("id")), "text", passing,
        "k1 long, k2 long, n int, tokens array<long>",
    )
    sets = found.join(
        needed.select("cid", "k1", "k2", "n").hint("merge"), ["k1", "k2", "n"]
    ).groupBy("cid").agg(F.any_value("n").alias("n"), F.any_value("tokens").alias("tokens"))
    return written_by(sets, "sets", "cid")


# --------------------------------------------------------------------------- verification

def _tokens(column: pa.Array) -> list[np.ndarray]:
    """The sets of a list column, each sorted as unsigned numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def with_common(
    pairs: DataFrame, sets: DataFrame, sets_a: DataFrame | None = None
) -> DataFrame:
    """``pairs(a, b, ...)`` with na, nb and the size of the intersection as ``common``.

    ``sets`` is dealt by cid and stays where it is. ``sets_a(a, block, tokens)`` may hold those of
    ``a`` alone, for pairs in which one ``a`` may have many ``b``: a copy for each block of pairs.
    """
    by = ["a"] if sets_a is None else ["a", "block"]
    a = (sets.withColumnRenamed("cid", "a") if sets_a is None else sets_a).select(
        *by, F.col("tokens").alias("_ta")
    )
    b = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("_tb"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ta, tb = _tokens(part.column("_ta")), _tokens(part.column("_tb"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep),
                     pa.array([len(x) for x in ta], type=pa.int32()),
                     pa.array([len(x) for x in tb], type=pa.int32()),
                     pa.array([_common(x, y) for x, y in zip(ta, tb, strict=True)],
                              type=pa.int32())],
                    names=[*keep, "na", "nb", "common"],
                )

    small_batches(pairs.sparkSession)
    keep = pairs.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)
    return pairs.join(a.hint("merge"), by).join(b.hint("merge"), "b").select(
        *keep, "_ta", "_tb"
    ).mapInArrow(counted, f"{schema}, na int, nb int, common int")


def linked(like: Likeness) -> Column:
    return like.den * F.col("common") >= like.num * (F.col("na") + F.col("nb") - F.col("common"))


# --------------------------------------------------------------------------- regions

def regions(classes: DataFrame) -> DataFrame:
    """(token, cid, n, held, pivot): documents by the single-shingle pivots they share.

    ``held`` is the number of documents of the region, 2 at least; ``pivot`` is one of them,
    the same for regions that share it.
    """
    posted = classes.select("cid", "n", F.explode("rare").alias("token"))
    shared = posted.groupBy("token").agg(
        F.count(F.lit(1)).alias("held"),
        F.min(F.struct(F.xxhash64("cid").alias("h"), "cid")).alias("least"),
    ).where("held > 1").select("token", "held", F.col("least.cid").alias("pivot"))
    return posted.join(shared.hint("merge"), "token")


def region_pairs(shared: DataFrame, like: Likeness) -> DataFrame:
    """(a, b): pairs of regions of at most REGION documents that may link.

    A pair's regions are counted, and a pair that shares too few to reach the overlap is left
    out: what it shares beyond its windows is no more than the rest of its shingles. A pair
    that also shares a larger region is looked at there.
    """
    members = F.array_sort(F.collect_list(F.struct("cid", "n")))
    pairs = F.flatten(F.transform("m", lambda x: F.transform(
        F.filter("m", lambda y: (y["cid"] > x["cid"])
                 & (like.den * F.least(x["n"], y["n"]) >= like.num * F.greatest(x["n"], y["n"]))),
        lambda y: F.struct(
            x["cid"].alias("a"), y["cid"].alias("b"), x["n"].alias("na"), y["n"].alias("nb")
        ),
    )))
    both = F.col("na") + F.col("nb")
    need = F.ceil(like.num * both / (like.num + like.den) - 1e-9)

    def beyond(n: Column) -> Column:
        return F.ceil(like.num * n / like.den - 1e-9) - 1

    return (
        shared.where(F.col("held") <= REGION).groupBy("token").agg(members.alias("m"))
        .select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b", "p.na", "p.nb")
        .agg(F.count(F.lit(1)).alias("shared"))
        .where(F.col("shared") + F.greatest(beyond(F.col("na")), beyond(F.col("nb"))) >= need)
        .select("a", "b")
    )


def part_around(cells: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """Parts ``cells(cell, pivot, held, cid, label)`` into rings around each cell's pivot.

    Returns the parts (cell, cid, label, at, core): ``at`` is the distance, ``core`` tells the
    documents of a ring from those of the next ring, which are replicated.
    """
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    pivots = written(cells.groupBy(F.col("pivot").alias("cid")).agg(
        F.max(blocks).alias("blocks")
    ).join(sets.select("cid", "tokens").hint("merge"), "cid"), "pivots").select(
        F.col("cid").alias("a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "tokens",
    )
    met = with_common(cells.select(
        F.col("pivot").alias("a"), F.pmod(F.xxhash64("cid"), blocks).cast("int").alias("block"),
        F.col("cid").alias("b"), "cell", "label",
    ), sets, pivots)
    away = 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    ring = F.floor(away / like.radius + 1e-9).cast("int")
    return met.select(
        "cell", F.col("b").alias("cid"), "label", away.alias("at"), ring.alias("ring")
    ).select(
        "cell", "cid", "label", "at", F.explode(F.array(
            F.struct(F.col("ring").alias("ring"), F.lit(True).alias("core")),
            F.struct((F.col("ring") - 1).alias("ring"), F.lit(False).alias("core")),
        )).alias("r"),
    ).where("r.ring >= 0").select(
        F.xxhash64("cell", "r.ring").alias("cell"), "cid", "label", "at", "r.core"
    )


def pivot_links(cells: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """Links (a, b) between the documents of ``cells(cell, cid, held)`` and PIVOTS or so of each
    cell, chosen by hash. The pivots are sent to each block of the cell's documents."""
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    chosen = F.pmod(F.xxhash64("cid", "cell"), F.col("held")) < PIVOTS
    here = F.struct(F.pmod(F.xxhash64("cid"), blocks).cast("int").alias("i"), F.lit(1).alias("own"))
    there = F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda x: F.struct(x.alias("i"), F.lit(0).alias("own"))
    )
    dealt = cells.select(
        "cell", "cid", F.explode(F.when(chosen, F.concat(F.array(here), there)).otherwise(
            F.array(here))).alias("g"),
    ).select(
        "cell", "cid", F.col("g.i").alias("i"), F.lit(0).alias("j"), F.lit(0).alias("kind"),
        F.col("g.own").alias("own"), F.col("cid").alias("label"), F.lit(0.0).alias("at"),
        F.lit(True).alias("core"),
    )
    return _met_in_groups(dealt, sets, like)


def _with_labels(cells: DataFrame, links: DataFrame) -> DataFrame:
    """``cells`` with the component that ``links`` put a document in, itself if in none."""
    known = components(links).select(F.col("node").alias("cid"), F.col("label").alias("_label"))
    return cells.join(known.hint("merge"), "cid", "left").select(
        *cells.columns, F.coalesce("_label", "cid").alias("label")
    )


def _sized(parts: DataFrame) -> DataFrame:
    """Parts with ``held`` documents, of which ``open`` are not of the component that most
    are of, ``major``; ``pivot`` is an open one. Parts that need no look are left out."""
    sizes = parts.groupBy("cell", "label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("core").alias("cores"),
        F.min(F.struct(F.xxhash64("cid").alias("h"), "cid")).alias("least"),
    ).groupBy("cell").agg(
        F.sum("n").alias("held"), F.sum("cores").alias("cores"),
        F.max(F.struct("n", "label", "least")).alias("top"),
        F.min_by("least", F.struct("n", "label")).alias("least"),
    ).select(
        "cell", "held", (F.col("held") - F.col("top.n")).alias("open"),
        F.col("top.label").alias("major"), F.col("least.cid").alias("pivot"), "cores",
    ).where("open > 0 and cores > 0").drop("cores")
    return parts.join(sizes.hint("merge"), "cell")


def region_links(
    shared: DataFrame, sets: DataFrame, like: Likeness, links: DataFrame
) -> list[DataFrame]:
    """Links (a, b) within regions of more than REGION documents: with ``links`` enough of them to
    connect all documents that the region's links connect.

    Documents that are connected already need no look at each other. Links to some pivots connect
    most of a group of near copies, so what remains is to meet the few others, the open ones. A
    region with many open documents is parted into rings around one of them, and again.
    """
    files = few_files(shared.sparkSession)
    cells = written(
        shared.where(F.col("held") > REGION).select(
            F.xxhash64("pivot").alias("cell"), "cid"
        ).distinct().coalesce(files), "cells",
    )
    held = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("held"))
    found = [written(
        pivot_links(cells.join(held.hint("merge"), "cell"), sets, like).repartition(files),
        "pivot-links",
    )]
    parts = _with_labels(cells, links.union(found[0])).withColumns({
        "at": F.lit(0.0), "core": F.lit(True)
    })
    for level in range(DEPTH + 1):
        sized = written(_sized(parts).repartition(files), "sized")
        fits = (F.col("held") <= BLOCK) | (F.col("open") <= BLOCK)
        if level == DEPTH or sized.where(~fits).isEmpty():
            return [*found, block_links(sized, sets, like)]
        found.append(block_links(sized.where(fits), sets, like))
        deep = sized.where(~fits).select("cell", "pivot", "held", "cid", "label")
        parts = written(part_around(deep, sets, like).repartition(files), "parts")
    return found


def block_links(parts: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """Compares the documents of each part (cell, cid, label, at, core, held, open, major).

    Open documents and the others are dealt into blocks of about BLOCK by their hash. Two blocks
    meet in a group of their own, so no task holds a large part; the others, which are connected,
    meet open ones only. A part of at most BLOCK documents is one group. From a group come only as
    many links as connect its documents.
    """
    is_open = F.col("label") != F.col("major")

    def blocks(n: Column) -> Column:
        return F.ceil(n / BLOCK).cast("int")

    open_blocks, other_blocks = blocks(F.col("open")), blocks(F.col("held") - F.col("open"))
    own = F.pmod(F.xxhash64("cid"), F.when(is_open, F.col("ob")).otherwise(F.col("mb"))).cast("int")

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    def group(kind: int, i: Column, j: Column, side: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("own")
        )

    zero = F.lit(0)
    among_open = F.transform(upto("ob"), lambda x: group(
        1, F.least("block", x), F.greatest("block", x), F.col("block")))
    to_others = F.transform(upto("mb"), lambda x: group(2, F.col("block"), x, zero))
    from_others = F.transform(upto("ob"), lambda x: group(2, x, F.col("block"), F.lit(1)))
    groups = (
        F.when(F.col("held") <= BLOCK, F.array(group(0, zero, zero, zero)))
        .when(is_open, F.concat(among_open, to_others)).otherwise(from_others)
    )
    dealt = parts.withColumns({"ob": open_blocks, "mb": other_blocks}).withColumn(
        "block", own
    ).select("cell", "cid", "label", "at", "core", F.explode(groups).alias("g")).select(
        "cell", "cid", "label", "at", "core", "g.*"
    )
    return _met_in_groups(dealt, sets, like)


def _met_in_groups(dealt: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """Links (a, b) of the groups (cell, kind, i, j), between documents of different sides."""
    def met(table: pa.Table) -> pa.Table:
        a, b = _group_links(table, like)
        return pa.table({"a": pa.array(a, type=pa.int64()), "b": pa.array(b, type=pa.int64())})

    return dealt.join(sets.select("cid", "tokens").hint("merge"), "cid").groupBy(
        "cell", "kind", "i", "j"
    ).applyInArrow(met, "a long, b long")


def _group_links(table: pa.Table, like: Likeness) -> tuple[list[int], list[int]]:
    cid = table.column("cid").to_numpy()
    at = table.column("at").to_numpy()
    core = table.column("core").to_numpy()
    label = table.column("label").to_numpy()
    own = table.column("own").to_numpy()
    sets = _tokens(table.column("tokens"))
    n = np.array([len(s) for s in sets])
    m = len(sets)
    flat = np.concatenate(sets)
    doc = np.repeat(np.arange(m), n)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    several = times[column] > 1  # a shingle of one document is in no intersection
    doc, column = doc[several], column[several]
    fresh = np.cumsum(times > 1) - 1
    column = fresh[column]
    width = int((times > 1).sum())
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    common = np.zeros((m, m), dtype=np.float32)
    step = max(256, (1 << 22) // max(m, 1))
    for low in range(0, width, step):
        a, b = np.searchsorted(column, [low, low + step])
        part = np.zeros((m, min(step, width - low)), dtype=np.float32)
        part[doc[a:b], column[a:b] - low] = 1
        common += part @ part.T
    both = n[:, None] + n[None, :] - common
    hit = like.den * common.astype(np.float64) >= like.num * both
    hit &= core[:, None] | core[None, :]
    hit &= np.abs(at[:, None] - at[None, :]) <= like.radius + 1e-6
    hit &= label[:, None] != label[None, :]
    if own.min() != own.max():
        hit &= own[:, None] != own[None, :]
    one, two = np.nonzero(np.triu(hit, 1))
    root = list(range(m))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out_a, out_b = [], []
    for x, y in zip(one.tolist(), two.tolist(), strict=True):
        rx, ry = top(x), top(y)
        if rx != ry:
            root[rx] = ry
            out_a.append(int(cid[x]))
            out_b.append(int(cid[y]))
    return out_a, out_b


# --------------------------------------------------------------------------- the join

def near_copies(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    Takes doc_id and text; other columns are left out. ``component_id`` is the least doc_id
    that links lead to, its own included. Texts are compared by sets of shingles of lower-cased
    words; a text with fewer words than a shingle has the sequence of its words as the only
    one, and a null or blank text has none and links with nothing. Equal sets are one class,
    however many rows hold it. A null doc_id takes part but names no component that has an id.
    An empty table gives no rows. Shingles are compared as 64-bit hashes.
    """
    docs = docs.select("doc_id", "text")
    spark, gone = docs.sparkSession, []
    files = few_files(spark)  # light work is done in as many tasks; rows of other work are dealt
    signed = written(signatures(docs, like), "signatures")
    classes = written(
        signed.where("n > 0").groupBy("k1", "k2", "n").agg(
            F.min("doc_id").alias("first"), F.any_value("rare").alias("rare")
        ).withColumn("cid", F.monotonically_increasing_id()), "classes",
    )
    with noted(gone):
        shared = written(regions(classes), "regions")
        pairs = written(region_pairs(shared, like), "pairs")
        members = shared.where(F.col("held") > REGION).select("cid").union(
            pairs.select("a")
        ).union(pairs.select("b")).distinct()
        needed = written(
            classes.select("cid", "k1", "k2", "n", "first").join(
                members.hint("merge"), "cid"
            ).coalesce(files), "needed",
        )
        sets = needed_sets(docs, needed, like)
        links = written(
            with_common(pairs, sets).where(linked(like)).select("a", "b").repartition(files),
            "pair-links",
        )
        for more in region_links(shared, sets, like, links):
            links = links.union(more)
    links = written(links.repartition(files), "links")
    cleared(spark, gone)  # what led to the links has been read
    found = components(links)
    named = written(found.join(
        classes.select(F.col("cid").alias("node"), "first").hint("merge"), "node"
    ).coalesce(files), "named")
    leader = named.groupBy("label").agg(F.min("first").alias("leader"))
    of_class = classes.select("k1", "k2", "n", "cid", "first").join(
        named.join(leader.hint("merge"), "label").select(
            F.col("node").alias("cid"), "leader"
        ).hint("merge"), "cid", "left",
    ).select("k1", "k2", "n", F.coalesce("leader", "first").alias("component"))
    return signed.select("doc_id", "k1", "k2", "n").join(
        of_class.hint("merge"), ["k1", "k2", "n"], "left"
    ).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def distinct_documents(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """One row of each group of near copies, with all columns as they are.

    The row with the least doc_id stays, of equal ids the one whose text has the least hash, of
    equal rows any. Documents without words stay, repeated rows of them too. A row without
    doc_id stays only where its whole group has none.
    """
    found = near_copies(docs.select(
        F.struct(
            F.col("doc_id").isNull().alias("blank"), "doc_id", F.xxhash64("text").alias("h")
        ).alias("doc_id"), "text",
    ), like)
    # groups are few rows against all: name those that go, by id and text
    of_row = found.groupBy("doc_id").agg(
        F.min("component_id").alias("keep"), F.max("n_shingles").alias("n"),
        F.count(F.lit(1)).alias("times"),
    )
    name = of_row.select(
        F.col("doc_id.doc_id").alias("id"), F.col("doc_id.h").alias("h"), "times",
        (F.col("n") == 0).alias("blank"), F.col("doc_id").eqNullSafe(F.col("keep")).alias("first"),
    ).where("first or blank")
    kept = whole_rows(docs, "doc_id", F.xxhash64("text").alias("hash")).join(
        name, null_safe("doc_id", "id") & (F.col("hash") == F.col("h"))
    )
    once = kept.where("times = 1 or blank").select("_whole")
    again = kept.where("times > 1 and not blank").dropDuplicates(["id", "h"])
    return restored(once.union(again.select("_whole")), docs)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(documents(spark, sf_dir))


OP10_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT row_no, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
        ELSE [w[i:i + 3] for i in range(1, len(w) - 2)] END) AS shingle
    FROM texts
), sizes AS (
    SELECT row_no, count(*) AS n FROM shingles GROUP BY row_no
), links AS (
    SELECT a.row_no AS a, b.row_no AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row_no <> b.row_no
        JOIN sizes m ON m.row_no = a.row_no JOIN sizes n ON n.row_no = b.row_no
    GROUP BY a.row_no, b.row_no, m.n, n.n
    HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reached AS (
    SELECT row_no AS a, row_no AS b FROM texts
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT t.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM texts t JOIN reached r ON r.a = t.row_no JOIN texts o ON o.row_no = r.b
    LEFT JOIN sizes s ON s.row_no = t.row_no
GROUP BY t.row_no, t.doc_id
"""
