"""Personal data by bootstrapped contextual extraction.

Base rules find entities of known form: these are the seeds. The words around them are lexical
patterns. Tokens that look like identifiers but match no rule are further instances. Spark
scores the graph of patterns and instances in turns: a pattern is as good as the share of its
instances that are known, an instance is as good as its patterns together. Instances that
several good patterns agree on are found as new entities of that kind.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.llm.batches import map_texts
from shelfledger.llm.common import documents, few_files, null_safe, restored, whole_rows, written

#: Kinds in the order of the results.
KINDS = ("email", "ip", "card", "phone")
#: Turns of scoring.
TURNS = 3
#: A pattern counts from so many documents on, and with so high a score.
LEAST_DOCS, LEAST_PATTERN = 3, 0.8
#: An unseen identifier needs so many patterns and so high a score.
LEAST_PATTERNS, LEAST_INSTANCE = 2, 0.9
#: Added to a pattern's instances, none of them known: few instances prove little.
DOUBT = 1.0

# The forms of the base rules.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
#: Marks at the ends of a token that do not belong to it.
_EDGES = "\"'()[]{}<>,;:!?.|*#$%&="


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, done))
        at = text.find("@", max(done, at + 1))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Four numbers joined by dots, each at most 255."""
    out = []
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CHAIN.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text)
            if 9 <= len(_DIGIT.findall(m.group())) <= 15]


_RULES = (emails, addresses, cards, phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of all base entities of a text, in that order."""
    digits = bool(_DIGIT.search(text))
    return [(k, a, b) for k, rule in enumerate(_RULES)
            if (digits if k else "@" in text) for a, b in rule(text)]


def _context(text: str, start: int, end: int) -> list[str]:
    """Patterns around a place: the two words before, those on both sides, the two after.

    Digits are written as 0, letters in lower case; a line's edge is a word of its own.
    """
    def near(part: str, last: bool) -> list[str]:
        line = part.rpartition("\n")[2] if last else part.partition("\n")[0]
        w = [_DIGIT.sub("0", x.strip(_EDGES).lower() or x) for x in line.split()]
        w = ["^", "^", *w][-2:] if last else [*w, "$", "$"][:2]
        return [x[:40] for x in w]

    a = near(text[max(0, start - 120):start], True)
    b = near(text[end:end + 120], False)
    return [f"<{a[0]} {a[1]}", f"{a[1]} _ {b[0]}", f">{b[0]} {b[1]}"]


def _look(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base entities and the places of other tokens that look like identifiers: at least six
    characters, three digits among them, and touching no base entity."""
    spans = base_spans(text)
    if not _DIGIT.search(text):
        return spans, []
    taken = sorted((a, b) for _, a, b in spans)
    starts = np.array([a for a, _ in taken])
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.array([])
    other, done = [], 0
    for d in _DIGIT.finditer(text):
        if d.start() < done:
            continue
        a = d.start()
        while a > done and text[a - 1] not in " \t\n\x0b\f\r":
            a -= 1
        b = _TOKEN.match(text, a).end()
        done = b
        token = text[a:b]
        inner = token.strip(_EDGES)
        a += token.find(inner) if inner else 0
        b = a + len(inner)
        if len(inner) < 6 or len(_DIGIT.findall(inner)) < 3:
            continue
        i = int(np.searchsorted(starts, b)) if taken else 0
        if i and ends[i - 1] > a:
            continue
        other.append((a, b))
    return spans, other


def sightings(docs: DataFrame) -> DataFrame:
    """(doc_id, base, seen): base entities, and all places with their patterns.

    ``base`` is an array of (kind, start, end); ``seen`` of (kind, start, end, instance,
    patterns) where kind is null at places that no rule matches.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    seen = pa.struct([
        ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
        ("instance", pa.int64()), ("patterns", pa.list_(pa.string())),
    ])

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, all_seen = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans, other = _look(text)
            base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            all_seen.append([
                {"kind": k, "start": a, "end": b, "patterns": _context(text, a, b),
                 "instance": int.from_bytes(
                     hashlib.blake2b(text[a:b].encode("utf-8", "replace"), digest_size=8)
                     .digest(), "little", signed=True)}
                for k, a, b in [*spans, *((None, a, b) for a, b in other)]
            ])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, type=pa.list_(span)),
             pa.array(all_seen, type=pa.list_(seen))],
            names=["doc_id", "base", "seen"],
        )

    return map_texts(
        docs.select("doc_id", "text"), "text", look,
        f"doc_id {kind}, base array<struct<kind:int,start:int,end:int>>, "
        "seen array<struct<kind:int,start:int,end:int,instance:long,patterns:array<string>>>",
    )


def learn_instances(sighted: DataFrame) -> DataFrame:
    """(instance, kind, score): identifiers no rule matches that good patterns agree on.

    The graph has an edge for each pattern and instance that meet, with its documents. Both
    sides are scored by grouped sums, so a pattern that half of all documents hold combines
    before the shuffle.
    """
    edges = written(
        sighted.select("row", F.explode("seen").alias("s"))
        .select("row", "s.kind", "s.instance", F.explode("s.patterns").alias("pattern"))
        .groupBy("pattern", "instance", "kind")
        .agg(F.count(F.lit(1)).alias("times"))
        .coalesce(few_files(sighted.sparkSession)), "edges",
    )
    seeds = edges.where("kind is not null").select(
        "instance", F.col("kind").alias("of"), F.lit(1.0).alias("score")
    ).distinct()
    known = seeds
    for _ in range(TURNS):
        # a pattern's instances in all, and those known of each kind by their scores
        total = edges.groupBy("pattern").agg(
            F.sum("times").alias("total"), F.count_distinct("instance").alias("width")
        ).where(F.col("width") >= LEAST_DOCS)
        patterns = written(
            edges.join(known, "instance").groupBy("pattern", "of").agg(
                F.sum(F.col("times") * F.col("score")).alias("good")
            ).join(total, "pattern")
            .select("pattern", "of", (F.col("good") / (F.col("total") + DOUBT)).alias("trust"))
            .where(F.col("trust") >= LEAST_PATTERN), "patterns",
        )
        found = edges.where("kind is null").join(patterns, "pattern").groupBy(
            "instance", "of"
        ).agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-9)))))).alias("score"),
            F.count_distinct("pattern").alias("patterns"),
        ).where((F.col("patterns") >= LEAST_PATTERNS) & (F.col("score") >= LEAST_INSTANCE))
        # an instance is of the kind that scores highest, the first one on ties
        best = written(
            found.groupBy("instance").agg(
                F.max(F.struct("score", (-F.col("of")).alias("order"))).alias("best")
            ).select(
                "instance", (-F.col("best.order")).alias("of"), F.col("best.score").alias("score")
            ).join(seeds.select("instance"), "instance", "left_anti"), "best",
        )
        known = seeds.unionByName(best)
    return best.withColumnRenamed("of", "kind")


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans), one row per input row.

    Takes doc_id and text; other columns are left out. Both are arrays of (kind number, start,
    end) in that order, in code points; ``base`` has the entities of the base rules and
    ``spans`` has them and the learnt ones. A null or empty text has none. Repeated rows are
    looked at each on its own and count as often for the patterns. An empty table gives no
    rows.
    """
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    sighted = written(
        sightings(rows.select(F.struct("doc_id", "row").alias("doc_id"), "text"))
        .select("doc_id.doc_id", "doc_id.row", "base", "seen"), "sightings",
    )
    learnt = learn_instances(sighted).select("instance", F.col("kind").alias("of"))
    extra = (
        sighted.select("row", F.explode("seen").alias("s")).where("s.kind is null")
        .select("row", "s.start", "s.end", "s.instance").join(learnt, "instance")
        .groupBy("row").agg(F.collect_list(F.struct(
            F.col("of").alias("kind"), "start", "end"
        )).alias("extra"))
    )
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return sighted.select("doc_id", "row", "base").join(extra, "row", "left").select(
        "doc_id", "base",
        F.array_sort(F.concat("base", F.coalesce("extra", none))).alias("spans"),
    )


def masked(docs: DataFrame) -> DataFrame:
    """Documents with their entities replaced by [EMAIL], [IP], [CARD] or [PHONE].

    All columns stay; ``n_chars``, where there is one, follows the text. Of entities that
    overlap the earliest is replaced, of those that begin together the longest; what another
    one leaves over is replaced too. A null text stays null.
    """
    found = extract(docs.select(
        F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc_id"), "text"
    )).where(F.size("spans") > 0).groupBy("doc_id").agg(F.first("spans").alias("spans")).select(
        F.col("doc_id.doc_id").alias("id"), F.col("doc_id.h").alias("h"), "spans"
    )
    joint = whole_rows(docs, "doc_id", "text", F.xxhash64("text").alias("hash")).join(
        found, null_safe("doc_id", "id") & (F.col("hash") == F.col("h")), "left"
    )
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")
    )))
    kinds = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")
    cut = F.aggregate(
        ordered, begun,
        lambda a, s: F.when(-s["back"] <= a["at"], a).otherwise(F.struct(
            (-s["back"]).alias("at"),
            F.concat(
                a["out"], F.substr(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))),
                F.get(kinds, s["kind"]),
            ).alias("out"),
        )),
        lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)),
    )
    masks = F.when(F.col("spans").isNotNull(), cut).otherwise(text)
    changed = {"text": masks}
    if "n_chars" in docs.columns:
        stated = F.col("_whole").getField("n_chars")
        changed["n_chars"] = F.when(F.col("spans").isNull(), stated).otherwise(
            F.length("masked")).cast(docs.schema["n_chars"].dataType)
        changed["text"] = F.col("masked")
        joint = joint.withColumn("masked", masks)
    return restored(joint, docs, **changed)


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    def number_of(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return extract(documents(spark, sf_dir)).select(
        "doc_id",
        *(number_of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
