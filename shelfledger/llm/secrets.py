"""Secret scans through a trigram inverted index.

From each rule's regex a Boolean query over trigrams is derived: an OR of ANDs of trigrams that
every match must hold. The index has a posting (trigram, text key) for each trigram that some
query names and each distinct text that holds it. Postings are intersected and united per text
key as the query says; only the candidates left are searched with the regex itself. A rule
without mandatory trigrams searches every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.llm.common import documents, let, written


@dataclass(frozen=True)
class Rule:
    """``pattern`` is made of literals, classes, groups, ``?``, ``+``, ``*`` and ``{n}``.

    ``checked`` is the group whose length must reach ``least``; 0 is the whole match.
    """

    kind: str
    pattern: str
    least: int = 1
    checked: int = 0
    base: bool = False


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        least=6, checked=2, base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    # a run of hex digits counts from 24 on, so shorter runs need not be matched
    Rule("hex", r"[0-9a-f]{24,}", least=24, base=True),
)
#: Public credential formats whose prefix alone tells them apart.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

#: A class or choice of more texts than this is not spelt out for the query.
MOST_CHOICES = 16


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The OR of ANDs of lower-case trigrams each match must hold; [] if there is none.

    The pattern is read as a sequence of pieces. Alternatives of literals and small classes are
    spelt out, a piece that may repeat or has a large class ends a literal run.
    """
    runs: list[list[str]] = [[""]]  # the texts each run may be
    for texts, exact in _pieces(pattern):
        if texts is None:
            runs.append([""])
            continue
        grown = [a + b for a in runs[-1] for b in texts]
        if len(grown) > MOST_CHOICES:
            runs.append(texts)
        else:
            runs[-1] = grown
        if not exact:
            runs.append([""])
    options: list[frozenset[str]] = [frozenset()]
    for run in runs:
        grams = [frozenset(x[i:i + 3].lower() for i in range(len(x) - 2)) for x in run]
        if all(grams):
            options = [a | b for a in options for b in dict.fromkeys(grams)]
    return [] if options == [frozenset()] else list(dict.fromkeys(options))


def _pieces(pattern: str):
    """(texts or None, whether the piece stands once and no more) for each piece in turn."""
    i = 0
    while i < len(pattern):
        c = pattern[i]
        texts: list[str] | None
        if c == "[":
            end = pattern.index("]", i + 2)
            body = pattern[i + 1:end]
            small = "-" not in body and "\\" not in body and len(body) <= MOST_CHOICES
            texts = list(body) if small else None
            i = end + 1
        elif c == "(":
            depth, end = 1, i + 1
            while depth:
                depth += {"(": 1, ")": -1}.get(pattern[end], 0)
                end += 1
            body = pattern[i + 1:end - 1]
            while body.startswith(("?i:", "?:")) or (body.startswith("(") and body.endswith(")")):
                body = body.split(":", 1)[1] if body.startswith("?") else body[1:-1]
            texts = []
            for branch in body.split("|"):
                found = [""]
                for sub, exact in _pieces(branch):
                    found = None if sub is None or not exact else [
                        a + b for a in found for b in sub
                    ]
                    if found is None:
                        break
                texts = None if found is None else texts + found
                if texts is None:
                    break
            i = end
        elif c == "\\":
            code = pattern[i + 1]
            texts = [chr(int(pattern[i + 2:i + 4], 16))] if code == "x" else [code]
            i += 4 if code == "x" else 2
        else:
            texts, i = [c], i + 1
        mark = pattern[i:i + 1]
        if mark == "{":
            i = pattern.index("}", i) + 1
            yield (texts, False)
        elif mark in ("*", "?") and mark:
            i += 1
            yield (None if mark == "*" or texts is None else [*texts, ""], True)
        elif mark == "+":
            i += 1
            yield (texts, False)
        else:
            yield (texts, True)


def postings(texts: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, key): which texts of ``texts(key, text)`` hold which trigrams, in either case."""
    low = let(F.lower("text"), lambda t: F.filter(
        F.array(*(F.when(F.contains(t, F.lit(g)), F.lit(n)) for n, g in enumerate(grams))),
        lambda n: n.isNotNull(),
    ))
    return texts.select("key", F.explode(low).alias("gram"))


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rules): the rules whose trigram query a text fulfils, by their number."""
    queries = {n: trigram_query(r.pattern) for n, r in enumerate(rules)}
    grams = sorted({g for q in queries.values() for option in q for g in option})
    number = {g: n for n, g in enumerate(grams)}
    held = postings(texts, grams).groupBy("key").agg(F.collect_set("gram").alias("held"))

    def fulfilled(query: list[frozenset[str]]) -> Column:
        found = F.lit(False)
        for option in query:
            need = F.array(*(F.lit(number[g]) for g in sorted(option)))
            found = found | (F.size(F.array_intersect("held", need)) == len(option))
        return found

    return held.select("key", F.filter(
        F.array(*(F.when(fulfilled(q), F.lit(n)) for n, q in queries.items() if q)),
        lambda n: n.isNotNull(),
    ).alias("rules")).where(F.size("rules") > 0)


def matches(text: Column, rule: Rule) -> Column:
    """All spans of a rule in a text: array of (start, end, kind number is added later).

    The pieces between the matches and the matches themselves take turns, so their lengths give
    the places, in code points.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.checked)) if rule.checked else whole

    def spans(gaps: Column, found: Column, part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>")
                         .alias("out"))
        step = F.transform(found, lambda m, i: F.struct(
            F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("len"),
            (F.length(F.get(part, i)) >= rule.least).alias("good"),
        ))
        return F.aggregate(step, start, lambda a, s: F.struct(
            (a["at"] + s["gap"] + s["len"]).alias("at"),
            F.when(s["good"], F.concat(a["out"], F.array(F.struct(
                (a["at"] + s["gap"]).alias("start"),
                (a["at"] + s["gap"] + s["len"]).alias("end"),
            )))).otherwise(a["out"]).alias("out"),
        ))["out"]

    none = F.array().cast("array<struct<start:int,end:int>>")
    return let(whole, lambda found: F.when(F.size(found) == 0, none).otherwise(
        let(F.split(text, rule.pattern, -1), lambda gaps: spans(
            gaps, found, checked if rule.checked else found
        ))
    ))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) with spans an array of (start, kind number, end) in that order.

    Takes doc_id and text, one row out per row in; other columns are left out. A null or empty
    text has no spans. Equal texts share their index entry, whatever their ids; a key that two
    texts share only adds a candidate, which is verified like any other. Matches of different
    rules may overlap; those of one rule do not. An empty table gives no rows.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "key", F.xxhash64("text")
    )
    # from a written table, so that a text with most of the copies can be split in the join
    found = written(candidates(keyed.select("key", "text"), rules), "candidates")
    searched = keyed.join(found, "key", "left")
    spans = []
    for n, rule in enumerate(rules):
        hits = F.transform(matches(F.col("text"), rule), lambda s: F.struct(
            s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end")
        ))
        if trigram_query(rule.pattern):
            none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
            hits = F.when(F.array_contains(F.coalesce("rules", F.array()), n), hits).otherwise(
                none
            )
        spans.append(hits)
    return searched.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))


def joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def number_of(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    found = scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    return found.select(
        "doc_id",
        *(number_of(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE_RULES)),
        F.sha2(joined(base, RULES), 256).alias("base_sha256"),
        joined(F.col("spans"), RULES).alias("spans"),
    )


def _hits_sql(number: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
    SELECT row_no, {number} AS rule, '{rule.kind}' AS kind, {rule.least} AS least,
        unnest(regexp_extract_all(text, '{pattern}')) AS found,
        unnest(regexp_extract_all(text, '{pattern}', {rule.checked})) AS checked,
        unnest(string_split_regex(text, '{pattern}')) AS gap,
        unnest(range(len(regexp_extract_all(text, '{pattern}')) + 1)) AS place
    FROM texts"""


_HITS_SQL = "\n    UNION ALL".join(_hits_sql(n, r) for n, r in enumerate(RULES))
_COUNTS_SQL = ",\n    ".join(
    f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES
)
#: The pieces between a rule's matches and the matches take turns, which gives their places.
OP8_SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
), pieces AS ({_HITS_SQL}
), placed AS (
    SELECT *, sum(length(gap)) OVER w + sum(length(found)) OVER w - length(found) AS start
    FROM pieces WINDOW w AS (PARTITION BY row_no, rule ORDER BY place)
), spans AS (
    SELECT *, kind || ':' || start || ':' || (start + length(found)) AS span
    FROM placed WHERE length(checked) >= least
)
SELECT any_value(doc_id) AS doc_id, {_COUNTS_SQL},
    sha256(coalesce(string_agg(span, ',' ORDER BY start, rule)
        FILTER (rule < {len(BASE_RULES)}), '')) AS base_sha256,
    coalesce(string_agg(span, ',' ORDER BY start, rule), '') AS spans
FROM texts LEFT JOIN spans USING (row_no) GROUP BY row_no
"""
