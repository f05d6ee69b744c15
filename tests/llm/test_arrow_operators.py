"""Personal data, packing, languages, web archives and near copies against plain Python."""

import collections
import itertools
import pathlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edge_cases import ROWS, edge_frame, no_rows
from shelfledger.llm import common, graph, jaccard, languages, packing, personal, warc
from shelfledger.llm.common import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- personal data ------------------------------------------------------------------------

def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(s):
    out = [(0, *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", s)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", s):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", s)
                  if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_rules_match_plain_patterns():
    rng = random.Random(4)
    letters = list("ab1290.@-+ ()%2355.")
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert personal.base_spans(text) == plain_spans(text)


def test_personal_data_of_documents(spark, small):
    texts = {r.doc_id: r.text for r in documents(spark, small).collect()}
    found = personal.op1_personal_data(spark, small).collect()
    assert len(found) == len(texts)
    for r in found:
        spans = plain_spans(texts[r.doc_id])
        kinds = collections.Counter(k for k, _, _ in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in range(4)]


def test_contexts_find_unseen_identifiers(spark):
    """Numbers no rule matches, where phones are given in the same words."""
    rng = random.Random(2)
    rows = [(i, f"please call me at +1 (555) 010-{rng.randrange(1000, 9999)} before noon today")
            for i in range(40)]
    rows += [(100 + i, f"please call me at 0015550{i:04d} before noon today") for i in range(3)]
    rows += [(200 + i, f"the order number {rng.randrange(10**9)} was shipped late") for i in range(30)]
    rows.append((300, "please call me at home before noon today"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in personal.extract(docs).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        spans = [text[s.start:s.end] for s in found[i].spans]
        if i < 40:
            assert len(spans) == 1 and found[i].base == found[i].spans
        elif i < 200:
            assert spans == [text.split()[4]] and not found[i].base
            assert personal.KINDS[found[i].spans[0].kind] == "phone"
        else:
            assert not spans
    masked = {r.doc_id: r.text for r in personal.masked(docs).collect()}
    assert masked[0] == masked[100] == "please call me at [PHONE] before noon today"
    assert masked[200] == dict(rows)[200]


def test_personal_edges(spark):
    df = edge_frame(spark)
    assert personal.extract(df).count() == len(ROWS)
    masked = personal.masked(df)
    assert masked.columns == df.columns and masked.exceptAll(df).isEmpty()
    assert personal.extract(no_rows(spark)).count() == 0


# ---- packing ------------------------------------------------------------------------------

def padding(n, width):
    return 0 if n & (n - 1) == 0 and n >= 256 else width - n


def test_cuts_are_the_cheapest():
    rng = random.Random(6)
    for _ in range(60):
        at = np.unique(np.cumsum([rng.randint(1, 200) for _ in range(rng.randint(1, 14))]))
        cost = np.array([rng.choice([0.0, 1.0, 2.0, 8.0]) for _ in at])
        place, price = [0, *at.tolist()], [0.0, *cost.tolist()]
        best = [0.0] + [float("inf")] * (len(place) - 1)
        for j in range(1, len(place)):
            for i in range(j):
                if place[j] - place[i] <= 512:
                    n = place[j] - place[i]
                    free = n in (256, 512)
                    best[j] = min(best[j], best[i] + (0 if free else 512 - n) + price[j]
                                  + packing.PER_WINDOW)
        cuts = packing.best_cuts(at, cost, 512)
        ends = [0] + [int(at[c]) for c in cuts]
        total = sum(price[c + 1] for c in cuts) + sum(
            (0 if b - a in (256, 512) else 512 - (b - a)) + packing.PER_WINDOW
            for a, b in itertools.pairwise(ends))
        assert ends[-1] == at[-1] and total == pytest.approx(best[-1])


def token_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids + [1] for e in t.encode_batch(texts, add_special_tokens=False)]


def check_pieces(rows, docs):
    """Pieces hold each document's ids once and in order, sequences have no gaps."""
    expected = collections.Counter()
    for (i, _), ids in zip(docs, token_ids([t or "" for _, t in docs]), strict=True):
        expected[i, tuple(ids)] += 1
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, len(r.ids) // 4, r.doc_id, r))
    found, opened = collections.Counter(), {}
    for key in sorted(sequences):
        at = 0
        for offset, length, _, r in sorted(sequences[key], key=lambda x: x[0]):
            assert offset == at and length > 0
            at += length
            if r.start == 0:
                opened[r.doc_id] = b""
            assert len(opened[r.doc_id]) == 4 * r.start
            opened[r.doc_id] += r.ids
            if len(opened[r.doc_id]) == 4 * r.doc_tokens:
                ids = np.frombuffer(opened.pop(r.doc_id), dtype="<u4").tolist()
                found[r.doc_id, tuple(ids)] += 1
        assert at <= packing.WIDTH
    assert not opened and found == expected


def test_pieces_are_the_documents(spark, small):
    docs = documents(spark, small)
    rows = packing.pack(docs).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()])
    lengths = collections.Counter()
    for r in rows:
        lengths[r.sequence_id] += len(r.ids) // 4
    waste = sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths.values())
    assert waste <= 0.03 * sum(lengths.values())
    sample = packing.digest(packing.pack(docs)).filter("doc_id = 5").orderBy("start").collect()
    ids = np.array(token_ids([docs.filter("doc_id = 5").first().text])[0], dtype="<u4")
    for r in sample:
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())


def test_words_have_the_ids_they_have_in_texts():
    import public_tokenizers

    rng = random.Random(8)
    letters = list("aZ9 \n\t'.<|>éßΣİ \x1c\x7f\x85#~st") + ["<|endoftext|>", "'ll", "'S", "re"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    coder = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    assert coder.latin is not None
    for latin in (coder.latin, None):
        coder.forget()
        coder.latin = latin
        expected = token_ids(texts)
        for step in (1, 7, 4000):
            for low in range(0, 4000 if step > 1 else 300, step):
                part = expected[low:low + step]
                ids, opened, at, cost = coder.encode(pa.array(texts[low:low + step]))
                assert ids.tolist() == [i for e in part for i in e]
                assert np.diff(opened).tolist() == [len(e) for e in part]
                assert at[-1] == len(ids) and len(at) == len(cost)
                assert set(opened[1:].tolist()) <= set(at[cost == 0].tolist())
                assert np.diff(at, prepend=0).max() <= packing.LONGEST


def test_merges_of_the_whole_vocabulary():
    """Each symbol is made of its own bytes, as the tokenizer makes it."""
    import public_tokenizers

    coder = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    vocab = coder.tokenizer.get_vocab()
    code = {c: b for b, c in enumerate(packing._byte_letters())}
    rng, words = random.Random(3), set()
    for token in vocab:
        try:
            text = bytes(code[c] for c in token.removesuffix("</w>")).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        words |= {text, text + rng.choice(["s", "ing", "ß", ".", "'ll", "7"])}
    words = sorted(w for w in words if packing._LATIN.fullmatch(w) and w == w.lower()
                   and not coder.special.search(w))
    words += ["".join(rng.choice("abcdeilmnorstuéßü") for _ in range(rng.randrange(1, 14)))
              for _ in range(20_000)]
    assert len(words) > 80_000
    ids, sizes = coder.latin(words)
    coded = coder.tokenizer.encode_batch(words, add_special_tokens=False)
    assert sizes.tolist() == [len(c) for c in coded]
    assert ids.tolist() == [i for c in coded for i in c.ids]


def test_places_to_cut():
    import public_tokenizers

    coder = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    text = "the end. the day\nthe end of the day\n\n a"
    _, _, at, cost = coder.encode(pa.array([text, None, "the day"]))
    n = len(token_ids([text])[0]) - 1
    after = [len(token_ids([t])[0]) - 1 for t in
             ("the end.", "the end. the day", "the end. the day\nthe end of the day", text)]
    assert at.tolist() == [*after, n + 1, n + 2, n + 4, n + 5]
    assert cost.tolist() == [2.0, 1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0]


def test_cuts_do_not_hang_on_stretches():
    """A line that comes in stretches gets the cuts of the whole line."""
    rng = random.Random(9)
    for width in (512, 2048):
        at = np.unique(np.cumsum([rng.randint(1, 60) for _ in range(3000)]))
        cost = np.array([rng.choice([0.0, 1.0, 2.0, 8.0]) for _ in at])
        whole = at[packing.best_cuts(at, cost, width)].tolist()
        for step in (1, 17, 400):
            cuts, found, kept = packing.Cuts(width), [], 0
            for low in range(0, len(at), step):
                cuts.add(at[low:low + step], cost[low:low + step])
                found += cuts.settled()
                kept = max(kept, len(cuts.where))
            assert found + cuts.settled(last=True) == whole
            assert kept <= len(at) + 1


def test_other_ids(spark):
    for kind in ("string", "decimal(20,0)", "struct<a: bigint, b: string>"):
        value = {"string": "'x'", "decimal(20,0)": "7"}.get(kind, "named_struct('a', 1L, 'b', 'y')")
        docs = spark.range(3).selectExpr(f"CAST({value} AS {kind}) AS doc_id", "'some text' AS text")
        assert sum(r.start == 0 for r in packing.pack(docs).collect()) == 3


def test_packing_edges(spark):
    rows = packing.pack(edge_frame(spark)).collect()
    assert sum(len(r.ids) // 4 == 1 and r.doc_tokens == 1 for r in rows) >= 4
    assert sum(r.start == 0 for r in rows) == len(ROWS)
    assert packing.pack(no_rows(spark)).count() == 0


# ---- languages ----------------------------------------------------------------------------

def test_held_out_accuracy(spark, small):
    sf = small.replace("sf0.001", "sf0.01")
    found = languages.op7_languages(spark, sf).join(
        documents(spark, sf).select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 1000
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_prediction_depends_on_text_alone(spark, small):
    docs = documents(spark, small)
    model = languages.learn(docs)
    one = languages.identify(docs, model).select("doc_id", "lang_pred", "score")
    other = languages.identify(
        docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y")}), model
    ).select("doc_id", "lang_pred", "score")
    assert one.exceptAll(other).isEmpty()
    assert {(a, b) for a, b in model.pairs} == {("de", "en"), ("es", "fr")}


def test_language_edges(spark):
    df = edge_frame(spark)
    found = languages.identify(df).collect()
    assert len(found) == len(ROWS)
    lone = [r for r in found if r.lang_pred == "und"]
    assert len(lone) == 5 and all(r.score == 0 for r in lone)
    kept = languages.known_language(df)
    assert kept.columns == df.columns and kept.count() == len(ROWS) - 5
    assert kept.filter("lang is null").isEmpty()
    assert languages.identify(no_rows(spark)).count() == 0
    no_labels = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in languages.identify(no_labels).collect()} == {"und"}


# ---- web archives -------------------------------------------------------------------------

PAGES = [
    (1, "http://a.example/x", "<html lang='de'><head><title>T &amp; U</title><script>no()</script>"
     "</head><body><p>One<p>Two <b>bold</b><!-- no --><br>three<a href='/y'>link</a>"),
    (1, "http://a.example/x", "<html lang='de'><head><title>T &amp; U</title><script>no()</script>"
     "</head><body><p>One<p>Two <b>bold</b><!-- no --><br>three<a href='/y'>link</a>"),
    (2, None, "<p>no target, <script>never closed"), (3, "http://b.example", None),
    (None, "http://c.example", "plain text < 5 & more"), (5, "", ""),
    (6, "http://d.example", "<p>" + "x " * 50_000 + "<" * 2000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'c' AS block", "'c' AS headers", "'c' AS warc_type")


@pytest.mark.parametrize("page,text", [
    ("\u0130" * 12 + "<script>x</script>kept text<p>more</p>", "\u0130" * 12 + "kept text\nmore"),
    ("a<STYLE>x</sTyLe >b<script>y</scripts></script>c", "abc"),
    ("a<svg>b<p>c</p><svg>d", "ab\nc\nd"), ("a<noscript>b", "ab"), ("a<template>b", "ab"),
    ("a<script>b<p>c", "a"), ("a<svg>b</svg>c", "ac"),
])
def test_text_behind_raw_elements(page, text):
    assert warc.page_text(page)[0] == text


def test_derived_records(spark):
    given = warc.responses(pages(spark)).collect()
    made = warc.derive(warc.responses(pages(spark))).collect()
    assert len(given) == len(PAGES) and len(made) == 2 * len(PAGES)
    by = {r.record_id: r for r in given}
    for r in made:
        source = by[r.refers_to]
        named = {h.name: h.value for h in r.headers}
        assert (r.page_id, r.target_uri, r.date) == (source.page_id, source.target_uri, source.date)
        assert named["WARC-Source-Block-Digest"] == source.block_digest
        assert named["WARC-Source-Payload-Digest"] == source.payload_digest
        assert r.block_digest == warc.digest(bytes(r.block)) and r.length == len(r.block)
    first = {r.warc_type: bytes(r.block).decode() for r in made if r.page_id == 1}
    assert first["conversion"] == "T & U\nOne\nTwo bold\nthreelink"
    fields = first["metadata"].split("\r\n")
    assert {"title: T & U", "language: de", "outlink: /y", "status: HTTP/1.1 200 OK",
            "source-content-type: text/html; charset=utf-8"} <= set(fields)
    assert warc.derive(warc.responses(pages(spark, []))).count() == 0


def test_archive_round_trip(spark, tmp_path):
    records = warc.responses(pages(spark)).union(warc.derive(warc.responses(pages(spark))))
    written = warc.write_warc(records, str(tmp_path / "w")).collect()
    assert sum(r.records for r in written) == 3 * len(PAGES)
    back = warc.read_warc(spark, str(tmp_path / "w"))
    columns = ["warc_type", "record_id", "refers_to", "content_type", "length", "block_digest",
               "payload_digest", "headers", "block"]
    a = sorted(map(str, records.select(*columns).collect()))
    b = sorted(map(str, back.select(*columns).collect()))
    assert a == b
    derived = warc.derive(back).count()
    assert derived == 2 * len(PAGES)


def test_every_page_gives_two_records(spark, small):
    rows = warc.op9_warc(spark, small).collect()
    n = spark.read.parquet(f"{small}/pages.parquet").count()
    assert collections.Counter(r.warc_type for r in rows) == {"metadata": n, "conversion": n}


# ---- near copies --------------------------------------------------------------------------

def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)])


def plain_components(docs, like):
    sets = [shingles(t, like.width) for _, t in docs]
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(docs)), 2):
        x, y = sets[a], sets[b]
        if x and y and like.den * len(x & y) >= like.num * len(x | y):
            root[top(a)] = top(b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return collections.Counter(
        (doc_id, len(sets[i]), least[top(i)]) for i, (doc_id, _) in enumerate(docs))


def near_copy_corpus(seed, n=140):
    """Families of edited copies, exact copies, a shared passage, and short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(12))
    docs = []
    for family in range(6):
        base = [rng.choice(words) for _ in range(rng.randint(5, 90))]
        for _ in range(rng.choice([1, 3, 12, 30])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
            docs.append(" ".join(text) + (f" {passage}" if rng.random() < 0.2 else ""))
    while len(docs) < n:
        docs.append(" ".join(rng.choice(words) for _ in range(rng.randint(0, 8))) + " " + passage)
    docs += [docs[0].upper(), docs[0], "", " \n", "one", "One", "two words", None]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed,region,block,depth", [(1, 32, 256, 2), (2, 2, 4, 2), (3, 1, 3, 3)])
def test_near_copies_match_all_pairs(spark, monkeypatch, seed, region, block, depth):
    monkeypatch.setattr(jaccard, "REGION", region)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "DEPTH", depth)
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 5)
    docs = near_copy_corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for like in (jaccard.Likeness(), jaccard.Likeness(5, 80, 100)):
        found = collections.Counter(tuple(r) for r in jaccard.near_copies(frame, like).collect())
        assert found == plain_components(docs, like)


def test_near_copies_of_documents(spark, small):
    docs = [(r.doc_id, r.text) for r in documents(spark, small).collect()]
    found = collections.Counter(tuple(r) for r in jaccard.op10_jaccard_join(spark, small).collect())
    assert found == plain_components(docs, jaccard.Likeness())


def runs_of_session(spark):
    """The session's queries by their number; the oldest are forgotten at some time."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {e.executionId(): e for e in (found.apply(i) for i in range(found.size()))}


def test_tables_of_near_copies_are_not_sent_to_all_tasks(spark, monkeypatch):
    """How many rows they have, or get by exploding, doesn't show in the size of their files."""
    for name, value in (("REGION", 2), ("BLOCK", 4), ("LEAST_FREQUENT", 5), ("PIECE_BITS", 4)):
        monkeypatch.setattr(jaccard, name, value)
    docs = near_copy_corpus(4)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    before = runs_of_session(spark)
    found = collections.Counter(tuple(r) for r in jaccard.near_copies(frame).collect())
    assert found == plain_components(docs, jaccard.Likeness())
    plans = [e.physicalPlanDescription() for k, e in runs_of_session(spark).items() if k not in before]
    assert sum("SortMergeJoin" in p for p in plans) > 5
    assert not [p for p in plans if "Broadcast" in p]


def test_the_most_frequent_shingles_are_told_apart(spark, monkeypatch):
    """As many whole classes of counts as stay within the limit, the highest first."""
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 2)
    texts = [t for i, times in enumerate((9, 9, 5, 5, 5, 2)) for t in [f"only{i}"] * times]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    for limit, many in ((6, 6), (5, 5), (4, 2), (2, 2), (1, 0)):
        monkeypatch.setattr(jaccard, "FREQUENT", limit)
        assert len(jaccard.frequent_shingles(frame, jaccard.Likeness())) == many


def test_tables_of_links_have_few_files(spark):
    """Not one of a few rows for each shuffle partition."""
    was = {k: spark.conf.get(f"spark.sql.{k}") for k in (
        "shuffle.partitions", "adaptive.coalescePartitions.enabled")}
    tables, dealt = [], 64
    try:
        for k, v in zip(was, (str(dealt), "false"), strict=True):
            spark.conf.set(f"spark.sql.{k}", v)
        with common.noted(tables):
            found = graph.components(spark.range(500).selectExpr("2 * id AS a", "2 * id + 1 AS b"))
            assert found.where("label = 2 * floor(node / 2)").count() == 1000
    finally:
        for k, v in was.items():
            spark.conf.set(f"spark.sql.{k}", v)
    files = [
        len(list(pathlib.Path(path.removeprefix("file://")).glob("part-*"))) for path in tables
    ]
    assert files and max(files) <= max(dealt // 32, spark.sparkContext.defaultParallelism), files


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)]
    found = {r.node: r.label for r in graph.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_near_copy_edges(spark):
    df = edge_frame(spark)
    found = jaccard.near_copies(df).collect()
    assert len(found) == len(ROWS)
    assert all(r.component_id == r.doc_id for r in found)
    kept = jaccard.distinct_documents(df)
    assert kept.columns == df.columns and kept.count() == len(ROWS) - 1
    assert jaccard.near_copies(no_rows(spark)).count() == 0
    assert jaccard.distinct_documents(no_rows(spark)).count() == 0
