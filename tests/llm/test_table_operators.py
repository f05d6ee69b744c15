"""Line dedup, divergence of sources and whitening against plain Python and against SQL."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TABLES
from edge_cases import CLASHES, LONG, ROWS, SCHEMA, edge_frame, no_rows
from shelfledger.llm import divergence, line_runs, queries, whitening
from shelfledger.llm.common import documents, shared_path

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = str.maketrans(UPPER, UPPER.lower())


def frame(spark, rows):
    """Documents of (doc_id, text, lang, source) with clashing names."""
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(3)
    return df.selectExpr("*", *[f"'c' AS `{c.replace('`', '``')}`" for c in CLASHES])


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, small, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small}/{table}.parquet')")
    df = queries.QUERIES[name](spark, small)
    cursor = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    found = sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))
    assert found == sorted(map(repr, cursor.fetchall()))


# ---- lines --------------------------------------------------------------------------------

def key_of(line):
    return line.strip(BLANKS).translate(LOWERED)


def without_repeats(rows):
    """(doc_id, kept text, lines, dropped) in plain Python; no id comes last."""
    least = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            rank = (i is None, i or 0)
            least[key_of(line)] = min(least.get(key_of(line), rank), rank)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < 10 or least[key_of(x)] == (i is None, i or 0)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def lined(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "kept_text", "n_lines", "n_dropped").collect()), key=str)


HARD_LINES = [
    (3, "A line of several documents\nown line number three\n\na LINE of several documents \n",
     "en", "a"),
    (1, "\ta line of Several documents\r\nshort one\nshort one", "en", "a"),
    (2, "a line of several documents", "en", "a"),
    (2, "a line of several documents", "en", "a"),
    (2, "another row of the same document\na line of several documents", "en", "a"),
    (None, "a line of several documents\nonly without an id, twice\nonly without an id, twice",
     "en", "a"),
    (None, "only without an id, twice", "en", "a"),
    (9, "ÄPFEL sind keine äpfel\nÄpfel SIND keine äpfel\näpfel sind keine äpfel", "de", "a"),
    (8, "äpfel sind keine äpfel", "de", "a"),
    (7, "\x0b1234567890\x0c\n123456789\n 123456789 ", "de", "a"),
    (6, "1234567890\n123456789", "de", "a"),
    (5, "\n\n\n", None, None), (4, "\n".join(f"line number {i % 700}" for i in range(3000)), "en", "b"),
    (10, "\n".join(f"Line Number {i}" for i in range(0, 3000, 3)), "en", "b"),
    (11, LONG + "\n" + LONG, "en", "b"), (12, "x\n" + LONG, "en", "b"), (13, None, None, None),
]


@pytest.mark.parametrize("batches", [1, 2, 6])
def test_lines_match_plain_python(spark, small, batches):
    rows = [tuple(r) for r in documents(spark, small).collect()]
    assert lined(line_runs.dedup_lines(documents(spark, small), batches)) == without_repeats(rows)
    assert lined(line_runs.dedup_lines(frame(spark, HARD_LINES), batches)) == (
        without_repeats(HARD_LINES))
    assert lined(line_runs.dedup_lines(edge_frame(spark), batches)) == without_repeats(ROWS)


def test_lines_of_an_empty_table_and_of_other_ids(spark):
    assert line_runs.dedup_lines(no_rows(spark)).collect() == []
    named = spark.createDataFrame(
        [("b", "the same long line"), ("a", "the same long line")], "doc_id string, text string")
    assert lined(line_runs.dedup_lines(named)) == [
        ("a", "the same long line", 1, 0), ("b", "", 1, 1)]


def test_runs_go_on_level_by_level(spark):
    """Batches of one index: each line stays where it came first; levels merge at four runs."""
    rng = random.Random(5)
    folder = shared_path(spark, "test-runs")
    seen, levels = set(), []
    for b in range(9):
        rows = [(100 * b + i, "\n".join(f"line with the number {rng.randrange(400)}"
                                        for _ in range(6)), "en", "a") for i in range(10)]
        # the index is opened anew for each batch, as a later job would
        runs = line_runs.LineRuns(spark, folder)
        found = lined(line_runs.dedup_lines(frame(spark, rows), 1, runs))
        expected, fresh = [], {}
        for i, text, *_ in rows:
            kept = [x for x in text.split("\n") if x not in seen and fresh.setdefault(x, i) == i]
            expected.append((i, "\n".join(kept), 6, 6 - len(kept)))
        assert found == sorted(expected, key=str)
        seen |= set(fresh)
        levels.append(sorted(r[0] for r in runs.runs))
        runs.close()
    assert levels[2:5] == [[0, 0, 0], [1], [0, 1]] and levels[8] == [0, 1, 1]


def test_a_batch_that_failed_can_be_repeated(spark):
    runs = line_runs.LineRuns(spark, shared_path(spark, "test-runs"))
    lines = spark.range(5).selectExpr("id AS h1", "id AS h2", "id AS doc_id")
    assert runs.stage(lines).count() == 5  # written, but the job ends here
    again = line_runs.LineRuns(spark, runs.folder)
    assert again.runs == [] and again.stage(lines).count() == 5
    again.commit()
    assert again.stage(lines).count() == 0
    with pytest.raises(ValueError):
        line_runs.LineRuns(spark, runs.folder).commit()


def test_runs_are_joined_where_they_lie(spark):
    """A merge join per run, and no exchange of a run."""
    runs = line_runs.LineRuns(spark, shared_path(spark, "test-runs"))
    lines = spark.range(5).selectExpr("id AS h1", "id AS h2", "id AS doc_id")
    for _ in range(2):
        runs.stage(lines)
        runs.commit()
    fresh = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    for _, name, buckets in runs.runs:
        fresh = fresh.join(
            runs._run(name, buckets).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1


# ---- divergence ---------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audited(rows, least=10):
    """The audit in plain Python."""
    counts, held, sources = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        terms = [t.translate(LOWERED) for t in TERM.findall(text or "")]
        counts.update((lang, source, t) for t in terms)
        held.update((lang, t) for t in set(terms))
    out = []
    for lang, names in sources.items():
        kept = sorted(t for (g, t), n in held.items() if g == lang and n >= least)
        of = {s: [counts[lang, s, t] for t in kept] for s in names}
        whole = [sum(c) for c in zip(*of.values(), strict=True)]

        def prob(c, n):
            return 1 + 10**9 * (c + 2) // (n + 2 * len(kept))

        def value(p, q):
            return (p - q) ** 2 // (p + q)

        for s in names:
            n = sum(of[s])
            priced = [(s, o, sum(value(prob(x, n), prob(y, sum(of[o])))
                                 for x, y in zip(of[s], of[o], strict=True)))
                      for o in names if o != s]
            part = sorted(priced, key=lambda r: (-r[2], r[1].encode()))
            out += [(lang, s, "pair", o, v, i + 1) for i, (_, o, v) in enumerate(part)]
            pq = [(t, prob(c, n), prob(w, sum(whole)))
                  for t, c, w in zip(kept, of[s], whole, strict=True) if c]
            top = sorted(((t, value(p, q)) for t, p, q in pq if p > q),
                         key=lambda r: (-r[1], r[0].encode()))[:10]
            out += [(lang, s, "term", t, v, i + 1) for i, (t, v) in enumerate(top)]
    return sorted(out)


def found_by(df):
    return sorted(tuple(r) for r in df.select(
        "lang", "source", "part", "item", "value", "rank").collect())


def worded(spark, n_sources=30):
    rng = random.Random(7)
    terms = ["Ünder", "under", "UNDER", "ß", "日本", "a'b", "x1y"] + [f"w{'abcdefghij'[i % 10]}{'xyz'[i % 3]}"
                                                                 for i in range(30)]
    rows = [(i, " ".join(rng.choices(terms, k=rng.randrange(12))), "en", f"s{i % n_sources}")
            for i in range(200)]
    rows += [(i, "few words", "fr", f"s{i % 3}") for i in range(9)]  # nothing kept
    rows += [(i, "alone in its language", "de", "only") for i in range(12)]
    rows += [(500, None, "en", "without words"), (501, "", "en", None), (502, "1 2 3", None, "s1"),
             (503, None, None, None), (1, rows[1][1], "en", "s1"), (504, "many " * 50_000, "en", "s2")]
    return rows


def test_divergence_matches_plain_python(spark, small, monkeypatch):
    rows = worded(spark)
    expected = audited(rows)
    assert found_by(divergence.audit(frame(spark, rows))) == expected
    assert any(r[1] == "without words" for r in expected)
    docs = documents(spark, small)
    assert found_by(divergence.audit(docs)) == audited([tuple(r) for r in docs.collect()])
    assert found_by(divergence.audit(edge_frame(spark))) == audited(ROWS)
    assert found_by(divergence.audit(no_rows(spark))) == []
    # sizes of subtrees, blocks and walks change nothing
    monkeypatch.setattr(divergence, "LEAVES", 5)
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "WALKED", 64)
    assert found_by(divergence.audit(frame(spark, rows))) == expected


def test_equal_subtrees_share_nodes_and_prices():
    counts = np.zeros((3, 1024), dtype=np.int64)
    counts[0, :2] = counts[1, 512:514] = 7
    trees = divergence.Trees(counts)
    # on each level the empty subtree, and one that holds the two sevens
    assert all(len(left) <= 3 for left, _ in trees.below)
    _, m, n, times = trees.met(np.array([0]), np.array([1]))
    assert sorted(zip(m.tolist(), n.tolist(), times.tolist(), strict=True)) == [
        (0, 0, 1020), (0, 7, 2), (7, 0, 2)]
    _, m, n, times = trees.met(np.array([2]), np.array([2]))
    assert times.tolist() == [1024]


def test_probabilities_are_exact():
    rng = random.Random(3)
    whole = [rng.randrange(1, 9 * 10**17) for _ in range(500)] + [2, 3, 10**9]
    count = [rng.randrange(max(w - 1, 1)) for w in whole]
    found = divergence.probability(np.array(count), np.array(whole))
    assert found.tolist() == [1 + 10**9 * (c + 2) // w for c, w in zip(count, whole, strict=True)]


# ---- whitening ----------------------------------------------------------------------------

def usable(rows):
    return [(i, v) for i, v in rows if v is not None
            and all(c is not None and np.isfinite(c) for c in v)]


def check_whitened(rows, found, components=32):
    """Against numpy's eigenvectors, and exact deviations."""
    rows = usable(rows)
    x = np.array([[int(np.floor(64 * float(c))) + 10**6 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    z = (x - s / n).astype(float)
    cov = z.T @ z / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    exact = sorted((i, int(((n * r - s) ** 2).sum())) for (i, _), r in zip(rows, x, strict=True))
    real = int((e > 1e-13 * np.trace(cov)).sum())
    assert len(found) == n * real
    assert sorted((r.vec_id, r.deviation) for r in found if r.component == 1) == exact
    assert {(r.n, r.component) for r in found} == {(n, k + 1) for k in range(real)}
    by = collections.defaultdict(dict)
    for r in found:
        assert abs(r.explained - e[r.component - 1] / np.trace(cov)) <= 1e-9
        assert r.identity_error <= 1e-7
        by[r.component][r.vec_id] = r.whitened
    ids = [i for i, _ in rows]
    w = np.array([[by[k + 1][i] for i in ids] for k in range(real)]).T
    assert np.abs(w.T @ w / n - np.eye(real)).max() < 1e-7
    expected = z @ v[:, :real] / np.sqrt(e[:real])
    gaps = np.minimum(np.diff(-e, prepend=-np.inf), np.diff(-e, append=np.inf))
    for k in range(real):
        if gaps[k] > 1e-6 * e[0]:
            sign = np.sign(w[:, k] @ expected[:, k])
            assert np.abs(w[:, k] * sign - expected[:, k]).max() < 1e-6


def test_whitening_matches_numpy(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check_whitened(rows, whitening.op12_whitening(spark, small).collect())


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.selectExpr("*", *[f"'c' AS `{c.replace('`', '``')}`" for c in [*CLASHES, "values"]])


def test_whitening_drops_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) * 3]) for i in range(40)]
    bad = [(50, None), (51, [1.0, None, 2.0, 3.0, 4.0]), (52, [float("nan")] * 5),
           (53, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (54, [None] * 5)]
    check_whitened(rows, whitening.whiten(vectors(spark, rows + bad)).collect())
    few = whitening.whiten(vectors(spark, rows + bad), components=2).collect()
    check_whitened(rows, few, components=2)
    # repeated rows, ids and lengths
    odd = rows + [(0, rows[0][1]), (None, rows[1][1])]
    extra = [(60, [1.0, 2.0]), (61, [])]
    found = whitening.whiten(vectors(spark, odd + extra)).collect()
    assert len(found) == 42 * 5 and {r.n for r in found} == {42}
    assert sum(r.vec_id == 0 for r in found) == 10 and sum(r.vec_id is None for r in found) == 5


def test_whitening_of_flat_vectors(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)], [(1, [])]):
        assert whitening.whiten(vectors(spark, rows)).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]  # one direction has all variance
    found = whitening.whiten(vectors(spark, line)).collect()
    assert len(found) == 20 and all(abs(r.explained - 1) < 1e-12 for r in found)
    large = [(i, [3.0e38 if i % 2 else -3.0e38, 1.0]) for i in range(6)]
    found = whitening.whiten(vectors(spark, large)).collect()
    assert len(found) == 6 and {r.deviation for r in found} == {None}


@pytest.mark.parametrize("n", [1, 2, 5, 40])
@pytest.mark.parametrize("kind", ["random", "equal", "pairs", "close", "steep"])
def test_spectrum(n, kind):
    rng = np.random.default_rng(n)
    m = rng.standard_normal((n, n))
    q = np.linalg.qr(m)[0]
    values = {"random": None, "equal": np.full(n, 3.0), "pairs": np.arange(n) // 2 + 1.0,
              "close": 1 + 1e-9 * np.arange(n), "steep": 10.0 ** -np.arange(n).clip(0, 12)}[kind]
    a = m @ m.T if values is None else q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found, vecs = whitening.leading(a, 32)
    expected = np.linalg.eigvalsh(a)[::-1][:32]
    assert np.abs(found - expected).max() <= 1e-13 * expected[0]
    assert np.abs(vecs.T @ vecs - np.eye(len(found))).max() < 1e-12
    assert np.abs(a @ vecs - vecs * found).max() <= 1e-13 * expected[0]


def test_inertia_counts_eigenvalues_below():
    rng = np.random.default_rng(4)
    m = rng.standard_normal((30, 30))
    a = m + m.T
    d, b = whitening.tridiagonal(a)
    e = np.linalg.eigvalsh(a)
    shifts = np.concatenate([e[:-1] / 2 + e[1:] / 2, [e[0] - 1, e[-1] + 1]])
    assert whitening.inertia(d, b, shifts).tolist() == [int((e < s).sum()) for s in shifts]


def test_query_hashes_the_kept_text(spark, small):
    found = {r.doc_id: r.kept_sha256 for r in line_runs.op13_line_dedup(spark, small).collect()}
    rows = [tuple(r) for r in documents(spark, small).collect()]
    for i, text, _, _ in without_repeats(rows):
        assert found[i] == hashlib.sha256(text.encode()).hexdigest()
