"""Language identification by hierarchical discrimination.

A text is a vector of hashed byte trigrams. A first set of linear classifiers decides the
language family; within the family one-versus-one linear support vector machines compare each
pair of its languages, and the language with most votes wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.llm.batches import BATCH_BYTES, map_texts, slices, small_batches
from shelfledger.llm.common import documents, restored, whole_rows

#: Number of hashed features.
FEATURES = 1 << 12
#: Training rows per language; rows are chosen by a hash of their text, over the whole table.
TRAINING_ROWS = 500
#: Passes over the training rows and strength of the regularisation.
EPOCHS, PENALTY = 6, 1e-5
#: A prediction replaces a stated language if its score is at least the median of those that agree
#: with their labels, and of the labels held out at or above it at least this share agrees.
AGREED = 0.9
#: The value for texts that have no language.
UNDETERMINED = "und"
#: The families of common languages. Another language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sk", "sr", "hr", "sl"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}

def has_letter(text: str | None) -> bool:
    """Numbers in the form of letters, as of Roman numerals, are none."""
    return any(map(str.isalpha, text or ""))


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, lang)


def features(array: pa.Array) -> np.ndarray:
    """One row per text: square roots of trigram shares, of length 1. Whole texts are read."""
    out = np.zeros((len(array), FEATURES), dtype=np.float32)
    low = [(x or "").lower() for x in array.to_pylist()]
    for i, text in enumerate(low):
        raw = f" {text} ".encode("utf-8", "surrogatepass")
        for at in range(0, len(raw), BATCH_BYTES):  # a very long text is counted in pieces
            b = np.frombuffer(raw[at:at + BATCH_BYTES + 2], dtype=np.uint8).astype(np.uint32)
            b = np.where((b < 65) | ((b > 90) & (b < 97)) | ((b > 122) & (b < 128)), 32, b)
            b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
            if len(b) < 3:
                continue
            code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
            bins = ((code * np.uint32(2654435761)) >> np.uint32(32 - 12)) & (FEATURES - 1)
            out[i] += np.bincount(bins, minlength=FEATURES)
    out = np.sqrt(out)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


@dataclass
class Model:
    """Linear machines: ``family`` has one column per family, ``pairs`` one per language pair."""

    families: list[str]
    family: np.ndarray
    languages: dict[str, list[str]]
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language and a score from 0 to 1 for each row of features."""
        margin = x @ self.family
        chance = 1 / (1 + np.exp(-np.clip(4 * margin, -50, 50)))
        best = chance.argmax(axis=1) if len(self.families) else np.zeros(len(x), dtype=int)
        lang = [""] * len(x)
        score = np.zeros(len(x))
        for f, family in enumerate(self.families):
            rows = np.flatnonzero(best == f)
            if not len(rows):
                continue
            langs = self.languages[family]
            votes = np.zeros((len(rows), len(langs)))
            sure = np.zeros((len(rows), len(langs)))
            for (a, b), w in self.pairs.items():
                if a not in langs or b not in langs:
                    continue
                m = 1 / (1 + np.exp(-np.clip(4 * (x[rows] @ w), -50, 50)))
                i, j = langs.index(a), langs.index(b)
                votes[:, i] += m > 0.5
                votes[:, j] += m <= 0.5
                sure[:, i] += m
                sure[:, j] += 1 - m
            # the chances decide between languages of equal votes, then the order of names
            win = (votes + sure / (len(langs) + 1)).argmax(axis=1)
            among = sure[np.arange(len(rows)), win] / max(len(langs) - 1, 1)
            for r, k in zip(rows, win, strict=True):
                lang[r] = langs[k]
            score[rows] = chance[rows, f] * (among if len(langs) > 1 else 1.0)
        return lang, score


def train_machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, by gradient steps over blocks
    of rows in a fixed order; the average of the weights is returned. y is 1 or -1."""
    order = np.random.default_rng(7).permutation(len(x))
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y)
    w, total, step = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    for _ in range(EPOCHS):
        for at in range(0, len(order), 64):
            rows = order[at:at + 64]
            lack = np.maximum(0, 1 - y[rows] * (x[rows] @ w))
            w += 2.0 / (1 + step * 0.01) * (
                (weight[rows] * lack * y[rows]) @ x[rows] / len(rows) - PENALTY * w
            )
            total += w
            step += 1
    return (total / max(step, 1)).astype(np.float32)


def fit(x: np.ndarray, lang: list[str]) -> Model:
    """Families against the rest first, then each pair of languages within a family."""
    langs = sorted(set(lang))
    families = sorted({family_of(v) for v in langs})
    named = np.array(lang, dtype=object)
    family = np.array([family_of(v) for v in lang], dtype=object)
    columns = [
        train_machine(x, np.where(family == f, 1.0, -1.0)) if len(families) > 1
        else np.zeros(x.shape[1], dtype=np.float32) for f in families
    ]
    model = Model(
        families, np.array(columns, dtype=np.float32).T if columns else np.zeros((FEATURES, 0)),
        {f: [v for v in langs if family_of(v) == f] for f in families},
    )
    for group in model.languages.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                rows = (named == a) | (named == b)
                model.pairs[a, b] = train_machine(
                    x[rows], np.where(named[rows] == a, 1.0, -1.0)
                )
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document takes no part in training; a null id takes none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def learn(docs: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Fits on at most ``rows`` labelled texts per language that are not held out.

    The sample is those with the least hash of their text: it depends on the rows alone, not on
    their order or number of files. The vectors are made on the executors.
    """
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).where(
        ~held_out(F.col("doc_id"))
    ).select("lang", "text", F.xxhash64("text", "doc_id").alias("key"))
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    # a bound on the hash keeps about twice the rows; the least of those are then cut exactly
    bounds = F.lit(None).cast("double")
    for name, n in counts.items():
        bounds = F.when(F.col("lang") == name, min(1.0, 2 * rows / n)).otherwise(bounds)
    near = labelled.where(F.pmod("key", F.lit(1 << 40)) / float(1 << 40) <= bounds)

    def vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(batch.column("text")).astype(np.float16)
        return pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("key"),
             pa.array([r.tobytes() for r in x], type=pa.binary())],
            names=["lang", "key", "x"],
        )

    found = sorted(
        map_texts(near, "text", vectors, "lang string, key long, x binary").collect(),
        key=lambda r: (r["lang"], r["key"] % (1 << 40)),
    ) if counts else []
    kept, seen = [], {}
    for r in found:
        seen[r["lang"]] = seen.get(r["lang"], 0) + 1
        if seen[r["lang"]] <= rows:
            kept.append(r)
    x = np.array([np.frombuffer(r["x"], dtype=np.float16) for r in kept], dtype=np.float32)
    return fit(x.reshape(len(kept), FEATURES), [r["lang"] for r in kept])


def predict_column(model: Model):
    """A pandas UDF from text to struct(lang, score, lettered)."""
    @F.pandas_udf("lang string, score double, lettered boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(texts, type=pa.string(), from_pandas=True)], names=["text"]
        )
        langs, scores = [], []
        for part in slices(iter([batch]), "text"):
            a, b = predict_texts(model, part.column("text"))
            langs += a
            scores += b
        lettered = [has_letter(t) for t in texts]
        return pd.DataFrame({"lang": langs, "score": scores, "lettered": lettered})

    return predicted


def predict_texts(model: Model, texts: pa.Array) -> tuple[list[str], list[float]]:
    """Languages and scores of texts; ``und`` and 0 for a null text, one without a letter, or
    a model that has learnt no language."""
    has = [has_letter(t) for t in texts.to_pylist()]
    if not model.families:
        return [UNDETERMINED] * len(has), [0.0] * len(has)
    lang, score = [], []
    for at in range(0, len(has), 512):  # 512 vectors are 8 MB
        a, b = model.predict(features(texts.slice(at, 512)))
        lang += a
        score += b.tolist()
    return (
        [v if h else UNDETERMINED for v, h in zip(lang, has, strict=True)],
        [float(s) if h else 0.0 for s, h in zip(score, has, strict=True)],
    )


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per input row.

    Takes doc_id, text and, for training, lang; other columns are left out. The prediction
    depends on the text alone. Null texts and texts without a letter are ``und`` with score 0,
    as is everything if no row can be learnt from. An empty table gives no rows.
    """
    model = learn(docs) if model is None else model

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = predict_texts(model, batch.column("text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"),
             pa.array(lang, type=pa.string()), pa.array(score, type=pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return map_texts(
        rows, "text", work, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def sure_scores(docs: DataFrame, model: Model) -> dict[str, float]:
    """Language -> the score from which its prediction replaces another stated language.

    Calibrated on the labelled rows that are held out; a language without such rows, or whose
    predictions agree too seldom with the labels, has none.
    """
    predicted = predict_column(model)(F.col("text"))
    fold = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).where(
        held_out(F.col("doc_id"))
    ).select("lang", predicted.alias("p")).where(F.col("p.lettered"))
    counts = fold.groupBy(
        F.col("p.lang").alias("name"), F.floor(F.col("p.score") * 100).alias("part")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("lang") == F.col("p.lang")).cast("long"))
        .alias("agree"),
    ).collect()  # at most 101 rows per language
    sure = {}
    for name in {r["name"] for r in counts}:
        parts = sorted((r for r in counts if r["name"] == name), key=lambda r: -r["part"])
        half = sum(r["agree"] for r in parts) / 2
        n = agree = 0
        for r in parts:
            n, agree = n + r["n"], agree + r["agree"]
            if agree > 0 and agree >= half:
                if agree >= AGREED * n:
                    sure[name] = r["part"] / 100
                break
    return sure


def known_language(docs: DataFrame) -> DataFrame:
    """The documents with a language, all columns as they are but for ``lang``.

    Rejected are null texts and texts without a letter, and no others. A document whose language
    is not stated gets the predicted one, ``und`` if no language could be learnt; a stated one
    is replaced by a prediction that is sure (see ``sure_scores``).
    """
    small_batches(docs.sparkSession)
    model = learn(docs)
    sure = sure_scores(docs, model) if model.families else {}
    found, score = F.col("language.lang"), F.col("language.score")
    corrected = F.lit(False)
    for name, least in sorted(sure.items()):
        corrected = corrected | ((found == name) & (score >= least))
    # as if not deterministic, so that Spark does not predict once for the filter and once more
    predicted = predict_column(model).asNondeterministic()
    marked = whole_rows(docs, "lang", predicted(F.col("text")).alias("language"))
    return restored(
        marked.where(F.col("language.lettered")), docs,
        lang=F.when(corrected, found).otherwise(F.coalesce("lang", found)),
    )


def op7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
