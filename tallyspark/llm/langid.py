"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of lower-cased text, hashed into ``FEATURES``
columns; a column's value is (1 + log count) times its inverse document
frequency, and vectors have length 1.  Weights are learnt by
follow-the-regularised-leader (proximal form, per-coordinate rates, L1 and L2
penalties) and the softmax is calibrated by one temperature, fitted on a fifth
of the sample that the weights never saw.

Scale: document frequencies count every learnable document (each task sends
one row for each column at most).  The weights are fitted in one task on a
sample of at most about ``SAMPLE_PER_LANG`` documents of each language, chosen
by a hash of the doc_id; this bound is a parameter.  Prediction is one pass
over whole texts, in pieces of ``PIECE`` characters, without a shuffle.  What
goes through the driver is the model: ``FEATURES`` numbers and as many for
each language.

Defined cases: a null text or one without a letter is ``und`` with score 0; so
is every text if nothing can be learnt; rows without doc_id or language are
not learnt from; equal texts get equal answers; ties go to the language that
sorts first; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURES = 1 << 15
SIZES = (1, 2, 3)
SAMPLE_PER_LANG = 2_000
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
PIECE = 1 << 20


def counts(text: str) -> np.ndarray:
    """Number of n-grams in each column."""
    out = np.zeros(FEATURES, np.int64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    over = max(SIZES) - 1
    with np.errstate(over="ignore"):
        for at in range(0, len(code), PIECE):
            part = code[at:at + PIECE + over]
            for n in SIZES:
                starts = min(PIECE, len(part) - n + 1)
                if starts > 0:
                    h = np.full(starts, n, np.uint64)
                    for j in range(n):
                        h = (h + part[j:starts + j]) * np.uint64(0x9E3779B97F4A7C15)
                        h ^= h >> np.uint64(31)
                    out += np.bincount((h & np.uint64(FEATURES - 1)).astype(np.int64), minlength=FEATURES)
    return out


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of a text."""
    c = counts(text)
    at = np.flatnonzero(c)
    v = (1 + np.log(c[at])) * idf[at]
    return at, v / max(np.sqrt((v * v).sum()), 1e-12)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Ftrl:
    """Follow-the-regularised-leader weights of a softmax over ``k`` classes; the last column is the bias."""

    def __init__(self, k: int):
        self.z = np.zeros((k, FEATURES + 1))
        self.n = np.zeros((k, FEATURES + 1))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, v: np.ndarray, y: int) -> None:
        at, v = np.append(at, FEATURES), np.append(v, 1.0)
        w = self.weights(at)
        s = w @ v
        p = np.exp(s - s.max())
        p /= p.sum()
        p[y] -= 1
        g = p[:, None] * v
        old = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / ALPHA * w
        self.n[:, at] = old + g * g


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of the smallest log loss, by golden section on its logarithm."""
    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s -= s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    low, high, g = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class Model:
    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, temp: float):
        self.langs, self.idf, self.w, self.temp = langs, idf, weights, temp

    def logits(self, text: str) -> np.ndarray:
        at, v = vector(text, self.idf)
        return self.w[:, at] @ v + self.w[:, -1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        s = self.logits(text) / self.temp
        p = np.exp(s - s.max())
        return self.langs[int(p.argmax())], float(p.max() / p.sum())


def train(docs: DataFrame, learnable: Column, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Model from the rows of ``docs`` (doc_id, text, lang) that are ``learnable`` and have a language and a letter."""
    rows = docs.select("doc_id", "text", "lang").filter(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += counts(text) > 0
                n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"feature": np.append(at, FEATURES), "n": np.append(seen[at], n)})

    found = rows.select("text").mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(FEATURES + 1, np.int64)
    for r in found:
        df[r[0]] = r[1]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    # One share of each language, so that about sample_per_lang of its documents are taken.
    shares = {r[0]: min(1.0, sample_per_lang / r[1]) for r in rows.groupBy("lang").count().collect()}
    langs = sorted(shares)
    if not langs:
        return Model([], idf, np.zeros((0, FEATURES + 1)), 1.0)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for p in shares.items() for x in (p[0], float(p[1]))])[F.col("lang")]
    sample = rows.filter(place < share * 1_000_000)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [vector(t, idf) if has_letter(t) else None for t in batch.column(1).to_pylist()]
            keep = pa.array([g is not None for g in got])
            got = [g for g in got if g is not None]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).filter(keep), batch.column(2).filter(keep), pa.array([g[0].astype(np.int32).tobytes() for g in got], pa.binary()),
                pa.array([g[1].astype(np.float32).tobytes() for g in got], pa.binary())], names=["doc_id", "lang", "at", "v"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*[c.to_pylist() for c in b.columns])]
        rng = np.random.default_rng(1)
        # The same order whatever order the rows come in.
        rows = [(np.frombuffer(a, np.int32), np.frombuffer(v, np.float32).astype(float), langs.index(lang)) for _, lang, a, v in sorted(rows)]
        rows = [rows[i] for i in rng.permutation(len(rows))]
        held = len(rows) // 5
        model = Ftrl(len(langs))
        for _ in range(PASSES):
            for i in rng.permutation(np.arange(held, len(rows))):
                model.learn(*rows[i])
        w = model.weights()
        temp = 1.0
        if held >= 20:
            temp = temperature(np.array([w[:, a] @ v + w[:, -1] for a, v, _ in rows[:held]]), np.array([y for _, _, y in rows[:held]]))
        yield pa.RecordBatch.from_pydict({"weights": [w.astype(np.float32).tobytes()], "temp": [temp]})

    fitted = (sample.mapInArrow(features, "doc_id long, lang string, at binary, v binary").repartition(1)
              .mapInArrow(fit, "weights binary, temp double").first())
    return Model(langs, idf, np.frombuffer(fitted[0], np.float32).reshape(len(langs), FEATURES + 1).astype(float), fitted[1])


def detect(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language of each whole text and its calibrated probability."""
    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.idf, model.w, model.temp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        model = Model(*shared.value)
        for batch in batches:
            got = [model.predict(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns, arrow)],
                                              pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], schema=arrow)

    return docs.mapInArrow(run, schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 3."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))
