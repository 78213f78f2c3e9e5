"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tripwire.llm.shared import read

UNDETERMINED = "und"
SHORTEST, LONGEST = 2, 5
CHUNK = 1 << 20
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _buckets(text: str, n_buckets: int):
    """Bucket numbers of the subwords (2 to 5 bytes of a word with its edges) of a whole text, in chunks."""
    raw = np.frombuffer(b" " + _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "ignore") + b" ", np.uint8)
    for start in range(0, max(1, len(raw) - 1), CHUNK):
        b = raw[start:start + CHUNK + LONGEST - 1]
        owned = min(CHUNK, len(raw) - start)
        h, inside = b.astype(np.uint32), np.ones(len(b), bool)
        for n in range(2, LONGEST + 1):
            if len(b) < n:
                break
            if n > 2:
                inside = inside[:-1] & (b[n - 2:-1] != 32)
            else:
                inside = inside[:-1]
            h = h[:-1] * np.uint32(16777619) ^ b[n - 1:]
            at = h[:owned][inside[:owned]]
            yield (at * np.uint32(2654435761) >> np.uint32(7)) % np.uint32(n_buckets)


def subword_counts(text: str, n_buckets: int) -> np.ndarray:
    counts = np.zeros(n_buckets)
    for ids in _buckets(text, n_buckets):
        counts += np.bincount(ids, minlength=n_buckets)
    return counts


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    """Trained model; ``weights`` are the subword embeddings times the output layer (buckets x languages)."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.5

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.weights / max(1.0, counts.sum()) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 for null, a text without letters, or no language learned."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        p = _softmax(self.logits(subword_counts(text, len(self.weights))) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, p[best]))


def train(rows: list[tuple[str, str]], n_buckets: int = 1 << 15, dim: int = 16, epochs: int = 6, rate: float = 2.0,
          seed: int = 7) -> LanguageModel:
    """Fit by stochastic gradient descent on (text, language) rows.

    Every fifth row is kept out of the descent and calibrates: it sets the softmax temperature, so
    that the scores are probabilities, and the score under which a text is rejected, half of
    the least score that any of these rows is rightly identified with, 0.5 at most.
    """
    rows = [(t, g) for t, g in rows if t and any(map(str.isalpha, t))]
    languages = sorted({g for _, g in rows})
    if not languages:
        return LanguageModel([], np.zeros((n_buckets, 0)), np.zeros(0))
    of, feats = {g: i for i, g in enumerate(languages)}, []
    for text, g in rows:
        c = subword_counts(text, n_buckets)
        at = np.flatnonzero(c)
        feats.append((at.astype(np.int32), (c[at] / max(1.0, c.sum())).astype(np.float32), of[g]))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(feats))
    held = [feats[i] for i in order[::5]] if len(feats) >= 20 else feats
    fit = [f for k, f in enumerate(feats[i] for i in order) if k % 5] if len(feats) >= 20 else feats
    emb = rng.uniform(-1 / dim, 1 / dim, (n_buckets, dim))
    out, bias = np.zeros((dim, len(languages))), np.zeros(len(languages))
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for k in rng.permutation(len(fit)):
            at, c, y = fit[k]
            lr = rate * (1 - done / steps)
            x = c @ emb[at]
            g = _softmax(x @ out + bias)
            g[y] -= 1
            back = out @ g
            out -= lr * np.outer(x, g)
            bias -= lr * 0.01 * g
            emb[at] -= lr * 20 * np.outer(c, back)
            done += 1
    model = LanguageModel(languages, (emb @ out).astype(np.float64), bias)
    z = np.array([c @ model.weights[at] + bias for at, c, _ in held])
    y = np.array([f[2] for f in held])

    def loss(t):
        return -np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean()
    model.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
    p = _softmax(z / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    model.reject_below = float(min(0.5, right.min() / 2)) if len(right) else 0.5
    return model


def training_rows(docs: DataFrame, per_language: int = 300, max_languages: int = 64,
                  max_chars: int = 20_000) -> list[tuple[str, str]]:
    """A bounded sample of labelled rows: per language, the ``per_language`` first by a hash of doc_id.

    The most frequent ``max_languages`` languages; rows with a null doc_id, text or lang
    and texts over ``max_chars`` are no examples. Whole texts are taken. Each (language,
    doc_id) counts once.
    """
    span = 1 << 31
    named = (docs.where("lang is not null and doc_id is not null and text is not null")
             .withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(span))))
    common = named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    # Of a large language only the low hashes, some four times the rows wanted, are ranked.
    low = F.lit(None).cast("long")
    for r in common:
        low = F.when(F.col("lang") == r.lang, F.lit(min(span, 4 * per_language * span // r["count"]))).otherwise(low)
    w = Window.partitionBy("lang").orderBy("_h", "doc_id")
    picked = (named.select("lang", "_h", "doc_id").where(F.col("_h") < low).distinct()
              .withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_language))
    ids = sorted({r.doc_id for r in picked.select("doc_id").collect()})
    got = (named.where(F.col("doc_id").isin(ids) & F.col("lang").isin([r.lang for r in common]) & (F.length("text") <= max_chars))
           .select("doc_id", "text", "lang").collect())
    once = {(r.doc_id, r.lang): r.text for r in sorted(got, key=lambda r: (r.doc_id, r.lang, r.text))}
    return [(t, g) for (_, g), t in sorted(once.items())]


def language(text: Column, model: LanguageModel) -> Column:
    """struct(lang, score) of a whole text; the model (buckets x languages numbers) travels with the function."""
    @F.arrow_udf("struct<lang: string, score: double>")
    def of(texts: pa.Array) -> pa.Array:
        found = [model.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()),
                                           pa.array([s for _, s in found], pa.float64())], ["lang", "score"])

    return of(text)


def held_out() -> Column:
    """Rows that are never learned from: crc32 of doc_id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_language_model(docs: DataFrame, **bounds) -> LanguageModel:
    """Model learned from the rows of ``docs`` (doc_id, text, lang) that are not held out."""
    return train(training_rows(docs.where(~held_out()).select("doc_id", "text", "lang"), **bounds))


def identify(docs: DataFrame, model: LanguageModel, reject_below: float | None = None) -> DataFrame:
    """``docs`` with lang_pred, score and rejected.

    rejected: the text is null or has no letter (lang_pred ``und``, score 0), or the
    calibrated probability of its best language is under ``reject_below`` (the model's own,
    see ``train``): far less sure than any text of the learned languages. Columns of ``docs`` with these names are replaced. Repeated
    rows stay; an empty table gives an empty result; with nothing learned all is ``und``.
    """
    limit = model.reject_below if reject_below is None else reject_below
    found = docs.drop("lang_pred", "score", "rejected").withColumn("_found", language(F.col("text"), model))
    return (found.withColumn("lang_pred", F.col("_found.lang")).withColumn("score", F.col("_found.score"))
            .withColumn("rejected", (F.col("lang_pred") == UNDETERMINED) | (F.col("score") < limit)).drop("_found"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: predicted language of every document."""
    docs = read(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit_language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
