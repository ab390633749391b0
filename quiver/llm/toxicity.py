"""Toxicity by a classifier chain.

Categories are predicted one after another by logistic regressions over words and word starts; each later
model also sees the probabilities of the categories before it. For training these come from out-of-fold
predictions, so a later model learns from probabilities as good as those it will meet on new texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import prepare

SAMPLE = 12_000  # labelled rows that the chain is fitted on, at most: those with the smallest hash of their id
WORDS = 4_000  # distinct words of a labelled text that take part in the fit, at most: those with the smallest hash
FOLDS = 3
FEATURES = 2_048  # features of a model, at most
STARTS = (4, 6)  # lengths of the word starts that count as features
LEAST_DF = 3  # texts that must hold a feature
LEAST_G = 10.83  # likelihood ratio from which a feature is taken (one in a thousand by chance)
PRIOR = 10.0  # texts that pull a feature's log odds to none
RIDGE = 1e-3
STEPS = 150

_WORD = re.compile(r"[^\W\d_]{3,}")


@dataclass
class Model:
    """A logistic regression: weights of features, of the probabilities of earlier categories, and the bias."""

    weights: dict[str, float]
    chain: list[float]
    bias: float


@dataclass
class Chain:
    names: list[str]
    models: list[Model]


def hash_word(w: str) -> int:
    return xxhash.xxh64_intdigest(w.encode())


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features(own: set[str]) -> set[str]:
    return own.union(*({f"{w[:n]}*" for w in own if len(w) >= n} for n in STARTS))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _select(row: np.ndarray, feat: np.ndarray, y: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The features most associated with ``y`` by likelihood ratio, and their smoothed log odds."""
    n, pos = len(y), float(y.sum())
    df = np.bincount(feat, minlength=dim).astype(float)
    hit = np.bincount(feat, weights=y[row], minlength=dim)
    rate = pos / n

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    g = 2 * (part(hit, df * rate) + part(df - hit, df * (1 - rate)) + part(pos - hit, (n - df) * rate) + part(n - pos - df + hit, (n - df) * (1 - rate)))
    keep = np.flatnonzero((g >= LEAST_G) & (df >= LEAST_DF))
    keep = keep[np.argsort(-g[keep], kind="stable")[:FEATURES]]
    odds = np.log((hit[keep] + PRIOR * rate) / (df[keep] - hit[keep] + PRIOR * (1 - rate))) - np.log(rate / (1 - rate))
    return keep, odds


def _fit(row: np.ndarray, feat: np.ndarray, y: np.ndarray, earlier: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Features, their weights, weights of ``earlier`` and the bias of a ridge logistic regression, by Adam.

    One class only: no features, and the bias of that class."""
    none = np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1])
    if len(y) == 0 or y.min() == y.max():
        return *none, 30.0 if len(y) and y[0] else -30.0
    keep, odds = _select(row, feat, y, dim)
    place = np.full(dim, -1, np.int32)
    place[keep] = np.arange(len(keep), dtype=np.int32)
    own = place[feat] >= 0
    r, f = row[own], place[feat[own]]
    v = odds[f]
    k, m, n = len(keep), earlier.shape[1], len(y)
    w = np.concatenate([np.ones(k), np.zeros(m), [np.log(y.mean() / (1 - y.mean()))]])
    first, second = np.zeros_like(w), np.zeros_like(w)
    ridge = np.concatenate([np.full(k + m, RIDGE), [0.0]])
    for t in range(1, STEPS + 1):
        x = np.bincount(r, weights=w[f] * v, minlength=n) + earlier @ w[k:k + m] + w[-1]
        err = (_sigmoid(x) - y) / n
        grad = np.concatenate([np.bincount(f, weights=err[r] * v, minlength=k), earlier.T @ err, [err.sum()]]) + ridge * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w = w - 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return keep, w[:k] * odds, w[k:k + m], float(w[-1])


def _predict(row: np.ndarray, feat: np.ndarray, n: int, earlier: np.ndarray, dim: int, fit: tuple) -> np.ndarray:
    keep, w, u, b = fit
    full = np.zeros(dim)
    full[keep] = w
    return _sigmoid(np.bincount(row, weights=full[feat], minlength=n) + earlier @ u + b)


def fit_local(texts: list[str], labels: np.ndarray, fold: np.ndarray) -> list[Model]:
    """The chain over the columns of ``labels``, from the space-joined words of the bounded sample.

    Features of fewer than ``LEAST_DF`` texts get no place: a first pass counts them in a table of fixed
    size, which never counts too few, so the words of single texts are not held together."""
    seen = np.zeros(1 << 22, np.int32)
    mask = len(seen) - 1
    for t in texts:
        np.add.at(seen, np.fromiter((hash(x) & mask for x in features(set(t.split()))), np.int64), 1)
    ids: dict[str, int] = {}
    row, feat = [], []
    for i, t in enumerate(texts):
        f = [ids.setdefault(x, len(ids)) for x in sorted(features(set(t.split()))) if seen[hash(x) & mask] >= LEAST_DF]
        row.append(np.full(len(f), i, np.int32))
        feat.append(np.array(f, np.int32))
    row = np.concatenate([*row, np.zeros(0, np.int32)])
    feat = np.concatenate([*feat, np.zeros(0, np.int32)])
    dim, n, names = len(ids), len(texts), list(ids)
    earlier, models = np.zeros((n, 0)), []
    for c in range(labels.shape[1]):
        y = labels[:, c]
        keep, w, u, b = _fit(row, feat, y, earlier, dim)
        models.append(Model({names[k]: float(x) for k, x in zip(keep, w)}, u.tolist(), b))
        if c + 1 < labels.shape[1]:
            held = np.zeros(n)
            for k in np.unique(fold):
                out = fold == k
                number = np.cumsum(~out) - 1
                inside = ~out[row]
                part = _fit(number[row[inside]], feat[inside], y[~out], earlier[~out], dim)
                held[out] = _predict(row, feat, n, earlier, dim, part)[out]
            earlier = np.column_stack([earlier, held])
    return models


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str = "doc_id", text_col: str = "text",
              sample: int = SAMPLE, folds: int = FOLDS) -> Chain:
    """Fit the chain over ``categories`` (name to a 0/1 expression over ``labels``, in order).

    At most ``sample`` labelled rows are used, those whose id has the smallest hash, with at most ``WORDS``
    distinct words each: the bound of the broadcast, of the one fitting task and of the model. Rows with a
    null id or a null category, and ids without a text, take no part; of repeated labels the largest value of each
    category counts, of documents with one id or one text one. A category with one class only gets its
    probability; without labelled texts that is 0."""
    prepare(docs.sparkSession)
    ys = [f"y{i}" for i in range(len(categories))]
    own = labels.select(F.col(id_col).cast("long").alias("id"), *[e.cast("double").alias(y) for y, e in zip(ys, categories.values())])
    own = own.dropna().groupBy("id").agg(*[F.max(y).alias(y) for y in ys]).orderBy(F.xxhash64("id"), "id").limit(sample)
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    train = text.join(F.broadcast(own), "id").select("*", F.md5("text").alias("digest"))

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [" ".join(sorted(words(t), key=lambda w: (hash_word(w), w))[:WORDS]) for t in b.column("text").to_pylist()]
            yield b.drop_columns(["text"]).append_column("words", pa.array(kept, pa.string()))

    shape = ", ".join(["id long", *[f"{y} double" for y in ys], "digest string", "words string"])
    train = train.select("id", "text", *ys, "digest").mapInArrow(reduced, shape)
    train = train.groupBy("id").agg(F.min_by(F.struct("digest", "words", *ys), "digest").alias("r")).select("id", "r.*")
    train = train.groupBy("digest").agg(F.min_by(F.struct("id", "words", *ys), "id").alias("r")).select("r.*")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        fold = np.array([hash_word(str(i)) % folds for i in pdf["id"]])
        models = fit_local(pdf["words"].tolist(), pdf[ys].to_numpy(float), fold)
        return pd.DataFrame([(c, kind, name, float(x)) for c, m in enumerate(models) for kind, items in (
            ("w", m.weights.items()), ("u", ((str(i), x) for i, x in enumerate(m.chain))), ("b", [("", m.bias)])) for name, x in items],
            columns=["category", "kind", "name", "weight"])

    rows = train.groupBy(F.lit(0).alias("all")).applyInPandas(fit, "category int, kind string, name string, weight double").collect()
    models = [Model({}, [0.0] * c, -30.0) for c in range(len(ys))]
    for r in rows:
        m = models[r["category"]]
        if r["kind"] == "w":
            m.weights[r["name"]] = r["weight"]
        elif r["kind"] == "u":
            m.chain[int(r["name"])] = r["weight"]
        else:
            m.bias = r["weight"]
    return Chain(list(categories), models)


def score(docs: DataFrame, chain: Chain, thresholds: dict[str, float], text_col: str = "text") -> DataFrame:
    """``docs`` with a probability column ``p_<category>`` for each category and ``rejected`` (any at or over its threshold).

    A null or empty text has the probability of a text without features. Nulls, repeated rows and other
    columns pass through; input columns named like a result column are replaced. No shuffle; the model in the
    closure is bounded by ``FEATURES`` per category."""
    prepare(docs.sparkSession)
    models, names = chain.models, chain.names
    shape = ", ".join(f"p{i} double" for i in range(len(names)))

    @F.pandas_udf(shape)
    def chained(text: pd.Series) -> pd.DataFrame:
        p = np.empty((len(text), len(models)))
        table: dict[str, list[tuple[int, float]]] = {}
        for c, m in enumerate(models):
            for f, w in m.weights.items():
                table.setdefault(f, []).append((c, w))
        known = table.keys()
        for i, t in enumerate(text):
            x = [m.bias for m in models]
            for f in sorted(known & features(words(t))):
                for c, w in table[f]:
                    x[c] += w
            for c, m in enumerate(models):
                p[i, c] = 1 / (1 + np.exp(-min(30.0, max(-30.0, x[c] + sum(u * q for u, q in zip(m.chain, p[i]))))))
        return pd.DataFrame(p, columns=[f"p{i}" for i in range(len(models))])

    out = docs.drop("rejected", *[f"p_{n}" for n in names]).withColumn("__tox_p", chained(F.col(text_col).cast("string")))
    for i, n in enumerate(names):
        out = out.withColumn(f"p_{n}", F.col(f"__tox_p.p{i}"))
    hit = F.lit(False)
    for n, t in thresholds.items():
        hit = hit | (F.col(f"p_{n}") >= t)
    return out.withColumn("rejected", hit).drop("__tox_p")
