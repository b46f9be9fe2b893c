"""Quality classifier: Bradley-Terry ranking of document features, cut at a score quantile."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import Words, append, bucket, cut_lineage, mix, put_back, raw_text, set_aside, text_key

#: At most about so many labelled documents are learnt from, chosen by a hash of the id.
LABELLED = 12_000
PAIRS = 40_000

_PUNCTUATION = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_CLASSES = 38  # 32 kinds of ASCII punctuation, lower, upper, digit, blank, line end, beyond ASCII


def _class_table() -> np.ndarray:
    kinds = np.full(256, 37, np.uint8)
    kinds[:0x80] = 35
    for i, b in enumerate(_PUNCTUATION):
        kinds[b] = i
    kinds[0x61:0x7B], kinds[0x41:0x5B], kinds[0x30:0x3A], kinds[0x0A] = 32, 33, 34, 36
    return kinds


_KIND = _class_table()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers for each text: character shares, length, and how much it repeats itself."""
    n = len(offsets) - 1
    sizes = np.maximum(np.diff(offsets), 1)
    doc_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(doc_of_byte * _CLASSES + _KIND[data], minlength=n * _CLASSES)
    shares = counts[: n * _CLASSES].reshape(n, _CLASSES) / sizes[:, None]
    words = Words(data, offsets)
    n_words = np.diff(words.first)
    most = np.maximum(n_words, 1)
    doc = np.repeat(np.arange(n), n_words)
    distinct, top = _distinct(words.hashes, doc, n)
    same = np.zeros(len(doc), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (doc[1:] == doc[:-1])
    at, triple = words.windows(3)
    distinct3, _ = _distinct(triple, doc[at], n)
    triples = np.maximum(np.bincount(doc[at], minlength=n), 1)
    odd = np.isin(_KIND[data], _ODD)
    symbols = np.bincount(doc_of_byte, weights=odd, minlength=n) / sizes
    rest = np.column_stack([
        np.log1p(n_words),
        np.log1p(np.diff(offsets) / most),
        distinct / most**0.75,
        top / most,
        np.bincount(doc, weights=same, minlength=n) / most,
        1 - distinct3 / triples * (distinct3 > 0),
        np.log1p(200 * symbols),
        counts[: n * _CLASSES].reshape(n, _CLASSES)[:, 36] / most,
    ])
    return np.hstack([np.log1p(50 * shares), rest])


_ODD = [i for i, b in enumerate(_PUNCTUATION) if chr(b) in "#*$%&|<>@^~{}[]=+_\\/!"]


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: distinct hashes, and how often the commonest stands."""
    keys = mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    edge = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])) if len(order) else [])
    owner = doc[order[edge]] if len(order) else doc
    lengths = np.diff(np.append(edge, len(order)))
    top = np.zeros(n)
    np.maximum.at(top, owner, lengths)
    return np.bincount(owner, minlength=n), top


@dataclass
class Ranking:
    """Score of a text: logistic of (weights . standardised features - threshold) / spread."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.raw(x) - self.threshold) / self.spread, -30, 30)))


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Ranking:
    """Bradley-Terry: P(a better than b) is the logistic of w . (a - b), by Newton's method.

    Preference pairs are drawn of a good and a bad document each. The
    threshold is the quantile of the learning scores at the share of bad
    documents. Without both kinds every score is one half.
    """
    width = x.shape[1] if x.ndim == 2 and len(x) else _CLASSES + 8
    if not good.any() or good.all():
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.clip((x - mean) / scale, -8, 8)
    draw = np.random.default_rng(seed)
    d = z[draw.choice(np.flatnonzero(good), pairs)] - z[draw.choice(np.flatnonzero(~good), pairs)]
    w = np.zeros(width)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (1 - p) / pairs - 1e-3 * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / pairs + 1e-3 * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    threshold = float(np.quantile(s, 1 - good.mean(), method="higher"))
    # Between the score at the quantile and the next one below it.
    below = s[s < threshold]
    threshold = (threshold + float(below.max())) / 2 if len(below) else threshold
    return Ranking(mean, scale, w, threshold, max(float(s.std()) / 4, 1e-6))


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Ranking:
    """Fit on labelled rows whose crc32(doc_id) mod 3 is not 1: weights from a sample, threshold from all of them.

    The sample takes about ``labelled`` doc_ids by hash, never more than twice
    that, and one text of each (the least hash), so repeated doc_ids do not add
    to it. The threshold lies at the quantile of the scores of all such
    documents, one row for each doc_id, at the share of bad labels among all of them.
    A doc_id with both labels counts as bad.
    """
    known = labels.filter((bucket("doc_id", 3) != 1) & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    total = known.count()
    space = 1 << 30
    place = F.pmod(F.xxhash64("doc_id"), F.lit(space))
    # At most twice ``labelled`` rows: small enough to broadcast at any size of the tables.
    chosen = known.filter(place < int(min(1.0, labelled / max(total, 1)) * space)).orderBy(place, "doc_id").limit(2 * labelled)
    keyed = docs.select("doc_id", "text", text_key().alias("__key"))
    rows = keyed.join(F.broadcast(chosen), "doc_id")
    made = append(rows, "x array<double>", lambda b: {
        "x": list(features(*raw_text(b.column(b.schema.get_field_index("text")))))
    })
    one = made.groupBy("doc_id", "quality").agg(F.min_by("x", "__key").alias("x")).collect()
    one.sort(key=lambda r: (str(r.doc_id), r.quality, r.x))
    ranking = fit(np.array([r.x for r in one]), np.array([r.quality == 1 for r in one], bool))
    if not ranking.weights.any():
        return ranking

    def raw(batch: pa.RecordBatch) -> dict[str, object]:
        return {"raw": ranking.raw(features(*raw_text(batch.column(batch.schema.get_field_index("text")))))}

    scored = append(keyed, "raw double", raw).drop("text").join(known, "doc_id")
    scored = cut_lineage(scored.groupBy("doc_id", "quality").agg(F.min_by("raw", "__key").alias("raw")))
    bad = scored.agg(F.avg(F.when(F.col("quality") == 1, 0.0).otherwise(1.0))).first()[0]
    cut = scored.agg(F.percentile_approx("raw", F.lit(float(bad)), F.lit(100_000))).first()[0]
    above = scored.filter(F.col("raw") > cut).agg(F.min("raw")).first()[0]
    return replace(ranking, threshold=(cut + above) / 2 if above is not None else cut)


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``docs`` with ``score double`` (0 to 1) and ``predicted int`` (1 from one half on).

    Every whole text is scored, null and empty ones as texts without
    characters. Columns of these names are replaced; repeated rows get equal
    scores; no other column is looked at.
    """
    def work(batch: pa.RecordBatch) -> dict[str, object]:
        s = ranking.score(features(*raw_text(batch.column(batch.schema.get_field_index("text")))))
        return {"score": s, "predicted": (s >= 0.5).astype(np.int32)}

    return append(docs, "score double, predicted int", work)


def keep_good(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    scored = score(set_aside(docs, ["score", "predicted"]), learn(docs, labels, labelled))
    return put_back(scored.filter("predicted = 1"), docs.columns)


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (bucket("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
