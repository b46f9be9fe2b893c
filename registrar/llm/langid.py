"""Language identification: a bidirectional GRU over bytes labels every position."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import append, bucket, raw_text

HIDDEN = 8
#: The network reads texts in stretches of so many bytes, each from a zero state on both ends.
STRETCH = 128
#: Stretches that go through the network together.
BATCH = 4_096
#: About so many documents of each language are learnt from, one stretch of characters of each.
PER_LANGUAGE = 800
#: Steps of training, each on so many stretches.
STEPS = 260
TOGETHER = 96


@dataclass
class Network:
    """Weights, feature first: gates z, r and candidate n are the three parts of 3 * HIDDEN rows.

    ``embed`` (2, 3H, 256) is what a byte adds to the gates of each direction,
    ``recur`` (2, 3H, H) what the state adds, ``bias`` (2, H) the state's part
    of the candidate, ``out`` (C, 2H) and ``base`` (C) give the position's label.
    """

    languages: list[str]
    embed: np.ndarray
    recur: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: np.ndarray

    @staticmethod
    def start(languages: list[str], seed: int) -> Network:
        draw = np.random.default_rng(seed)
        small = lambda *shape: draw.normal(0, 0.3, shape).astype(np.float32)
        h, c = HIDDEN, len(languages)
        return Network(
            languages, small(2, 3 * h, 256), small(2, 3 * h, h), np.zeros((2, h), np.float32),
            small(c, 2 * h), np.zeros(c, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.recur, self.bias, self.out, self.base]

    def states(self, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (2, T, H, B) after every position of ``codes`` (T, B), read from both ends."""
        steps, batch = codes.shape
        h = HIDDEN
        states = np.empty((2, steps, h, batch), np.float32)
        for way in (0, 1):
            embed, recur, bias = self.embed[way], self.recur[way], self.bias[way][:, None]
            state = np.zeros((h, batch), np.float32)
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                drive = np.take(embed, codes[t], axis=1)
                memory = recur @ state
                gates = drive[: 2 * h]
                gates += memory[: 2 * h]
                gates *= np.float32(0.5)
                np.tanh(gates, out=gates)
                gates *= np.float32(0.5)
                gates += np.float32(0.5)
                update, reset = gates[:h], gates[h:]
                held = memory[2 * h :]
                held += bias
                fresh = drive[2 * h :]
                fresh += reset * held
                np.tanh(fresh, out=fresh)
                before = state
                state = states[way, t]
                np.subtract(before, fresh, out=state)
                state *= update
                state += fresh
                if keep is not None:
                    keep.append((way, t, before, update, reset, held, fresh))
        return states

    def labels(self, states: np.ndarray) -> np.ndarray:
        """Probabilities (T, C, B) of every position."""
        steps, batch = states.shape[1], states.shape[3]
        h = HIDDEN
        made = np.empty((steps, len(self.base), batch), np.float32)
        for t in range(steps):
            x = self.out[:, :h] @ states[0, t] + self.out[:, h:] @ states[1, t] + self.base[:, None]
            x -= x.max(0)
            np.exp(x, out=x)
            x /= x.sum(0)
            made[t] = x
        return made

    def step(self, codes: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all positions and its gradients, by backpropagation through time.

        ``wanted`` (B) is the language of each stretch, ``weight`` (T, B) the
        weight of each position.
        """
        h = HIDDEN
        kept: list = []
        states = self.states(codes, kept)
        p = self.labels(states)
        column = np.arange(codes.shape[1])
        loss = -float((np.log(np.maximum(p[:, wanted, column], 1e-9)) * weight).sum())
        p[:, wanted, column] -= 1
        p *= weight[:, None, :]
        embed, recur, bias, out = (np.zeros_like(x) for x in self.parts()[:4])
        for t in range(codes.shape[0]):
            out[:, :h] += p[t] @ states[0, t].T
            out[:, h:] += p[t] @ states[1, t].T
        carried = [np.zeros((h, codes.shape[1]), np.float32) for _ in range(2)]
        one_hot = np.eye(256, dtype=np.float32)
        for way, t, before, update, reset, held, fresh in reversed(kept):
            d = carried[way] + self.out[:, way * h : (way + 1) * h].T @ p[t]
            d_fresh = d * (1 - update) * (1 - fresh * fresh)
            d_held = d_fresh * reset
            d_update = d * (before - fresh) * update * (1 - update)
            d_reset = d_fresh * held * reset * (1 - reset)
            from_memory = np.concatenate((d_update, d_reset, d_held))
            recur[way] += from_memory @ before.T
            bias[way] += d_held.sum(1)
            embed[way] += np.concatenate((d_update, d_reset, d_fresh)) @ one_hot[codes[t]]
            carried[way] = d * update + self.recur[way].T @ from_memory
        return loss, [embed, recur, bias, out, p.sum((0, 2))]


def train(
    texts: list[bytes], languages: list[str], steps: int = STEPS, seed: int = 5, rate: float = 0.02
) -> Network:
    """Learn from (text, language) pairs by Adam; every position of a text has its language as label."""
    names = sorted(set(languages))
    network = Network.start(names, seed)
    if len(names) < 2:
        return network
    wanted = np.array([names.index(x) for x in languages])
    codes = np.zeros((STRETCH, len(texts)), np.uint8)
    weight = np.zeros((STRETCH, len(texts)), np.float32)
    for i, text in enumerate(texts):
        piece = np.frombuffer(text[:STRETCH], np.uint8)
        codes[: len(piece), i] = piece
        weight[: len(piece), i] = 1
    draw = np.random.default_rng(seed)
    size = min(TOGETHER, len(texts))
    first = [np.zeros_like(x) for x in network.parts()]
    second = [np.zeros_like(x) for x in network.parts()]
    order = draw.permutation(len(texts))
    for count in range(1, steps + 1):
        if len(order) < size:
            order = draw.permutation(len(texts))
        chosen, order = order[:size], order[size:]
        w = weight[:, chosen]
        _, gradients = network.step(codes[:, chosen], wanted[chosen], w / max(w.sum(), 1))
        speed = rate * (1 - 0.9 * count / steps)
        for x, g, a, b in zip(network.parts(), gradients, first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= speed * (a / (1 - 0.9**count)) / (np.sqrt(b / (1 - 0.99**count)) + 1e-8)
    return network


def learn(docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE) -> Network:
    """Train on about ``per_language`` distinct texts of each language among the ``usable`` rows.

    Which ones, and which stretch of each (a place anywhere in the text), is
    chosen by a hash of the text, so the sample is the same in every run.
    Copies of a text count once, however many there are, and the sample never
    has more than twice as many rows as asked for.
    """
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    texts = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n"))
    counts = {r.lang: r.n for r in texts.collect()}  # one row per language
    if not counts:
        return train([], [])
    share = F.create_map(*[
        F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, per_language / max(n, 1)))
    ])
    key = F.xxhash64("text")
    place = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - STRETCH + 1, F.lit(1)))
    drawn = rows.filter(F.pmod(key, F.lit(1 << 24)) / float(1 << 24) < share[F.col("lang")])
    pieces = drawn.select("lang", key.alias("key"), F.substr("text", place.cast("int") + 1, F.lit(STRETCH)).alias("piece"))
    sample = pieces.groupBy("lang", "key").agg(F.min("piece").alias("piece")).orderBy("key", "lang")
    found = sorted((r.piece.encode(), r.lang) for r in sample.limit(2 * per_language * len(counts)).collect())
    return train([t for t, _ in found], [l for _, l in found])


def predict(docs: DataFrame, network: Network) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: the likeliest language and its pooled probability.

    All positions of the whole text are labelled; the document's probabilities
    are the mean over its positions. Null, empty and letterless texts get
    ``und`` and 0, and so does every text if no language was learnt. Columns of
    these names are replaced; rows that repeat get equal results.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "__letters")]
    marked = docs.select(*names, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters"))

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        data, offsets = raw_text(batch.column(batch.schema.get_field_index("text")))
        letters = batch.column(batch.schema.get_field_index("__letters")).to_numpy(zero_copy_only=False)
        if not network.languages:
            return {"lang_pred": ["und"] * batch.num_rows, "score": np.zeros(batch.num_rows)}
        pooled = pool(network, data, offsets)
        best = pooled.argmax(1)
        score = np.where(letters, np.clip(pooled.max(1), 0, 1), 0.0)
        return {"lang_pred": [network.languages[b] if l else "und" for b, l in zip(best, letters)], "score": score}

    return append(marked, "lang_pred string, score double", work).drop("__letters")


def pool(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean label probabilities (texts, languages) over all positions of each text, whose states start anew every STRETCH bytes."""
    sizes = np.diff(offsets)
    counts = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[owner] + number * STRETCH
    length = np.minimum(STRETCH, offsets[owner + 1] - start)
    total = np.zeros((len(sizes), len(network.languages)))
    padded = np.append(data, np.zeros(STRETCH, np.uint8))
    for at in range(0, len(owner), BATCH):
        s, n = start[at : at + BATCH], length[at : at + BATCH]
        inside = np.arange(STRETCH)[:, None] < n[None, :]
        codes = padded[s[None, :] + np.arange(STRETCH)[:, None]] * inside
        p = network.labels(network.states(codes))
        p *= inside[:, None, :]
        np.add.at(total, owner[at : at + BATCH], p.sum(0).T)
    return total / np.maximum(sizes, 1)[:, None]


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = bucket("doc_id", 5) == 0
    network = learn(docs, ~held_out)
    return predict(docs.select("doc_id", "text"), network).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )
