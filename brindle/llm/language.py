"""Language of a text: a bidirectional gated recurrent network over its bytes.

The whole text is cut into windows of ``WINDOW`` bytes. In each, one network reads
forwards and one backwards, and a linear layer over both states gives every byte
position a probability for each language. A text's probabilities are the mean over
all its positions. Many windows run side by side, so a step is a few array
operations whatever the lengths of the texts.

Training is backpropagation through time in numpy, on windows of a bounded sample:
about ``per_language`` documents of each language and at most ``most`` in all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import text
from brindle.llm.tables import bounded

WINDOW = 96
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Settings:
    per_language: int = 1_200
    most: int = 20_000
    windows_per_text: int = 6
    hidden: int = 8
    steps: int = 200
    batch: int = 256
    rate: float = 0.02
    seed: int = 11


@dataclass
class Network:
    """``tables``: byte -> gate inputs, forwards and backwards; ``loops``: state -> gate
    inputs; ``heads``: state -> language scores; ``bias``: of the scores."""

    languages: list[str]
    tables: list[np.ndarray]
    loops: list[np.ndarray]
    heads: list[np.ndarray]
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.loops, *self.heads, self.bias]


def new_network(languages: list[str], hidden: int, seed: int) -> Network:
    r = np.random.default_rng(seed)

    def small(*shape: int, size: float) -> np.ndarray:
        return (r.standard_normal(shape) * size).astype(np.float32)

    return Network(
        languages,
        [small(256, 3 * hidden, size=0.3) for _ in range(2)],
        [small(hidden, 3 * hidden, size=hidden**-0.5) for _ in range(2)],
        [small(hidden, len(languages), size=hidden**-0.5) for _ in range(2)],
        np.zeros(len(languages), np.float32),
    )


def _step(given: np.ndarray, loop: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """Update gate, reset gate, proposal, the state's part of the proposal, new state."""
    n = h.shape[1]
    inner = h @ loop
    gates = inner[:, : 2 * n]
    gates += given[:, : 2 * n]
    gates *= np.float32(0.5)
    np.tanh(gates, out=gates)
    gates *= np.float32(0.5)
    gates += np.float32(0.5)
    update, reset, own = gates[:, :n], gates[:, n:], inner[:, 2 * n :]
    proposal = reset * own
    proposal += given[:, 2 * n :]
    np.tanh(proposal, out=proposal)
    new = h - proposal
    new *= update
    new += proposal
    return update, reset, proposal, own, new


def label_positions(net: Network, window: np.ndarray) -> np.ndarray:
    """Probabilities (position, window, language) for bytes (position, window)."""
    length, n = window.shape
    hidden = net.loops[0].shape[0]
    scores = np.empty((length, n, len(net.languages)), np.float32)
    scores[:] = net.bias
    for table, loop, head, order in zip(net.tables, net.loops, net.heads, (range(length), range(length - 1, -1, -1))):
        h = np.zeros((n, hidden), np.float32)
        for t in order:
            h = _step(table[window[t]], loop, h)[-1]
            scores[t] += h @ head
    np.exp(scores - scores.max(axis=2, keepdims=True), out=scores)
    scores /= scores.sum(axis=2, keepdims=True)
    return scores


def gradients(net: Network, window: np.ndarray, weight: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over the weighted positions, and its gradient, back through time."""
    length, n = window.shape
    hidden, languages = net.loops[0].shape[0], len(net.languages)
    states, traces = [], []
    scores = np.empty((length, n, languages), np.float32)
    scores[:] = net.bias
    orders = (range(length), range(length - 1, -1, -1))
    for table, loop, head, order in zip(net.tables, net.loops, net.heads, orders):
        h, trace = np.zeros((n, hidden), np.float32), {}
        state = np.empty((length, n, hidden), np.float32)
        for t in order:
            update, reset, proposal, own, new = _step(table[window[t]], loop, h)
            trace[t] = (h, update, reset, proposal, own)
            h = state[t] = new
        scores += state @ head
        states.append(state)
        traces.append(trace)
    np.exp(scores - scores.max(axis=2, keepdims=True), out=scores)
    scores /= scores.sum(axis=2, keepdims=True)
    total = float(weight.sum())
    picked = scores[:, np.arange(n), label]
    loss = float(-(np.log(picked + 1e-9) * weight).sum() / total)
    wrong = scores
    wrong[:, np.arange(n), label] -= 1
    wrong *= (weight / total)[:, :, None].astype(np.float32)

    tables, loops, heads = [], [], []
    flat = wrong.reshape(-1, languages)
    for loop, head, order, state, trace in zip(net.loops, net.heads, orders, states, traces):
        heads.append(state.reshape(-1, hidden).T @ flat)
        from_head = wrong @ head.T
        back = np.zeros((n, hidden), np.float32)
        given = np.empty((length, n, 3 * hidden), np.float32)
        d_loop = np.zeros_like(loop)
        for t in reversed(order):
            before, update, reset, proposal, own = trace[t]
            d = back + from_head[t]
            d_proposal = d * (1 - update) * (1 - proposal * proposal)
            d_update = d * (before - proposal) * update * (1 - update)
            d_reset = d_proposal * own * reset * (1 - reset)
            inner = np.concatenate([d_update, d_reset, d_proposal * reset], axis=1)
            given[t] = np.concatenate([d_update, d_reset, d_proposal], axis=1)
            d_loop += before.T @ inner
            back = d * update + inner @ loop.T
        loops.append(d_loop)
        byte = window.ravel()
        columns = given.reshape(-1, 3 * hidden).T
        tables.append(np.stack([np.bincount(byte, c, 256) for c in columns], axis=1).astype(np.float32))
    return loss, [*tables, *loops, *heads, flat.sum(axis=0)]


def train(windows: np.ndarray, lengths: np.ndarray, label: np.ndarray, languages: list[str], s: Settings) -> Network:
    """Fit by Adam on rows of ``windows`` (zero-padded bytes), every position labelled."""
    net = new_network(languages, s.hidden, s.seed)
    if len(windows) == 0 or len(languages) < 2:
        return net
    r = np.random.default_rng(s.seed)
    of = [np.flatnonzero(label == k) for k in range(len(languages))]
    of = [rows for rows in of if len(rows)]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, s.steps + 1):
        picked = np.concatenate([r.choice(rows, max(1, s.batch // len(of))) for rows in of])
        weight = (np.arange(windows.shape[1])[:, None] < lengths[picked]).astype(np.float32)
        _, found = gradients(net, windows[picked].T, weight, label[picked])
        size = max(1.0, float(np.sqrt(sum((g * g).sum() for g in found))))
        rate = s.rate * min(1.0, 2 * (1 - step / (s.steps + 1)))
        for p, g, m, v in zip(net.parameters(), found, first, second):
            g = g / size
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def fit(labelled: DataFrame, key: str = "doc_id", body: str = "text", language: str = "lang",
        settings: Settings = Settings()) -> Network:
    """A network from rows whose ``language`` and ``body`` are not null."""
    s = settings
    known = labelled.select(
        F.col(key).alias("_key"), F.col(body).alias("_text"), F.col(language).alias("_lang")
    ).where("_lang is not null and length(_text) > 0")
    counts = {r._lang: r["count"] for r in known.groupBy("_lang").count().orderBy("_lang").collect()}
    languages = sorted(counts)
    if not languages:
        return new_network([UNDETERMINED], s.hidden, s.seed)
    share = F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, min(1.0, s.per_language / n))])
    chance = F.pmod(F.xxhash64(F.lit("language"), "_key"), F.lit(1_000_003)) / 1_000_003.0
    sample = bounded(known.where(chance < share[F.col("_lang")]).select("_key"), "_key", s.most)
    rows = known.join(F.broadcast(sample.distinct()), "_key", "left_semi")
    number = {l: k for k, l in enumerate(languages)}

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, parts = [], []
            for body, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = body.encode()
                last = max(0, len(raw) - WINDOW)
                for at in sorted({int(x) for x in np.linspace(0, last, s.windows_per_text)}):
                    parts.append(raw[at : at + WINDOW])
                    labels.append(number[lang])
            yield pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.binary()), "label": pa.array(labels, pa.int32())})

    # at most most * windows_per_text windows of WINDOW bytes
    got = rows.select("_text", "_lang").mapInArrow(cut, "part binary, label int").toPandas()
    got = got.sort_values(["label", "part"])  # the order must not depend on the tasks
    windows = np.zeros((len(got), WINDOW), np.uint8)
    for i, part in enumerate(got["part"]):
        windows[i, : len(part)] = np.frombuffer(part, np.uint8)
    lengths = got["part"].map(len).to_numpy()
    return train(windows, lengths, got["label"].to_numpy(), languages, s)


def pooled(net: Network, data: np.ndarray, at: np.ndarray, side_by_side: int = 1024) -> np.ndarray:
    """Mean probabilities over all positions of each text; zeros for an empty one."""
    sizes = np.diff(at)
    per_text = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), per_text)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = at[:-1][row] + nth * WINDOW
    length = np.minimum(WINDOW, at[1:][row] - begin)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    total = np.zeros((len(sizes), len(net.languages)))
    steps = np.arange(WINDOW)[:, None]
    for lo in range(0, len(row), side_by_side):
        part = slice(lo, lo + side_by_side)
        inside = steps < length[part]
        window = np.where(inside, padded[begin[part] + steps], 0)
        labels = label_positions(net, window)
        labels *= inside[:, :, None]
        np.add.at(total, row[part], labels.sum(axis=0))
    return total / np.maximum(sizes, 1)[:, None]


def predict(documents: DataFrame, net: Network, key: str = "doc_id", body: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and its ``score`` for each row, without a shuffle.

    A null text or one without a letter gets ``und`` with score 0. Ties go to the
    language that sorts first.
    """
    shared = documents.sparkSession.sparkContext.broadcast(net)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array(model.languages, object)
        for batch in batches:
            for lo, hi, data, at in text.pieces(batch.column(1)):
                mean = pooled(model, data, at)
                best = mean.argmax(axis=1)
                raw = data.tobytes()
                lettered = np.array(
                    [bool(_LETTER.search(raw[b:e].decode("utf-8", "replace"))) for b, e in zip(at[:-1].tolist(), at[1:].tolist())],
                    bool,
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": batch.column(0)[lo:hi],
                        "lang_pred": pa.array(np.where(lettered, names[best], UNDETERMINED), pa.string()),
                        "score": np.where(lettered, np.clip(mean.max(axis=1), 0, 1), 0.0),
                    }
                )

    rows = documents.select(F.col(key).alias("key"), F.col(body).alias("body"))
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)
