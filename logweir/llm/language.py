"""Language of each text by a bidirectional gated recurrent network over bytes.

The network reads runs of letters as lower-case UTF-8 bytes, one gated recurrent unit forwards and one
backwards, and gives every byte a probability for each language from both states.  It is trained in
numpy by backpropagation through time on the labelled documents that are not held out.  A document's
log-probabilities are pooled over all its bytes; the language with the largest mean wins and the score
is its share.  States start anew at each run, so a run's sums depend on the run alone: each Python
worker computes a run once and looks it up after that, however often it comes.  Whole texts are read;
runs longer than ``PIECE`` bytes are read in pieces.

The training sample is bounded: ``SAMPLE_DOCS`` documents in all, the same number of each language,
in a fixed random order, and ``RUNS_PER_DOC`` runs of each, spread over the text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if there
is nothing to learn from; rows with equal texts get equal answers; an empty table gives no rows; extra
columns, ``lang`` and ``source`` among them, are no input of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logweir.llm.common import slices
from logweir.llm.folds import held_out, order_key

SAMPLE_DOCS = 2_400
RUNS_PER_DOC = 120
HIDDEN = 8
BATCH = 512
STEPS = 500
RATE = 0.01
PIECE = 64
KEPT_RUNS = 300_000
LETTERS = re.compile(r"[^\W\d_]+")


def runs(text: str) -> list[bytes]:
    """Runs of letters as lower-case bytes, long ones in pieces."""
    out = []
    for found in LETTERS.findall(text.lower()):
        # The pattern takes signs such as superscripts and fractions for letters; they only divide runs.
        for run in (found,) if found.isalpha() else "".join(c if c.isalpha() else " " for c in found).split():
            data = run.encode()
            out += [data] if len(data) <= PIECE else [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights per direction: bytes to gates (256 x 3h), state to gates (h x 3h); out: both states to languages."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 10) -> Network:
        rng = np.random.default_rng(seed)
        weights = {}
        for way in ("f", "b"):
            weights[f"x{way}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            weights[f"h{way}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
        weights["o"] = rng.normal(0, 1 / np.sqrt(hidden), (2 * hidden, len(languages))).astype(np.float32)
        weights["c"] = np.zeros(len(languages), np.float32)
        return cls(languages, weights)

    def states(self, data: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States of one direction for runs of one length (n x length bytes): n x length x h."""
        x, u = self.weights[f"x{way}"], self.weights[f"h{way}"]
        h = u.shape[0]
        state = np.zeros((len(data), h), np.float32)
        out = np.empty((*data.shape, h), np.float32)
        steps = range(data.shape[1]) if way == "f" else range(data.shape[1] - 1, -1, -1)
        for t in steps:
            gates = x[data[:, t]]
            inner = state @ u
            both = _sigmoid(gates[:, :2 * h] + inner[:, :2 * h])
            reset, update = both[:, :h], both[:, h:]
            new = np.tanh(gates[:, 2 * h:] + reset * inner[:, 2 * h:])
            if keep is not None:
                keep.append((t, state, reset, update, new, inner[:, 2 * h:]))
            state = new + update * (state - new)
            out[:, t] = state
        return out

    def log_probabilities(self, data: np.ndarray) -> np.ndarray:
        both = np.concatenate((self.states(data, "f"), self.states(data, "b")), axis=2)
        logits = both @ self.weights["o"] + self.weights["c"]
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))

    def sums(self, found: list[bytes]) -> np.ndarray:
        """Log-probabilities of each run, added over its bytes."""
        out = np.zeros((len(found), len(self.languages)), np.float32)
        lengths = np.array([len(r) for r in found])
        for length in np.unique(lengths):
            for rows in np.array_split(here := np.flatnonzero(lengths == length), -(-len(here) // 4096)):
                data = np.frombuffer(b"".join([found[i] for i in rows]), np.uint8).reshape(len(rows), length)
                out[rows] = self.log_probabilities(data).sum(axis=1)
        return out

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss per byte and its gradients, back through all steps of both directions."""
        h = self.weights["hf"].shape[0]
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self.states(data, way, kept[way]) for way in ("f", "b")], axis=2)
        logits = both @ self.weights["o"] + self.weights["c"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        n = data.size
        rows = np.arange(len(data))
        loss = float(-np.log(p[rows, :, label] + 1e-12).sum() / n)
        p[rows, :, label] -= 1
        p /= n
        grads = {"o": np.einsum("nth,ntl->hl", both, p), "c": p.sum(axis=(0, 1))}
        from_out = p @ self.weights["o"].T
        for k, way in enumerate(("f", "b")):
            u = self.weights[f"h{way}"]
            gx, gu = np.zeros_like(self.weights[f"x{way}"]), np.zeros_like(u)
            later = np.zeros((len(data), h), np.float32)
            for t, state, reset, update, new, inner in reversed(kept[way]):
                d = later + from_out[:, t, k * h:(k + 1) * h]
                d_new = d * (1 - update) * (1 - new * new)
                d_update = d * (state - new) * update * (1 - update)
                d_reset = d_new * inner * reset * (1 - reset)
                at_gates = np.concatenate((d_reset, d_update, d_new), axis=1)
                at_inner = np.concatenate((d_reset, d_update, d_new * reset), axis=1)
                np.add.at(gx, data[:, t], at_gates)
                gu += state.T @ at_inner
                later = d * update + at_inner @ u.T
            grads[f"x{way}"], grads[f"h{way}"] = gx, gu
        return loss, grads

    def train(self, found: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 10) -> list[float]:
        """Adam over batches of runs of one length, drawn as often as the length is there."""
        rng = np.random.default_rng(seed)
        lengths = np.array([len(r) for r in found])
        by_length = {int(x): np.flatnonzero(lengths == x) for x in np.unique(lengths)}
        sizes = np.array([len(v) * k for k, v in by_length.items()], float)
        draws = rng.choice(list(by_length), size=steps, p=sizes / sizes.sum())
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses = []
        for step, length in enumerate(draws.tolist(), 1):
            pool = by_length[length]
            rows = pool[rng.integers(0, len(pool), min(BATCH, 4 * len(pool)))]
            data = np.frombuffer(b"".join([found[i] for i in rows]), np.uint8).reshape(len(rows), length)
            loss, grads = self.gradients(data, labels[rows])
            losses.append(loss)
            rate = RATE * (1 - 0.9 * step / steps)
            for name, g in grads.items():
                np.clip(g, -1, 1, out=g)
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                self.weights[name] -= (rate * (first[name] / (1 - 0.9 ** step))
                                       / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return losses


def training_runs(docs: DataFrame) -> tuple[list[bytes], list[str]]:
    """Runs and their languages from a bounded sample of the documents that are not held out."""
    known = (docs.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL").filter(~held_out()))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_DOCS).collect()}
    if not counts:
        return [], []
    each = max(1, SAMPLE_DOCS // len(counts))
    # Twice what is wanted is let through by chance, by the fixed order, before the order cuts exactly.
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, 2 * each / n)))])
    chance = F.conv(F.substring(order_key(), 1, 8), 16, 10).cast("double") / float(1 << 32)
    some = known.filter(chance < share[F.col("lang")])
    ranked = some.select("doc_id", "lang", order_key().alias("k"))
    rank = Window.partitionBy("lang").orderBy("k", "doc_id")
    chosen = ranked.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= each).select("doc_id", "lang")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch):
                out = []
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    found = runs(text)
                    out += [(r, lang) for r in found[::max(1, -(-len(found) // RUNS_PER_DOC))]]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())],
                                                 names=["run", "lang"])

    sample = some.join(F.broadcast(chosen), ["doc_id", "lang"]).select("text", "lang").mapInArrow(batches, "run binary, lang string")
    rows = sorted((r["run"], r["lang"]) for r in sample.collect())
    return [bytes(r) for r, _ in rows], [x for _, x in rows]


def learn(docs: DataFrame) -> Network | None:
    found, langs = training_runs(docs)
    if not found:
        return None
    names = sorted(set(langs))
    network = Network.fresh(names)
    if len(names) > 1:
        network.train(found, np.array([names.index(x) for x in langs]))
    return network


class Pool:
    """Sums of the runs a Python worker has met, and documents pooled from them."""

    def __init__(self, network: Network):
        self.network, self.place, self.table = network, {}, np.zeros((1024, len(network.languages)), np.float32)

    def learn(self, found: list[bytes]) -> None:
        if len(self.place) > KEPT_RUNS:
            self.place = {}
        new = [r for r in dict.fromkeys(found) if r not in self.place]
        start = len(self.place)
        if start + len(new) > len(self.table):
            grown = np.zeros((2 * (start + len(new)), self.table.shape[1]), np.float32)
            grown[:start] = self.table[:start]
            self.table = grown
        if new:
            self.table[start:start + len(new)] = self.network.sums(new)
            self.place.update(zip(new, range(start, start + len(new))))

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        split = [runs(t) if t else [] for t in texts]
        self.learn([r for found in split for r in found])
        place = self.place
        for found in split:
            if not found:
                yield "und", 0.0
                continue
            rows = np.fromiter(map(place.__getitem__, found), np.int64, len(found))
            mean = self.table[rows].sum(axis=0, dtype=np.float64) / sum(map(len, found))
            share = np.exp(mean - mean.max())
            share /= share.sum()
            best = int(share.argmax())
            yield self.network.languages[best], float(share[best])


_pools: dict[str, Pool] = {}


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    key = None if network is None else f"{hash(network.weights['o'].tobytes())}"

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if network is not None and key not in _pools:
            _pools.clear()
            _pools[key] = Pool(network)
        for batch in rows:
            for part in slices(batch, 512):
                texts = part.column("text").to_pylist()
                done = list(_pools[key].predict(texts)) if network is not None else [("und", 0.0)] * len(texts)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array([d[0] for d in done], pa.string()),
                    pa.array([d[1] for d in done], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    slim = docs.select("doc_id", held_out().alias("held_out"), "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(batches, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
