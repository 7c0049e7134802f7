"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled windows. Prediction
cuts every whole text into windows, labels each byte from what precedes and follows it in its window, and averages
the label probabilities over the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.llm.common import slices, stage
from threatloom.operators.shaping import top_per_group

# Bound of the training sample: so many documents per language, so many windows of so many characters of each.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC, WINDOW = 256, 8, 48
HIDDEN = 6
EPOCHS, BATCH, RATE = 8, 256, 0.02
UNKNOWN = "und"
_SLICE = 1 << 20
_WINDOWS_AT_ONCE = 2048


def held_out(doc_id: Column) -> Column:
    """Documents kept out of the training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """One gated recurrent layer per direction and a softmax over both states at every position.

    Arrays have features in rows and windows in columns. Per direction: ``embed`` (input of each byte value to the
    update gate, the reset gate and the candidate), ``gates`` and ``candidate`` (recurrent weights).
    """

    def __init__(self, languages: list[str], seed: int = 7):
        draw = np.random.default_rng(seed)
        self.languages = languages
        h, c = HIDDEN, len(languages)
        self.weights = {}
        for way in ("ahead", "back"):
            self.weights[way, "embed"] = draw.normal(0, 0.3, (256, 3 * h)).astype(np.float32)
            self.weights[way, "gates"] = draw.normal(0, 0.4, (2 * h, h)).astype(np.float32)
            self.weights[way, "candidate"] = draw.normal(0, 0.4, (h, h)).astype(np.float32)
        self.weights["out"] = draw.normal(0, 0.3, (c, 2 * h)).astype(np.float32)
        self.weights["bias"] = np.zeros((c, 1), dtype=np.float32)

    def _states(self, way: str, windows: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (position, feature, window) of one direction; windows are (position, window) byte values."""
        h = HIDDEN
        embed, gates, candidate = (self.weights[way, k] for k in ("embed", "gates", "candidate"))
        length, n = windows.shape
        states = np.empty((length, h, n), dtype=np.float32)
        state = np.zeros((h, n), dtype=np.float32)
        for t in range(length) if way == "ahead" else range(length - 1, -1, -1):
            given = embed[windows[t]].T
            both = gates @ state
            both += given[: 2 * h]
            both = _sigmoid(both)
            update, reset = both[:h], both[h:]
            fresh = candidate @ (reset * state)
            fresh += given[2 * h :]
            fresh *= 2
            fresh = _sigmoid(fresh)
            fresh *= 2
            fresh -= 1
            if trace is not None:
                trace.append((t, state, update, reset, fresh))
            state = state + update * (fresh - state)
            states[t] = state
        return states

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(position, language, window) probabilities."""
        states = np.concatenate([self._states("ahead", windows), self._states("back", windows)], axis=1)
        scores = np.matmul(self.weights["out"], states)
        scores += self.weights["bias"]
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, windows: np.ndarray, valid: np.ndarray, target: np.ndarray) -> dict:
        """Gradients of the mean cross-entropy over all valid positions, by backpropagation through time."""
        h = HIDDEN
        traces: dict[str, list] = {"ahead": [], "back": []}
        states = np.concatenate([self._states(way, windows, traces[way]) for way in traces], axis=1)
        scores = np.matmul(self.weights["out"], states) + self.weights["bias"]
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        scores[:, target, np.arange(len(target))] -= 1
        scores *= valid[:, None, :] / max(1, valid.sum())
        found = {
            "out": np.einsum("tcn,thn->ch", scores, states),
            "bias": scores.sum(axis=(0, 2))[:, None],
        }
        into = np.matmul(self.weights["out"].T, scores)
        for way, offset in (("ahead", 0), ("back", h)):
            gates, candidate = self.weights[way, "gates"], self.weights[way, "candidate"]
            d_embed = np.zeros_like(self.weights[way, "embed"])
            d_gates, d_candidate = np.zeros_like(gates), np.zeros_like(candidate)
            later = np.zeros((h, windows.shape[1]), dtype=np.float32)
            for t, state, update, reset, fresh in reversed(traces[way]):
                d_state = into[t, offset : offset + h] + later
                d_fresh = d_state * update * (1 - fresh * fresh)
                d_update = d_state * (fresh - state) * update * (1 - update)
                d_reset_state = candidate.T @ d_fresh
                d_reset = d_reset_state * state * reset * (1 - reset)
                d_both = np.concatenate([d_update, d_reset])
                later = d_state * (1 - update) + d_reset_state * reset + gates.T @ d_both
                d_gates += d_both @ state.T
                d_candidate += d_fresh @ (reset * state).T
                np.add.at(d_embed, windows[t], np.concatenate([d_both, d_fresh]).T)
            found[way, "embed"], found[way, "gates"], found[way, "candidate"] = d_embed, d_gates, d_candidate
        return found

    def fit(self, windows: np.ndarray, valid: np.ndarray, target: np.ndarray, seed: int = 11) -> None:
        draw = np.random.default_rng(seed)
        mean = {k: np.zeros_like(w) for k, w in self.weights.items()}
        square = {k: np.zeros_like(w) for k, w in self.weights.items()}
        step, steps = 0, EPOCHS * -(-len(target) // BATCH)
        for _ in range(EPOCHS):
            order = draw.permutation(len(target))
            for at in range(0, len(order), BATCH):
                step += 1
                own = order[at : at + BATCH]
                rate = RATE * (1 - (step - 1) / steps)
                for k, g in self.gradients(windows[:, own], valid[:, own], target[own]).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.01 * (g * g - square[k])
                    scale = (1 - 0.9**step) / np.sqrt(1 - 0.99**step)
                    self.weights[k] -= (rate / scale * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut whole texts into windows: (position, window) bytes, the valid positions, and each window's text."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], dtype=np.int64)
    padded = b"".join(t.ljust(int(c) * WINDOW, b"\0") for t, c in zip(texts, counts, strict=True))
    cut = np.frombuffer(padded, dtype=np.uint8).reshape(-1, WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    last = np.cumsum(counts)[counts > 0] - 1
    lengths = np.full(len(cut), WINDOW)
    lengths[last] = np.array([len(t) for t, c in zip(texts, counts, strict=True) if c]) - (counts[counts > 0] - 1) * WINDOW
    valid = np.arange(WINDOW)[:, None] < lengths[None, :]
    return np.ascontiguousarray(cut.T), valid, owner


def train(docs: DataFrame) -> Network | None:
    """Fit the network on labelled rows of ``docs`` (doc_id, text, lang) that are not held out.

    The sample is bounded by DOCS_PER_LANGUAGE x WINDOWS_PER_DOC windows per language: documents in hash order of
    their ids, windows at positions drawn by hash over the whole text. Null texts and labels teach nothing; without
    any labelled text there is no network.
    """
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = top_per_group(
        labelled.select("doc_id", "lang"), ["lang"], DOCS_PER_LANGUAGE, F.xxhash64("doc_id"), F.col("doc_id")
    ).select("doc_id", "lang").distinct()
    # Stored, so that Spark knows how few ids there are and need not shuffle the texts to find them.
    chosen = stage(chosen, "language-sample")
    texts = labelled.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"], "left_semi")
    room = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    cuts = [
        F.substring("text", F.pmod(F.xxhash64("doc_id", F.lit(i)), room.cast("long")).cast("int") + 1, F.lit(WINDOW))
        for i in range(WINDOWS_PER_DOC)
    ]
    rows = texts.where("length(text) > 0").select("doc_id", "lang", F.array(*cuts).alias("cuts")).collect()
    samples = sorted({(r.lang, r.doc_id, cut) for r in rows for cut in r.cuts if any(map(str.isalpha, cut))})
    if not samples:
        return None
    languages = sorted({s[0] for s in samples})
    windows, valid, owner = windows_of([cut.encode()[:WINDOW] for _, _, cut in samples])
    number = {language: i for i, language in enumerate(languages)}
    target = np.array([number[s[0]] for s in samples])[owner]
    network = Network(languages)
    network.fit(windows, valid.astype(np.float32), target)
    return network


def pooled(network: Network, texts: list[bytes]) -> np.ndarray:
    """(text, language) probabilities, averaged over all bytes of each text."""
    windows, valid, owner = windows_of(texts)
    total = np.zeros((len(texts), len(network.languages)))
    for at in range(0, windows.shape[1], _WINDOWS_AT_ONCE):
        part = slice(at, at + _WINDOWS_AT_ONCE)
        likely = network.probabilities(windows[:, part])
        likely *= valid[:, None, part]
        sums = likely.sum(axis=0, dtype=np.float64)
        for c in range(len(network.languages)):
            total[:, c] += np.bincount(owner[part], weights=sums[c], minlength=len(texts))
    return total / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) for each row; ``score`` is the pooled probability of the predicted language.

    A null text, one without a letter, or any text when there is no network, is ``und`` with score 0. Ties go to the
    language first in the alphabet. Rows are independent: nothing is shuffled, a row repeats as it came.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, texts in slices(batches, "text", _SLICE):
            readable = [
                i for i, t in enumerate(texts) if model is not None and t is not None and any(map(str.isalpha, t.decode("utf-8", "replace")))
            ]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if readable:
                likely = pooled(model, [texts[i] for i in readable])
                for i, row in zip(readable, likely, strict=True):
                    best = int(row.round(9).argmax())
                    names[i], scores[i] = model.languages[best], round(min(1.0, float(row[best])), 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def rejected(lang_pred: Column) -> Column:
    """What a filter drops: texts in no language that was learned."""
    return lang_pred == UNKNOWN
