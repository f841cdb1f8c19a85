"""Language identification: a bidirectional gated recurrent network over bytes, in numpy."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.llm.common import id_crc, slices, texts

_ASCII_LETTER = re.compile(rb"[A-Za-z]")
#: A text is read in stretches of so many bytes, through the ends of words.
STRETCH = 24


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class _Gru:
    """One direction: tables of input weights by byte, recurrent weights, and the gates' arithmetic."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        self.params = {
            "x": rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
            "h": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32),
        }

    def forward(self, seq: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States ``(length, batch, hidden)`` for byte sequences ``(length, batch)``."""
        k = self.hidden
        h = np.zeros((seq.shape[1], k), np.float32)
        out = np.empty((*seq.shape, k), np.float32)
        for t in range(len(seq)):
            x, u = self.params["x"][seq[t]], h @ self.params["h"]
            gates = _sigmoid(x[:, : 2 * k] + u[:, : 2 * k])
            z, r = gates[:, :k], gates[:, k:]
            n = np.tanh(x[:, 2 * k :] + r * u[:, 2 * k :])
            if keep is not None:
                keep.append((h, u, z, r, n))
            h = n + z * (h - n)
            out[t] = h
        return out

    def backward(self, seq: np.ndarray, kept: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients by backpropagation through time."""
        k = self.hidden
        grad = {name: np.zeros_like(p) for name, p in self.params.items()}
        dh = np.zeros((seq.shape[1], k), np.float32)
        rows, steps = [], []
        for t in range(len(seq) - 1, -1, -1):
            h, u, z, r, n = kept[t]
            dh = dh + d_out[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * u[:, 2 * k :] * r * (1 - r)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            grad["h"] += h.T @ du
            rows.append(seq[t])
            steps.append(np.concatenate([dz, dr, dn], axis=1))
            dh = dh * z + du @ self.params["h"].T
        np.add.at(grad["x"], np.concatenate(rows), np.concatenate(steps))
        return grad


class LanguageModel:
    """Reads a stretch of bytes in both directions and labels every byte with a language."""

    def __init__(self, languages: list[str], hidden: int = 8, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = _Gru(hidden, rng), _Gru(hidden, rng)
        self.head = {
            "w": rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32),
            "b": np.zeros(len(languages), np.float32),
        }

    def _states(self, seq: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
        a, b = keep or (None, None)
        return np.concatenate([self.ahead.forward(seq, a), self.back.forward(seq[::-1], b)[::-1]], axis=2)

    def positions(self, seq: np.ndarray) -> np.ndarray:
        """Log-probabilities of the languages at every byte: ``(length, batch, languages)``."""
        logits = self._states(seq) @ self.head["w"] + self.head["b"]
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))

    def train(self, parts: list[tuple[bytes, int]], epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 6) -> None:
        """Adam on the mean cross-entropy of all positions; parts of texts of one length make a batch."""
        rng = np.random.default_rng(seed)
        by_length: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
        for part, y in parts:
            if part:
                by_length[len(part)].append((part, y))
        sets = {
            n: (np.frombuffer(b"".join(w for w, _ in some), np.uint8).reshape(-1, n), np.array([y for _, y in some]))
            for n, some in sorted(by_length.items())
        }
        groups = [self.ahead.params, self.back.params, self.head]
        moments = [{k: (np.zeros_like(v), np.zeros_like(v)) for k, v in g.items()} for g in groups]
        step = 0
        for _ in range(epochs):
            batches = []
            for n, (_, y) in sets.items():
                order = rng.permutation(len(y))
                batches += [(n, order[at : at + batch]) for at in range(0, len(y), batch)]
            for k in rng.permutation(len(batches)).tolist():
                n, rows = batches[k]
                grads = self._gradients(sets[n][0][rows].T, sets[n][1][rows])
                step += 1
                for g, d, m in zip(groups, grads, moments, strict=True):
                    for name in g:
                        m1, m2 = m[name]
                        m1 += 0.1 * (d[name] - m1)
                        m2 += 0.001 * (d[name] ** 2 - m2)
                        g[name] -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, seq: np.ndarray, y: np.ndarray) -> list[dict[str, np.ndarray]]:
        kept: tuple[list, list] = ([], [])
        states = self._states(seq, kept)
        logits = states @ self.head["w"] + self.head["b"]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(len(y)), y] -= 1
        p /= p.shape[0] * p.shape[1]
        d_states = p @ self.head["w"].T
        k = self.ahead.hidden
        flat = states.reshape(-1, states.shape[2])
        head = {"w": flat.T @ p.reshape(len(flat), -1), "b": p.sum(axis=(0, 1))}
        ahead = self.ahead.backward(seq, kept[0], d_states[:, :, :k])
        back = self.back.backward(seq[::-1], kept[1], np.ascontiguousarray(d_states[::-1, :, k:]))
        return [ahead, back, head]

    def pooled(self, raws: list[bytes], batch: int = 4096) -> np.ndarray:
        """Probabilities of the languages for each whole text: the normalised product over positions, tempered by length."""
        sums = np.zeros((len(raws), len(self.languages)))
        held: list[tuple[int, bytes]] = []

        def read() -> None:
            lengths = np.array([len(part) for _, part in held])
            seq = np.frombuffer(b"".join([part.ljust(STRETCH) for _, part in held]), np.uint8).reshape(-1, STRETCH).T
            found = self.positions(seq) * (np.arange(STRETCH)[:, None] < lengths)[:, :, None]
            np.add.at(sums, np.array([i for i, _ in held]), found.sum(axis=0, dtype=np.float64))
            held.clear()

        for i, raw in enumerate(raws):
            for at in range(0, len(raw), STRETCH):
                held.append((i, raw[at : at + STRETCH]))
                if len(held) == batch:
                    read()
        if held:
            read()
        total = sums / np.sqrt(np.maximum(1, [len(raw) for raw in raws]))[:, None]
        out = np.exp(total - total.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def has_letter(raw: bytes) -> bool:
    if _ASCII_LETTER.search(raw):
        return True
    return not raw.isascii() and any(c.isalpha() for c in raw.decode("utf-8", "ignore"))


def train_language_model(
    docs: DataFrame,
    folds: int = 4,
    held_out: int = 2,
    sample_docs: int = 300,
    sample_parts: int = 10,
    most_languages: int = 10_000,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    **options,
) -> LanguageModel | None:
    """Learn from about ``sample_docs`` documents a language, ``sample_parts`` stretches of each, spread over the whole text.

    Rows whose CRC-32 of the id, as text, leaves ``held_out`` modulo ``folds``,
    and rows without a language, an id or a text, are never learned from. None
    if no row is left; over ``most_languages`` are an error.
    """
    rows = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{lang}`"].alias("lang"), docs[f"`{text}`"].cast("binary").alias("text"))
    usable = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (id_crc("doc_id") % folds != held_out))
    counts = dict(usable.groupBy("lang").count().collect())
    if not counts:
        return None
    if len(counts) > most_languages:
        raise ValueError(f"{len(counts)} languages; the network has an output for each")
    draw = F.pmod(F.xxhash64(F.lit(10), "doc_id"), F.lit(1 << 20))
    limits = docs.sparkSession.createDataFrame([(name, min(1 << 20, sample_docs * (1 << 20) // n)) for name, n in sorted(counts.items())], "lang string, most long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"lang": [], "parts": []}
            for name, raw in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                at = np.unique(np.linspace(0, max(0, len(raw or b"") - STRETCH), sample_parts).astype(int)).tolist()
                out["lang"].append(name)
                out["parts"].append([(raw or b"")[i : i + STRETCH] for i in at])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("lang", pa.string()), ("parts", pa.list_(pa.binary()))]))

    drawn = usable.join(F.broadcast(limits), "lang").where(draw < F.col("most")).select("lang", "text").mapInArrow(cut, "lang string, parts array<binary>").collect()
    languages = sorted(counts)
    number = {name: i for i, name in enumerate(languages)}
    model = LanguageModel(languages)
    model.train(sorted((bytes(part), number[r["lang"]]) for r in drawn for part in r["parts"]), **options)
    return model


def identify_languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", folds: int = 4, held_out: int = 2, **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, from its whole text alone.

    ``score`` is the pooled probability of the predicted language. Texts that
    are null or have no letter are ``und`` with score 0, and so is every text if
    there was nothing to learn from; ties go to the language first in order;
    rows without an id are judged like any other and not held out.
    """
    model = train_language_model(docs, folds, held_out, text=text, lang=lang, doc_id=doc_id, **options)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            raws = [raw or b"" for raw in texts(batch)]
            p = model.pooled(raws) if model else None
            best = [int(p[i].argmax()) if model and has_letter(raw) else -1 for i, raw in enumerate(raws)]
            names = [model.languages[k] if k >= 0 else "und" for k in best]
            scores = [float(p[i, k]) if k >= 0 else 0.0 for i, k in enumerate(best)]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    judged = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), predict.asNondeterministic()(docs[f"`{text}`"].cast("binary")).alias("found"))
    return judged.select(
        "doc_id",
        F.coalesce(id_crc("doc_id") % folds == held_out, F.lit(False)).alias("held_out"),
        "found.lang_pred",
        "found.score",
    )
