"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastra.llm.common import id_crc, pieces, slices, texts

_WORD = re.compile(rb"[a-z\x80-\xff]+")
#: Ends every window and both dictionaries, so that each window compresses and no length is that of a stored block.
_TAIL = b"\n0123456789=0123456789+abcdefgh\n"
#: Letters of one word; longer runs are several words.
_LETTERS = re.compile(rb"[a-z\x80-\xff]{1,64}")
#: The last of a trained dictionary's header, three offsets; its content comes after them.
_OFFSETS = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"


def windows(raw: bytes, size: int) -> Iterator[bytes]:
    """A text, A-Z lower-cased, in windows of whole words of at least ``size`` bytes; the last may be shorter."""
    for piece in pieces(raw):
        held, n = [], 0
        for w in piece.lower().split():
            held.append(w)
            n += len(w) + 1
            if n >= size:
                yield b" %b " % b" ".join(held)
                held, n = [], 0
        if held:
            yield b" %b " % b" ".join(held)


def excerpt(raw: bytes, most: int, part: int = 1024) -> bytes:
    """A text of up to ``most`` bytes whole, or else as many evenly spaced parts of it."""
    if len(raw) <= most:
        return raw
    starts = np.linspace(0, len(raw) - part, most // part).astype(int).tolist()
    return b" ".join(raw[s : s + part] for s in starts)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
        window_log=17,
        chain_log=14,
        hash_log=14,
        search_log=3,
        min_match=5,
        target_length=16,
        strategy=zstandard.STRATEGY_GREEDY,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params)


def _trained(docs: list[list[bytes]], size: int) -> bytes:
    """A dictionary from zstandard's trainer, over the words of each document as one sample."""
    samples = [b"".join(words) for words in docs if words]
    try:
        return zstandard.train_dictionary(size, samples, d=8, k=8).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform samples for the trainer
        return b"".join(samples)[-size:]


def _commonest(docs: list[list[bytes]], size: int) -> bytes:
    """The most frequent words, the commonest nearest to the end."""
    counts = Counter(w for words in docs for w in words)
    kept, room = [], size
    for w in sorted(counts, key=lambda w: (-counts[w], w)):
        if len(w) > room:
            break
        kept.append(w)
        room -= len(w)
    return b"".join(reversed(kept))


def _thorough(content: bytes, min_match: int) -> zstandard.ZstdCompressor:
    """A compressor whose tables have room for a whole vocabulary."""
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
        window_log=19,
        chain_log=17,
        hash_log=17,
        search_log=5,
        min_match=min_match,
        target_length=32,
        strategy=zstandard.STRATEGY_LAZY2,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params)


class _Lengths(dict):
    """Compressed lengths of words by a dictionary, each found once."""

    def __init__(self, content: bytes, thorough: bool = False):
        content += _TAIL
        self.press = (_thorough(content, 4) if thorough else _compressor(content)).compress

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.press(word + _TAIL))
        return n


def train_dictionaries(
    toxic: list[list[bytes]],
    ordinary: list[list[bytes]],
    background_bytes: int = 8192,
    draft_bytes: int = 4096,
    dict_bytes: int = 768,
    common_bytes: int = 256,
    known: float = 0.5,
    gain: int = 1,
    rounds: int = 3,
) -> tuple[bytes, bytes]:
    """A dictionary trained on toxic text and one trained on ordinary text, before the same background.

    Both classes go through the same steps. The background is the common
    vocabulary of one half of the ordinary documents; words of which it saves
    over the share ``known`` are taken out of the samples of both classes, as
    neither is told by them. The other half of the ordinary documents, thinned
    to the number of toxic ones, and the toxic documents are then trained on
    apart. In each round dictionaries of ``draft_bytes`` are trained on either
    half of a class, and of the other half's samples only words are kept that
    the own class's draft compresses at least ``gain`` bytes better than the
    other class's, so that what a draft merely remembers doesn't count. The
    dictionary of a class is trained on what is left, ``dict_bytes``, and has
    its commonest words, ``common_bytes``, behind that.
    """
    background = _commonest(ordinary[::2], background_bytes)
    with_it, without = _Lengths(background), _Lengths(b"")
    rest = ordinary[1::2]
    rest = rest[:: max(1, len(rest) // max(1, len(toxic)))]
    classes = [[[w for w in d if without[w] - with_it[w] <= known * len(w)] for d in docs] for docs in (rest, toxic)]
    for _ in range(rounds):
        drafts = [[_Lengths(_trained(docs[h::2], draft_bytes) + background) for h in (0, 1)] for docs in classes]
        classes = [
            [[w for w in d if drafts[1 - c][1 - h][w] - drafts[c][1 - h][w] >= gain] for h in (0, 1) for d in classes[c][h::2]] for c in (0, 1)
        ]
    plain, marked = (_trained(docs, dict_bytes) + _commonest(docs, common_bytes) + background + _TAIL for docs in classes)
    return marked, plain


def _short_trained(docs: list[list[bytes]], size: int) -> bytes:
    """The content of a dictionary from zstandard's trainer that counts strings of six bytes, as stems may be that short."""
    samples = [b"".join(words) for words in docs if words]
    if not samples:
        return b""
    try:
        trained = zstandard.train_dictionary(size, samples, d=6, k=8).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform samples for the trainer
        return b"".join(samples)[-size:]
    return trained.partition(_OFFSETS)[2] or trained


def train_stems(
    toxic: list[list[bytes]],
    ordinary: list[list[bytes]],
    vocabulary_bytes: int = 400_000,
    draft_bytes: int = 16384,
    stem_bytes: int = 512,
    gain: int = 2,
    rounds: int = 2,
) -> bytes:
    """A dictionary trained on what of toxic words all ordinary vocabulary can't compress.

    The vocabulary of all ordinary documents, commonest words first, is one
    dictionary. In each round a draft is trained on either half of the toxic
    documents, and of the other half only words are kept that the draft
    compresses at least ``gain`` bytes better than the vocabulary, so that what
    a draft merely remembers doesn't count. Each document lends a word once.
    A stem is found under any ending, as the words left share nothing else.
    """
    toxic = [list(dict.fromkeys(words)) for words in toxic]
    known = _Lengths(_commonest([list(dict.fromkeys(words)) for words in ordinary], vocabulary_bytes), thorough=True)
    kept = toxic
    for _ in range(rounds):
        drafts = [_Lengths(_short_trained(kept[h::2], draft_bytes), thorough=True) for h in (0, 1)]
        kept = [[w for w in d if known[w] - drafts[1 - i % 2][w] >= gain] for i, d in enumerate(toxic)]
    return _short_trained(kept, stem_bytes)


def _words(raw: bytes) -> list[bytes]:
    return [b" %b " % w for w in _WORD.findall(raw.lower())]


class ToxicityModel:
    """Dictionaries and the calibration that turns compressed lengths into a score.

    Every window of a text is compressed with the dictionary of ordinary text
    and with that of toxic text, and every word with common vocabulary alone and
    with toxic stems behind it. How many windows and words the toxic one of
    either pair makes shorter by each of ``THRESHOLDS`` bytes, and by how much,
    is weighed by logistic regression. The dictionaries are trained on all but
    every ``folds``-th document, and the weights fitted to those left out, so
    that they belong to these dictionaries.
    """

    THRESHOLDS = (1, 2, 3, 4, 5, 6)
    #: So many words are remembered with what is saved on them, then forgotten.
    REMEMBERED = 1 << 17

    def __init__(self, toxic: list[bytes], ordinary: list[bytes], window: int = 20, folds: int = 3, **options):
        self.window = window
        known: dict[bytes, bytes] = {}  # each word once in memory
        classes = [[[known.setdefault(w, w) for w in _words(raw)] for raw in docs] for docs in (toxic, ordinary)]
        if not toxic or not ordinary:
            self._learn(*classes, **options)
            self.weights = np.zeros(len(self._measured(b"")))
            self.weights[0] = 20.0 if toxic else -20.0
            return
        self._learn(*[[d for i, d in enumerate(docs) if i % folds] for docs in classes], **options)
        apart = [(self._measured(raw), label) for docs, label in ((toxic, 1.0), (ordinary, 0.0)) for raw in docs[::folds]]
        self._calibrate(np.array([x for x, _ in apart]), np.array([label for _, label in apart]))

    def _set(self, toxic: bytes, ordinary: bytes, stems: bytes, common: bytes) -> None:
        self.toxic, self.ordinary, self.stems, self.common = toxic, ordinary, stems, common
        for made in ("_pair", "_saved"):
            self.__dict__.pop(made, None)

    def _learn(self, toxic: list[list[bytes]], ordinary: list[list[bytes]], **options) -> None:
        common = _commonest(ordinary, 8192)
        stems = common + train_stems(toxic, ordinary) + _TAIL
        self._set(*train_dictionaries(toxic, ordinary, **options), stems, common + _TAIL)

    def savings(self, raw: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves, against the ordinary one, on each window of a whole text."""
        if not hasattr(self, "_pair"):
            self._pair = _compressor(self.ordinary).compress, _compressor(self.toxic).compress
        plain, toxic = self._pair
        out = [len(plain(x := w + _TAIL)) - len(toxic(x)) for w in windows(raw, self.window)]
        return np.array(out or [0], dtype=np.int32)

    def word_savings(self, raw: bytes) -> np.ndarray:
        """Bytes that toxic stems save on each word of a whole text."""
        if not hasattr(self, "_saved"):
            self._saved = {}, _thorough(self.common, 5).compress, _thorough(self.stems, 5).compress
        saved, plain, stems = self._saved
        out = []
        for piece in pieces(raw):
            for w in _LETTERS.findall(piece.lower()):
                n = saved.get(w)
                if n is None:
                    if len(saved) >= self.REMEMBERED:
                        saved.clear()
                    x = b" %b %b" % (w, _TAIL)
                    n = saved[w] = len(plain(x)) - len(stems(x))
                out.append(n)
        return np.array(out or [0], dtype=np.int32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_pair", "_saved")}

    def _measured(self, raw: bytes) -> np.ndarray:
        return np.concatenate([self._features(self.savings(raw)), self._word_features(self.word_savings(raw))])

    def _features(self, savings: np.ndarray) -> np.ndarray:
        hits = savings[savings >= 2]
        counts = [math.log1p(int((savings >= t).sum())) for t in self.THRESHOLDS]
        shares = [hits.sum() / len(savings), 10 * len(hits) / len(savings), 10 * (savings >= 4).mean()]
        return np.array([1.0, *counts, math.log1p(hits.sum()), *shares, math.log(len(savings))])

    def _word_features(self, savings: np.ndarray) -> np.ndarray:
        found = [int((savings >= t).sum()) for t in self.THRESHOLDS[:4]]
        shares = [min(3.0, 100 * n / len(savings)) for n in found[:3]]
        return np.array([*(math.log1p(n) for n in found), *shares, math.log(len(savings))])

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        w = np.zeros(x.shape[1])
        for _ in range(40):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(len(w))
            w = w + np.linalg.solve(h, x.T @ (y - p) - 0.1 * w)
        self.weights = w

    def score(self, raw: bytes | None) -> float:
        x = float(self._measured(raw or b"") @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out: int = 0,
    sample_docs: int = 4000,
    sample_bytes: int = 16384,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
) -> ToxicityModel:
    """Learn from a bounded sample of the labelled documents.

    Rows whose CRC-32 of the id, as text, leaves ``held_out`` modulo ``folds``
    are never learned from. Of the rest about ``sample_docs`` are drawn by a
    hash of the id, and of each at most ``sample_bytes`` in parts spread over
    the whole text. Null labels and ids are left out; of rows that repeat an
    id's label the largest counts.
    """
    named = labels.select(labels[f"`{doc_id}`"].alias("label_id"), labels[f"`{label}`"].cast("int").alias("y"))
    usable = named.where(F.col("label_id").isNotNull() & F.col("y").isNotNull() & (id_crc("label_id") % folds != held_out))
    usable = usable.groupBy("label_id").agg(F.max("y").alias("y"))
    n = usable.count()
    part = min(1.0, sample_docs / max(n, 1))
    drawn = usable.where(F.pmod(F.xxhash64(F.lit(4), "label_id"), F.lit(1 << 20)) < int(part * (1 << 20)))
    source = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].cast("binary").alias("text"))
    # the drawn ids are about sample_docs at most, whatever the input
    rows = source.join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id")).select("doc_id", "y", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [excerpt(raw or b"", sample_bytes) for raw in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.binary())], names=["doc_id", "y", "text"])

    seen: dict[bytes, int] = {}
    id_type = source.schema["doc_id"].dataType.simpleString()
    for r in sorted(rows.mapInArrow(cut, f"doc_id {id_type}, y int, text binary").collect(), key=lambda r: (str(r["doc_id"]), bytes(r["text"]))):
        seen.setdefault(bytes(r["text"]), r["y"])  # copies would lend their words weight
    return ToxicityModel([t for t, y in seen.items() if y], [t for t, y in seen.items() if not y])


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score of each whole text, 0 to 1; null counts as empty."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            yield pa.array([model.score(raw) for raw in texts(batch)], pa.float64())

    return score.asNondeterministic()(text.cast("binary"))


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    ``predicted`` is 1 from a score of 0.5. Null and empty texts get the score
    of a text without hits; rows without an id are scored like any other and
    are not held out; without labels every score is near 0.
    """
    folds, fold = options.get("folds", 5), options.get("held_out", 0)
    model = train_toxicity(docs, labels, text=text, doc_id=doc_id, **options)
    scored = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), toxicity_score(model, docs[f"`{text}`"]).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(id_crc("doc_id") % folds == fold, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents whose score is below 0.5, with their columns."""
    model = train_toxicity(docs, labels, text=text, doc_id=doc_id, **options)
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), toxicity_score(model, docs[f"`{text}`"]).alias("score"))
    return packed.where("score < 0.5").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
