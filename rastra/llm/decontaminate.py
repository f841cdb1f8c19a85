"""Benchmark decontamination with suffix arrays of the training text."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.llm.common import texts
from rastra.storage import scratch

#: Bytes outside words become spaces, A-Z lower-cased: digits, letters and all bytes from 0x80 make words.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def fold_words(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_FOLD).split()


class TestSuffixes:
    """The suffixes of a block of benchmark items that begin with a whole window, as arrays.

    The block's words are numbered from 1; a training word outside this
    vocabulary is 0 and matches nothing. ``flat`` has the items' words, a 0
    behind each item, ``starts`` where they begin, and ``order`` the places of
    the suffixes in the order of their words, so that those of one window are a
    run; the runs begin at ``first``.
    """

    __test__ = False

    def __init__(self, window: int, names: list[str], words: list[bytes], flat: np.ndarray, starts: np.ndarray, order: np.ndarray):
        self.window, self.names, self.words, self.flat, self.starts, self.order = window, names, words, flat, starts, order
        self.vocab = {w: n for n, w in enumerate(words, 1)}
        self.ends = np.append(starts[1:], len(flat)) - 1
        lengths = self.ends - starts
        self.shortest = int(min([window, *lengths[lengths > 0].tolist()]))
        kind = f"S{4 * window}"
        sizes = np.minimum(window, lengths[self.item_of(order)]) if len(order) else np.zeros(0, np.int64)
        padded = np.concatenate([flat, np.zeros(window, np.uint32)])
        keys = np.lib.stride_tricks.sliding_window_view(padded, window)[order].astype(">u4")
        short = sizes < window
        keys[short] *= (np.arange(window) < sizes[short, None]).astype(">u4")
        keys = keys.view(kind).ravel()
        self.first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.low, self.sizes = keys[self.first], sizes[self.first]
        #: the last key that begins with a window shorter than the others; longer ones are such keys themselves
        self.short = np.flatnonzero(self.sizes < window)
        self.last = np.array([k[: 4 * n].ljust(4 * n, b"\0").ljust(4 * window, b"\xff") for k, n in zip(self.low[self.short].tolist(), self.sizes[self.short].tolist(), strict=True)], dtype=kind)

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int) -> TestSuffixes:
        vocab: dict[bytes, int] = {}
        words = [np.array([vocab.setdefault(w, len(vocab) + 1) for w in fold_words(t)], dtype=np.uint32) for _, t in items]
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.concatenate([np.zeros(0, np.uint32), *[np.append(w, np.uint32(0)) for w in words]])
        starts = np.cumsum(lengths + 1) - lengths - 1
        counts = np.where(lengths, lengths - np.minimum(window, lengths) + 1, 0)
        at = np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
        order = at[np.argsort(cls._ranks(flat)[at], kind="stable")]
        return cls(window, [i for i, _ in items], list(vocab), flat, starts, order)

    def dump(self) -> bytes:
        """The block as one file of arrays."""
        lists = {}
        for name, values in (("names", [n.encode() for n in self.names]), ("words", self.words)):
            lists[name] = np.frombuffer(b"".join(values), np.uint8)
            lists[f"{name}_sizes"] = np.array([len(v) for v in values], dtype=np.uint32)
        out = io.BytesIO()
        np.savez(out, window=self.window, flat=self.flat, starts=self.starts.astype(np.uint32), order=self.order.astype(np.uint32), **lists)
        return out.getvalue()

    @classmethod
    def parse(cls, raw: bytes) -> TestSuffixes:
        held = np.load(io.BytesIO(raw), allow_pickle=False)

        def listed(name: str) -> list[bytes]:
            body, ends = held[name].tobytes(), np.cumsum(held[f"{name}_sizes"], dtype=np.int64).tolist()
            return [body[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []

        names = [n.decode() for n in listed("names")]
        return cls(int(held["window"]), names, listed("words"), held["flat"], held["starts"].astype(np.int64), held["order"].astype(np.int64))

    @staticmethod
    def _ranks(flat: np.ndarray) -> np.ndarray:
        """The place of each suffix among all of the block, by prefix doubling."""
        if not len(flat):
            return np.zeros(0, np.int64)
        rank, step = np.unique(flat, return_inverse=True)[1].astype(np.int64), 1
        while step < len(flat) and rank.max() < len(flat) - 1:
            after = np.concatenate([rank[step:] + 1, np.zeros(min(step, len(flat)), np.int64)])
            rank, step = np.unique(rank * (len(flat) + 2) + after, return_inverse=True)[1], step * 2
        return rank

    def item_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def run(self, k: int) -> np.ndarray:
        """Places of the suffixes that begin with window ``k``, in their order."""
        return self.order[self.first[k] : self.first[k + 1] if k + 1 < len(self.first) else None]

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        """How many words two runs have in common from their beginning."""
        n, at, step = min(len(a), len(b)), 0, 16
        while at < n:
            differ = np.flatnonzero(a[at : min(n, at + step)] != b[at : min(n, at + step)])
            if len(differ):
                return at + int(differ[0])
            at, step = at + step, step * 4
        return n

    def longest(self, text: np.ndarray, k: int) -> tuple[int, int, int]:
        """Item, position in it and length of the longest match of a text that begins with window ``k``, by binary search among its suffixes."""
        suffixes = self.run(k)
        lo, hi, best = 0, len(suffixes), (0, 0, 0)
        while lo < hi:
            mid = (lo + hi) // 2
            at = int(suffixes[mid])
            i = int(self.item_of(at))
            own = self.flat[at : self.ends[i]]
            n = self._common(text, own)
            if n > best[2]:
                best = (i, at - int(self.starts[i]), n)
            if n == len(text):
                break
            if n == len(own) or own[n] < text[n]:
                lo = mid + 1
            else:
                hi = mid
        return best

    def suffix_array(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of a shard in the order of the words that follow, and those words as keys.

        Only positions from which a shortest window's words are all in the
        vocabulary and in one document can match, so only they are sorted; keys
        hold a window's words, and longer matches are extended from there.
        """
        n = len(ids)
        stops = np.union1d(np.flatnonzero(ids == 0), np.append(starts, n))
        at = np.flatnonzero(ids)
        run = stops[np.searchsorted(stops, at, side="right")] - at
        at, run = at[run >= self.shortest], run[run >= self.shortest]
        padded = np.concatenate([ids, np.zeros(self.window, np.uint32)])
        keys = np.lib.stride_tricks.sliding_window_view(padded, self.window)[at] * (np.arange(self.window) < run[:, None])
        keys = np.ascontiguousarray(keys.astype(">u4")).view(f"S{4 * self.window}").ravel()
        order = np.argsort(keys, kind="stable")
        return at[order], keys[order]

    def search(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[set[int]], list[tuple[int, int, int, int, int]]]:
        """Which words of a shard are hit, the items of each document, and the longest matches.

        ``ids`` are the numbered words of the shard's documents, which begin at
        ``starts``. A match is ``(document, position in it, item, position in
        it, words)``: from left to right the longest one at each place where a
        window begins that the match before doesn't hold.
        """
        n, edge = len(ids), np.zeros(len(ids) + 1, dtype=np.int64)
        found: list[set[int]] = [set() for _ in starts]
        matches: list[tuple[int, int, int, int, int]] = []
        where, keys = self.suffix_array(ids, starts)
        if not len(where):
            return edge[:n] > 0, found, matches
        lo, hi = np.searchsorted(keys, self.low, side="left"), np.searchsorted(keys, self.low, side="right")
        hi[self.short] = np.searchsorted(keys, self.last, side="right")
        places, windows = [], []
        for k in np.flatnonzero(hi > lo).tolist():
            at = where[lo[k] : hi[k]]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + self.sizes[k], -1)
            items = np.unique(self.item_of(self.run(k))).tolist()
            for d in np.unique(np.searchsorted(starts, at, side="right") - 1).tolist():
                found[d].update(items)
            places.append(at)
            windows.append(np.full(len(at), k))
        if not places:
            return edge[:n] > 0, found, matches
        at, which = np.concatenate(places), np.concatenate(windows)
        order = np.argsort(at, kind="stable")
        at, which = at[order], which[order]
        ends = np.append(starts[1:], n)
        here = 0
        while here < len(at):
            p = int(at[here])
            d = int(np.searchsorted(starts, p, side="right")) - 1
            last = int(np.searchsorted(at, p, side="right"))
            text = ids[p : ends[d]]
            i, off, words = max((self.longest(text, k) for k in which[here:last].tolist()), key=lambda m: m[2])
            matches.append((d, p - int(starts[d]), i, off, words))
            # windows that end within the match are part of it
            here = max(last, int(np.searchsorted(at, p + max(words - self.window, 0), side="right")))
        return np.cumsum(edge[:n]) > 0, found, matches


_FOUND = "struct<n_words: bigint, n_hit: bigint, items: array<string>, matches: array<struct<item_id: string, item_at: bigint, doc_at: bigint, words: bigint>>>"
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("item_at", pa.int64()), ("doc_at", pa.int64()), ("words", pa.int64())]))),
    ]
)


def _search_udf(paths: list[str], shard_words: int):
    """A column function; a shard is a run of documents. Where there are several blocks of items, ``SHARDS_A_LOAD`` shards are held to be searched for each."""

    def flush(tests: TestSuffixes, texts_: list[list[bytes]], out: list[dict]) -> None:
        get = tests.vocab.get
        words = [np.fromiter((get(x, 0) for x in w), dtype=np.uint32, count=len(w)) for w in texts_]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        full = sizes > 0  # an empty document would share its start with the next one
        mask, items, matches = tests.search(np.concatenate(words), starts[full])
        for d, x in zip(np.flatnonzero(full).tolist(), items, strict=True):
            if x:
                out[d]["items"] += [tests.names[i] for i in x]
                out[d]["hits"].append(np.flatnonzero(mask[starts[d] : starts[d] + sizes[d]]))
        numbers = np.flatnonzero(full).tolist()
        for d, at, i, off, m in matches:
            out[numbers[d]]["matches"].append({"item_id": tests.names[i], "item_at": off, "doc_at": at, "words": m})

    def look(held: list[list[bytes]]) -> list[dict]:
        """What is found in each text; a block is searched for all shards of them before the next one is loaded."""
        out: list[dict] = [{"n_words": len(w), "n_hit": 0, "hits": [], "items": [], "matches": []} for w in held]
        ends = np.cumsum([len(w) + 1 for w in held]) // shard_words
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(held)]
        for path in paths:
            tests = load_suffixes(path)
            for i, j in zip(cuts, cuts[1:]):
                found = out[i:j]
                flush(tests, held[i:j], found)
        for x in out:
            hits = x.pop("hits")
            x["n_hit"] = len(np.unique(np.concatenate(hits))) if hits else 0
        return out

    @F.arrow_udf(_FOUND)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        most = shard_words * (1 if len(paths) < 2 else SHARDS_A_LOAD)
        waiting: list[int] = []  # rows of the batches that are not answered yet
        held: list[list[bytes]] = []
        out: list[dict] = []
        n = 0
        for batch in batches:
            for raw in texts(batch):
                held.append(fold_words(raw))
                n += len(held[-1]) + 1
                if n >= most:
                    out += look(held)
                    held, n = [], 0
            waiting.append(len(batch))
            while waiting and len(out) >= waiting[0]:
                yield pa.array(out[: waiting[0]], type=_ARROW)
                out = out[waiting.pop(0) :]
        out += look(held) if held else []
        for rows in waiting:
            yield pa.array(out[:rows], type=_ARROW)
            out = out[rows:]

    return search.asNondeterministic()


#: So many shards wait for a block of items to be loaded, if there are several blocks.
SHARDS_A_LOAD = 8
#: The index of this Python worker, and the block that it is of.
_LOADED: dict[str, TestSuffixes] = {}


def load_suffixes(path: str) -> TestSuffixes:
    """The index of a block of items in the shared folder; a worker keeps the last one."""
    if path not in _LOADED:
        fs, name = pafs.FileSystem.from_uri(path)
        _LOADED.clear()
        with fs.open_input_file(name) as f:
            _LOADED[path] = TestSuffixes.parse(f.read())
    return _LOADED[path]


def write_blocks(items: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> list[str]:
    """Indexes of blocks of items as files in the shared folder, each built in a task.

    Items go to blocks by hash, so that blocks hold about ``block_bytes`` (an
    item is never cut); rows alike are one. Every attempt of a task writes a file of its own, and
    only those of the tasks that ended are named: one path a block.
    """
    named = items.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text")).distinct()
    total = named.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    if not total:
        return []
    count, folder = -(-int(total) // block_bytes), scratch(items.sparkSession, "items")
    block = F.pmod(F.xxhash64("id", "text"), F.lit(count))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, name = pafs.FileSystem.from_uri(folder)
        fs.create_dir(name, recursive=True)
        part = uuid.uuid4().hex
        rows = sorted((i, bytes(raw)) for i, raw in zip(pdf["id"], pdf["text"], strict=True))
        with fs.open_output_stream(f"{name}/{part}") as f:
            f.write(TestSuffixes.of(rows, window).dump())
        return pd.DataFrame({"path": [f"{folder}/{part}"]})

    made = named.withColumn("block", block).groupBy("block").applyInPandas(build, "path string")
    return sorted(r["path"] for r in made.collect())


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = 8 << 20,
    shard_words: int = 250_000,
) -> DataFrame:
    """Words of each document that lie in a window of a benchmark item.

    A window is ``window`` consecutive words of an item, or a whole shorter
    item. The training text is searched in shards of about ``shard_words``
    words: a shard has a suffix array, and every test suffix is looked up in it
    by binary search. The benchmark lies in the shared folder in blocks of
    about ``block_bytes``; a task searches several shards for one block after the other. Adds
    ``n_words, n_hit, n_items, item_ids`` (distinct, sorted as text) and
    ``matches`` (from left to right the longest verbatim match at each place
    where a window begins that the one before doesn't hold, with its location in
    an item) to ``docs``; columns of those names give way. Null and empty texts
    have no words; null and empty items have no window; items of a null id match
    under an empty one; without items nothing is hit; repeated rows are kept.
    """
    own = ["n_words", "n_hit", "n_items", "item_ids", "matches"]
    paths = write_blocks(items, item_id, item_text, window, block_bytes)
    search = _search_udf(paths, shard_words)(docs[f"`{text}`"].cast("binary"))
    found = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), search.alias("found"))
    return (
        found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own], "found.n_words", "found.n_hit", "found.matches", "found.items")
        .withColumn("item_ids", F.array_sort(F.array_distinct("items")))
        .drop("items")
        .withColumn("n_items", F.size("item_ids").cast("long"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents of which no word lies in a benchmark window, with their columns.

    Documents without words stay, and so do repeated rows and rows without an
    id; columns keep their names, whatever these are, and their order.
    """
    own = ["n_words", "n_hit", "n_items", "item_ids", "matches"]
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{options.get('text', 'text')}`"].alias("text"))
    clean = find_contamination(packed, items, **{**options, "text": "text"}).where("n_hit = 0").drop(*own)
    return clean.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
