"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import xxhash


def lower(raw: bytes) -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in raw)


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def simhash(text: str | None, shingle: int = 4) -> int:
    w = re.findall(rb"[^\x20\x09-\x0D]+", lower((text or "").encode()))
    if not w:
        return 0
    parts = [w[i : i + shingle] for i in range(len(w) - shingle + 1)] or [w]
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs: list[tuple[int | None, str | None]], bits: int = 4) -> list[tuple]:
    """Rows ``(doc_id, fingerprint, component_id)`` by comparing all pairs."""
    prints = [(d, simhash(t)) for d, t in docs]
    distinct = sorted({f for _, f in prints})
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    first: dict = {}
    for d, f in prints:
        if d is not None:
            first[root(f)] = min(d, first.get(root(f), d))
    return [(d, f"{f:016x}", first.get(root(f))) for d, f in prints]


def cut_repeats(docs: list[tuple[int, str | None]], window: int = 50) -> list[tuple]:
    """Rows ``(doc_id, n_words, n_removed, kept_sha256)``."""
    smallest: dict = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            smallest[key] = min(d, smallest.get(key, d))
    out = []
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if smallest[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def contamination(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """Rows ``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``."""
    pattern = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lists: dict = defaultdict(set)
    for i, t in items:
        w = re.findall(pattern, lower((t or "").encode()))
        n = min(window, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            lists[tuple(w[at : at + n])].add(str(i))
    sizes = {len(k) for k in lists}
    out = []
    for d, t in docs:
        w = re.findall(pattern, lower((t or "").encode()))
        hit, found = [False] * len(w), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (key := tuple(w[at : at + n])) in lists:
                    found |= lists[key]
                    hit[at : at + n] = [True] * n
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), sum(hit), len(found), digest, any(hit)))
    return out


def media(doc_id, text: str | None, unit: int = 576) -> tuple:
    """``(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32)``."""
    raw = (text or "").encode()
    payload = raw + b"\xff" * (-len(raw) % unit if raw else unit)
    return doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])


def media_file(text: str | None, unit: int = 576) -> bytes:
    """A PGM, or a BMP for an even number of units, of the padded text, 24 bytes to a line."""
    raw = (text or "").encode()
    payload = raw + b"\xff" * (-len(raw) % unit if raw else unit)
    lines = [payload[i : i + 24] for i in range(0, len(payload), 24)]
    if len(payload) // unit % 2:
        return b"P5\n24 %d\n255\n" % len(lines) + payload
    palette = b"".join(bytes([i, i, i, 0]) for i in range(256))
    head = b"BM" + (1078 + len(payload)).to_bytes(4, "little") + bytes(4) + (1078).to_bytes(4, "little")
    info = b"".join(n.to_bytes(k, "little") for n, k in [(40, 4), (24, 4), (len(lines), 4), (1, 2), (8, 2), (0, 4), (len(payload), 4), (2835, 4), (2835, 4), (256, 4), (0, 4)])
    return head + info + palette + b"".join(reversed(lines))


def mean_grid(text: str | None, rows: int, columns: int, unit: int = 576) -> list[list[Fraction]]:
    """The padded text, 24 bytes to a line, as means over equal areas."""
    raw = (text or "").encode()
    payload = raw + b"\xff" * (-len(raw) % unit if raw else unit)
    lines = [payload[i : i + 24] for i in range(0, len(payload), 24)]

    def parts(n: int, k: int) -> list[list[tuple[int, Fraction]]]:
        """For each of ``k`` cells, the lines that it covers and how much of each."""
        step = Fraction(n, k)
        return [[(j, min((i + 1) * step, j + 1) - max(i * step, j)) for j in range(n) if j + 1 > i * step and j < (i + 1) * step] for i in range(k)]

    across = parts(24, columns)
    return [
        [sum(lines[y][x] * a * b for y, a in down for x, b in right) / (Fraction(len(lines), rows) * Fraction(24, columns)) for right in across]
        for down in parts(len(lines), rows)
    ]


def url_verdict(url: str | None, rules: list[tuple[str, str, str]]) -> tuple:
    """``(host, path, rule, verdict)``."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def jaccard_groups(texts: list[str | None], shingle: int = 5, similarity: float = 0.8) -> list[int]:
    """The first index of each text's component over pairs whose sets of shingles have the similarity."""
    sets = []
    for t in texts:
        words = (t or "").encode().lower().split()
        sets.append({tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} - {()})
    first = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if first[i] != first[j] and (a == b or 10 * len(a & b) >= round(10 * similarity) * len(a | b) > 0):
                lo, hi = sorted((first[i], first[j]))
                first = [lo if f == hi else f for f in first]
    return first


def line_key(line: bytes) -> bytes:
    return lower(re.sub(rb"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", b"", line))


def cut_lines(docs: list[tuple], min_chars: int = 10, min_docs: int = 2) -> list[tuple]:
    """Rows ``(doc_id, n_lines, n_dropped, kept_sha256)``."""
    held: dict = defaultdict(list)
    split = [(d, (t or "").encode().split(b"\n")) for d, t in docs]
    for d, lines in split:
        for key in {line_key(x) for x in lines}:
            if d is not None and len(key.decode()) >= min_chars:
                held[key].append(d)
    gone = {k: min(v) for k, v in held.items() if len(v) >= min_docs and min(v) < max(v)}
    out = []
    for d, lines in split:
        kept = [x for x in lines if d is None or gone.get(line_key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return out


def vector_codes(rows: list[tuple], parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[list[tuple], str]:
    """Rows ``(vec_id, code, error, label_error)`` and the digest of the codebooks, in Python's whole numbers."""
    kept = [(v, [math.floor(4096 * x) for x in e], lab) for v, e, lab in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted((v, w) for v, w, _ in kept if v is not None)[:entries]
    cut = lambda w, p: w[p * len(w) // parts : (p + 1) * len(w) // parts]
    books = [[cut(w, p) for _, w in first] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, w, _ in kept:
                groups[nearest(cut(w, p), books[p])[1]].append(cut(w, p))
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i], strict=True)] if i in groups else e for i, e in enumerate(books[p])]
    found = []
    for v, w, lab in kept:
        best = [nearest(cut(w, p), books[p]) for p in range(parts)]
        found.append((v, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), lab))
    totals = defaultdict(int)
    for *_, error, lab in found:
        totals[lab] += error
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [(v, c, e, totals[lab]) for v, c, e, lab in found], hashlib.sha256(text.encode()).hexdigest()


def hexdigest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(row: tuple) -> str:
    return hexdigest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(digests: list[str], fanout: int) -> list[list[str]]:
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([hexdigest(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def merkle(docs: list[tuple], fanout: int = 16) -> list[tuple]:
    """Rows ``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of ``(doc_id, source, lang, n_chars, text)``."""
    trees = defaultdict(list)
    for row in docs:
        trees[row[1]].append((row[0] is not None, row[0] or 0, leaf_digest(row), row))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    grown = [levels_of([x[2] for x in sorted(trees[n], key=lambda x: x[:3])], fanout) for n in names]
    top = levels_of([g[-1][0] for g in grown], fanout)
    out = []
    for nth, name in enumerate(names):
        for i, (*_, leaf, row) in enumerate(sorted(trees[name], key=lambda x: x[:3])):
            altered = row[:4] + (None if row[4] is None else lower(row[4].encode()).decode(),)
            folded = leaf_digest(altered) if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 else leaf
            proof = ""
            for levels, at in ((grown[nth], i), (top, nth)):
                for level in levels[:-1]:
                    run = level[at // fanout * fanout : (at // fanout + 1) * fanout]
                    left, right = "".join(run[: at % fanout]), "".join(run[at % fanout + 1 :])
                    proof, folded, at = proof + left + right, hexdigest(left, folded, right), at // fanout
            out.append((row[0], leaf, grown[nth][-1][0], top[-1][0], hexdigest(proof), folded, folded == top[-1][0]))
    return out
