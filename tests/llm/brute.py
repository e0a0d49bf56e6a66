"""The operators' contracts in plain Python, over all pairs where need be."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contaminated(docs, items, window=10):
    """{row: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        n = min(window, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[p : p + n])].add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = item_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if names := windows.get(tuple(w[p : p + n])):
                    hit.update(range(p, p + n))
                    found |= names
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in docs:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        _, no_id, keep = min(groups[norm])
        keep = None if no_id else keep
        out.append((doc_id, keep, len(groups[norm]), doc_id == keep, sha(norm)))
    return out


def repeats(docs, length):
    raw = [(d, (t or "").encode()) for d, t in docs]
    count = Counter(r[i : i + length] for _, r in raw for i in range(len(r) - length + 1))
    out = []
    for doc_id, r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((doc_id, len(r), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept)))
    return out


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def near(docs, size, percent):
    """Rows, and the links between different sets."""
    sets = [shingles(t, size) for _, t in docs]
    ids = [d for d, _ in docs]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in where[x] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
    return [(d, len(s), ids[find(i)], ids[find(i)] == d) for i, (d, s) in enumerate(zip(ids, sets, strict=True))]


def crc_ids(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def license_sizes(text):
    w = re.findall("[a-z0-9]+", text.translate(LOWER))
    return {tuple(w)} if len(w) == 1 else set(zip(w, w[1:]))


def simhash(docs, size=3, distance=2):
    """Rows (id, fingerprint, component), comparing all pairs."""
    prints = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        n = min(size, len(w))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]), 42) for i in range(len(w) - n + 1)] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    ids = [d for d, _ in docs]
    root = {d: d for d in ids if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, x in enumerate(prints):
        for j in range(i):
            if ids[i] is not None and ids[j] is not None and (x ^ prints[j]).bit_count() <= distance:
                a, b = find(ids[i]), find(ids[j])
                root[max(a, b)] = min(a, b)
    return [(d, f"{x:016x}", None if d is None else find(d)) for d, x in zip(ids, prints, strict=True)]


def periodic(doc_id, text):
    """The words of the text, from some word on periodic for one id in ten."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def runs(w, least=12):
    """Every (start, length, period), by trying all periods at all places."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def op12(docs):
    out = []
    for doc_id, text in docs:
        w = periodic(doc_id, text)
        found = runs(w)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        out.append((doc_id, len(found), *best, milli, sha(lines), sha(collapsed(w, found))))
    return out


def aligned(text, byte_tokenizer, piece_processor):
    """Token ids of A and B and the groups of both, from encoding the whole text; None without tokens."""
    byte_of = {c: b for b, c in _byte_level().items()}
    raw = f" {text}".encode()
    a = byte_tokenizer.encode(f" {text}", add_special_tokens=False).ids if text else []
    b = piece_processor.encode(text) if text else []
    parts_a = [bytes(byte_of[c] for c in byte_tokenizer.id_to_token(i)) for i in a]
    pieces = [piece_processor.id_to_piece(i) for i in b]
    parts_b = [bytes([int(p[3:5], 16)]) if piece_processor.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in zip(b, pieces)]
    if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
        return None
    groups, x, y, at_a, at_b = [], [], [], 0, 0
    rest = list(zip(b, parts_b, strict=True))
    for i, part in zip(a, parts_a, strict=True):
        at_a += len(part)
        x.append(i)
        while rest and at_b + len(rest[0][1]) <= at_a:
            j, piece = rest.pop(0)
            at_b += len(piece)
            y.append(j)
        if at_a == at_b:
            groups.append((x, y))
            x, y = [], []
        elif rest and at_b < at_a:
            j, piece = rest.pop(0)
            at_b += len(piece)
            y.append(j)
    return a, b, groups


def _byte_level():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)) - set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def op13(docs, byte_tokenizer, piece_processor):
    made = [aligned(t, byte_tokenizer, piece_processor) for _, t in docs]
    links = [Counter((i, j) for x, y in m[2] for i in x for j in y) if m else Counter() for m in made]
    count = Counter(pair for found in links for pair in found)
    most = Counter()
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    out = []
    for (doc_id, _), m, found in zip(docs, made, links, strict=True):
        if not m:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in m[2])
        best = sum(n for pair, n in found.items() if count[pair] == most[pair[0]])
        sums = sum(n * count[pair] for pair, n in found.items())
        out.append((doc_id, len(m[0]), len(m[1]), len(m[2]), sum(found.values()), best, sums, sha(text)))
    return out
