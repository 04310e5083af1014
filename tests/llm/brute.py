"""Plain versions of the operators for small tables."""

import hashlib
import re
import zlib

import numpy as np


def repeats(docs, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} of (doc_id, text) rows."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda r: r[0]):
        data = (text or "").encode()
        cover = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                cover[s : s + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, c in zip(data, cover) if not c)
        out[doc_id] = (len(data), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest())
    return out


def fingerprint(text):
    import xxhash

    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def clusters(fps, radius=2):
    """{id: smallest id reachable} over links of at most ``radius`` bits."""
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_groups(texts, least=0.8, width=5):
    """{row number: smallest row number reachable} over pairs of texts at a 5-word Jaccard similarity of ``least``."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for b, own in enumerate(sets):
        for a in range(b):
            if own == sets[a] or len(own & sets[a]) >= least * len(own | sets[a]) - 1e-9 > 0:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def personal(text):
    """Base spans as ``kind:start:end`` texts."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def pieces(docs, tokenizer, capacity=4096):
    out = {}
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), capacity):
            part = np.array(ids[at : at + capacity], "<u4")
            out[doc_id, at // capacity] = (at, len(part), zlib.crc32(part.tobytes()))
    return out
