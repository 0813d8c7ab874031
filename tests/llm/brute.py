"""Plain, slow versions of the operators, each over a list of (id, text)."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

SPACE = " \t\n\x0b\f\r"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def components(items, linked):
    """Smallest index reached, for each index."""
    root = list(range(len(items)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(items)), 2):
        if linked(items[i], items[j]):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return [top(i) for i in range(len(items))]


def simhash(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(docs, size=3, radius=2):
    prints = [simhash(t, size) for _, t in docs]
    top = components(prints, lambda a, b: (a ^ b).bit_count() <= radius)
    members = defaultdict(list)
    for (doc_id, _), root in zip(docs, top):
        members[root].append(doc_id)
    first = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return [(d, f"{p:016x}", first[r]) for (d, _), p, r in zip(docs, prints, top)]


def edit_distance_inside(item, text):
    """Least edits that turn the item into some substring of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def exact_groups(docs):
    """(id, keep, size, sha) per row."""
    plain = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in docs]
    groups = defaultdict(list)
    for (doc_id, text), p in zip(docs, plain):
        groups[p].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return [(d, min(groups[p])[3], len(groups[p]), sha(p)) for (d, _), p in zip(docs, plain)]


def dedup_lines(docs, min_chars=20, min_docs=3):
    """(id, lines, dropped, kept text) per row."""

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(SPACE)

    low = float("-inf")
    held = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            held[key(line)].add(low if doc_id is None else doc_id)
    out = []
    for doc_id, text in docs:
        found = (text or "").split("\n")
        me = low if doc_id is None else doc_id
        kept = [
            x for x in found
            if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or max(held[key(x)]) == me
        ]
        out.append((doc_id, len(found), len(found) - len(kept), "\n".join(kept)))
    return out


def remove_repeats(docs, width):
    """(id, bytes, removed, spans, kept) per row."""
    datas = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i : i + width] for d in datas for i in range(len(d) - width + 1))
    out = []
    for (doc_id, _), data in zip(docs, datas):
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if seen[data[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return out
