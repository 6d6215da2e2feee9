"""Plain versions of the operators' results, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import regex
import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def repeated_strings(rows, length):
    """rows: (id, text). Bytes left, number removed and runs, by quadratic-free but plain counting of windows."""
    data = [(text or "").encode() for _, text in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(rows, data):
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(b for b, g in zip(d, gone) if not g)
        out.append((doc_id, len(d), sum(gone), runs, sha(left)))
    return out


def statistics(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def base_failed(stats):
    return stats[0] < 50 or 100 * stats[4] > 50 * stats[0]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


def spans_text(spans):
    names = ("email", "ip", "card", "phone")
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)


def fingerprint(text, size):
    words = SPACE.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_classes(rows, size, most):
    """rows: (id, text)."""
    fps = [fingerprint(text, size) for _, text in rows]
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= most:
                root[find(a)] = find(b)
    first = defaultdict(list)
    for (doc_id, _), f in zip(rows, fps):
        if doc_id is not None:
            first[find(f)].append(doc_id)
    return [(doc_id, f"{f:016x}", min(first[find(f)], default=None)) for (doc_id, _), f in zip(rows, fps)]


def shingles(text, size):
    words = lower(text or "").encode().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def similar_classes(rows, size, similar):
    """rows: (id, text). The smallest id of each class of texts joined by their similarity, all pairs compared."""
    sets = [shingles(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= similar * len(a | b):
                root[find(i)] = find(j)
    first = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        first[find(i)].append(doc_id)
    return [(doc_id, min(first[find(i)])) for i, (doc_id, _) in enumerate(rows)]


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = BENCH_WORD.findall(lower(text or ""))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        words = BENCH_WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (own := windows.get(tuple(words[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= own
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def base_scores(rows):
    """rows: (id, text). The plain unigram scores, as the contract for scoring texts gives them."""
    tokens = {i: SPACE.findall(lower(text or "")) + [None] for i, text in rows}
    counts = Counter(t for i, ts in tokens.items() if crc(i) % 10 for t in ts)
    total, kinds = sum(counts.values()), len(counts)
    return {
        i: (
            crc(i) % 10 == 0, len(ts), sum(counts[t] > 0 for t in ts), total,
            sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in ts),
        )
        for i, ts in tokens.items()
    }


def unigram_count(word, scores):
    best = [(0, 0)]
    for stop in range(1, len(word) + 1):
        best.append(
            max((best[a][0] + scores[word[a:stop]], best[a][1] - 1) for a in range(stop) if word[a:stop] in scores)
        )
    return -best[-1][1]


def sentence_runs(bare, size, fewest, words):
    """All (start, stop) that are compared with other texts: by the rule as it is told, each length measured anew."""
    def long(a, b):
        return len("\n".join(bare[a:b])) >= fewest

    n = len(bare)
    found = set()
    if n < size:
        found.add((0, n))
    else:
        for a in range(n - size + 1):
            found |= {(a, b) for b in [next((b for b in range(a + size, n + 1) if long(a, b)), None)] if b}
        if not any(b == n for _, b in found):
            found.add((next((a for a in range(n - size, -1, -1) if long(a, n)), 0), n))
    return found | {(a, a + k) for k in (1, 2) for a in range(n - k + 1) if len(" ".join(bare[a : a + k]).split()) >= words}


def sentence_spans(rows, size, fewest, words, split):
    """rows: (id, text), ids different; ``split`` cuts a text into sentences of a script with spaces."""
    places, gone, out = defaultdict(list), defaultdict(set), []
    for row, (doc_id, text) in enumerate(rows):
        bare = [p.strip() for p in split(text)] if text else []
        if not bare:
            continue
        if len("\n".join(bare)) < fewest:
            places["whole", tuple(bare)].append((doc_id, 0, row, len(bare)))
        else:
            for a, b in sentence_runs(bare, size, fewest, words):
                places["run", tuple(bare[a:b])].append((doc_id, a, row, b - a))
    for found in places.values():
        _, first, own, _ = min(found)
        for _, a, row, n in found:
            if row != own or (a != first and n <= size):
                gone[row] |= set(range(a, a + n))
    for row, (doc_id, text) in enumerate(rows):
        parts = split(text) if text else []
        kept = "".join(p for i, p in enumerate(parts) if i not in gone[row]) if gone[row] else text or ""
        out.append((doc_id, len(parts), len(gone[row]), sha(kept)))
    return out


WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
