"""Plain versions of the text operators, for small inputs."""

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def repeats(rows, length=100):
    """Removed byte flags of (id, text) rows; rows equal in both are one document."""
    seen, result = set(), {}
    for key in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        data = (key[1] or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        result[key] = gone
    return result


def repeats_row(text, gone):
    """n_bytes, n_removed, n_spans and the digest of what is left."""
    data = (text or "").encode()
    spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
    kept = bytes(b for b, g in zip(data, gone) if not g)
    return len(data), sum(gone), spans, sha256(kept).hexdigest()


def blank_words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = blank_words(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    lines = [line for line in (text or "").split("\n") if blank_words(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def fingerprint(text, size=3):
    words = blank_words((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(prints, radius):
    """Roots by union of all pairs within the radius; ``prints`` maps ids to integers."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def shingles(text, size=5):
    words = blank_words((text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def bench_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def contamination(text, items, size=10):
    """n_words, n_hit and sorted item ids; ``items`` is a list of (id, text)."""
    words = bench_words(text)
    hit, found = set(), set()
    for item, item_text in items:
        own = bench_words(item_text)
        width = min(size, len(own))
        wanted = {tuple(own[i : i + width]) for i in range(len(own) - width + 1)} if own else set()
        for at in range(len(words) - width + 1):
            if tuple(words[at : at + width]) in wanted:
                hit.update(range(at, at + width))
                found.add(None if item is None else str(item))
    return len(words), len(hit), sorted(found, key=lambda i: (i is None, i or ""))


def backoff(texts, order):
    """Log scores, each text's own n-grams left out of the counts."""
    words = [[w for w in blank_words((t or "").translate(LOWER))] for t in texts]
    grams = lambda ws, k: Counter(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    total = defaultdict(int)
    for ws in words:
        for k in range(1, order + 1):
            for g, n in grams(ws, k).items():
                total[g] += n
    everything = sum(map(len, words))
    scores = []
    for ws in words:
        own = Counter()
        for k in range(1, order + 1):
            own.update(grams(ws, k))
        score = 0.0
        for i in range(len(ws)):
            for k in range(min(order, i + 1), 0, -1):
                gram = tuple(ws[i - k + 1 : i + 1])
                seen = total[gram] - own[gram]
                if k == 1:
                    score += math.log(max(seen, 0.5) / everything)
                elif seen > 0:
                    history = gram[:-1]
                    score += math.log(seen / (total[history] - own[history]))
                    break
                else:
                    score += math.log(0.4)
        scores.append(score)
    return scores


def runs(words):
    """Start, length and smallest period of every run, by comparing at every distance."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            stop = at
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            part = words[at : stop + q]
            smallest = next(d for d in range(1, q + 1) if all(a == b for a, b in zip(part, part[d:])))
            if len(part) >= max(6, 4 * q) and smallest == q:
                found.append((at, len(part), q))
            at = stop
    return sorted(found)


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    """The contract's periodic tails."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def search_terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def search(docs, items, top=50):
    """(item, rank, doc_id, score) of (id, text) documents and a dict of item terms."""
    counted = [(i, Counter(search_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    holders = Counter(t for _, c in counted for t in c)
    found = []
    for item, terms in items.items():
        scores = []
        for number, tf in counted:
            m = 100 - 50 + (50 * sum(tf.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in terms
                if t in tf
            )
            if score > 0:
                scores.append((-score, number is None, number or 0))
        for rank, (score, missing, number) in enumerate(sorted(scores)[:top], 1):
            found.append((item, rank, None if missing else number, -score))
    return found
