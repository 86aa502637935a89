"""Plain Python versions of what the operators return, to compare with."""

import hashlib
import re
from collections import defaultdict

import xxhash

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl",
           ("all", "rights", "reserved"): "reserved"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii(text):
    """Base spans (kind, start, end)."""
    found = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 8 <= len(digits) <= 15):
                found.append((kind, m.start(), m.end()))
    return found


def pii_hash(text):
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in pii(text))
    return hashlib.sha256(joined.encode()).hexdigest()


def license_base(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
    hits = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
            if tuple(words[i:i + len(phrase)]) == phrase]
    return (len(words), len(hits), min((i for i, _ in hits), default=None),
            max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits})))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))


def simhash(text, width=4):
    words = words_of(text)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def components(ids, linked):
    """Smallest id reachable over ``linked(i, j)`` by position."""
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, x in enumerate(ids):
        root = find(i)
        if x is not None and (least[root] is None or x < least[root]):
            least[root] = x
    return [least[find(i)] for i in range(len(ids))]
