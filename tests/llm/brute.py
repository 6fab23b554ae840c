"""Plain versions of the operators, for small tables held as lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def shingles(tokens, size=5):
    if len(tokens) >= size:
        return {tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)}
    return {tuple(tokens)} if tokens else set()


def near(rows, similarity=80):
    sets = {d: shingles(words(t)) for d, t in rows}
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeats(rows, span=100):
    first, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        text = (t or "").encode()
        gone = bytearray(len(text))
        for s in range(len(text) - span + 1):
            if first.setdefault(text[s : s + span], (d, s)) != (d, s):
                gone[s : s + span] = b"\1" * span
        kept = bytes(x for x, g in zip(text, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def good_turing(seen):
    """Discounts of the counts 1 to 5 from how many pairs were seen 1 to 6 times (Katz 1987)."""
    out = []
    for r in range(1, 6):
        n, further = seen.get(r, 0), seen.get(r + 1, 0)
        tail = 6 * seen.get(6, 0) / seen[1] if seen.get(1, 0) else 1.0
        if n and further and tail < 1:
            d = ((r + 1) * further / (r * n) - tail) / (1 - tail)
            out.append(d if 0 < d < 1 else 1.0)
        else:
            out.append(1.0)
    return out


def katz(rows, least=1):
    tokens = {d: words(t) for d, t in rows}
    train = [d for d in tokens if zlib.crc32(str(d).encode()) % 7 != 2]
    c = Counter(w for d in train for w in tokens[d])
    n = len(train)
    total, kinds = sum(c.values()) + n, len(c) + (n > 0)
    known = {w for w in c if c[w] >= least}
    other, other_kinds = sum(c[w] for w in c if w not in known), sum(w not in known for w in c)
    seq = {d: [1, *(w if w in known else 0 for w in tokens[d]), 2] for d in tokens}
    pairs = Counter(p for d in train for p in zip(seq[d], seq[d][1:], strict=False))
    seen = Counter(pairs.values())
    d = [*good_turing(seen), 1.0]
    after = defaultdict(dict)
    for (h, w), r in pairs.items():
        after[h][w] = r

    def unigram(w):
        return ({0: other + 1, 1: 1, 2: n + 1}.get(w) or c[w]) / (total + 3)

    def discounted(r):
        return d[min(r, 6) - 1] * r

    def chance(h, w):
        own = after.get(h)
        if not own:
            return unigram(w)
        size = sum(own.values()) + 1
        if w in own:
            return discounted(own[w]) / size
        left = 1 - sum(map(discounted, own.values())) / size
        return left / (1 - sum(map(unigram, own))) * unigram(w)

    out = {}
    for k, own in tokens.items():
        score = sum(math.log10(chance(h, w)) for h, w in zip(seq[k], seq[k][1:], strict=False))
        score += sum(math.log10((c[w] + 1) / (other + other_kinds + 1)) for w in own if w not in known)
        base = sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in own)
        base += math.log10((n + 1) / (total + kinds + 1))
        out[k] = (len(own) + 1, sum(c[w] > 0 for w in own) + (n > 0), total, base, score)
    return out, chance, {*known, 0, 1, 2}


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _personal(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        total = 0
        for i, x in enumerate(reversed(digits)):
            double = 2 * int(x)
            total += int(x) if i % 2 == 0 else double - 9 * (double > 9)
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def personal(text):
    counts, told = [], []
    for kind, pattern in PII:
        own = [m for m in re.finditer(pattern, text or "") if _personal(kind, m.group())]
        counts.append(len(own))
        told += [f"{kind}:{m.start()}:{m.end()}" for m in own]
    return (*counts, hashlib.sha256(",".join(told).encode()).hexdigest())


SECRETS = [
    (
        "assign",
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m.group(2)) >= 12,
    ),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
    ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 16),
]


def secret_spans(text):
    counts, told = [], []
    for k, (kind, pattern, good) in enumerate(SECRETS):
        own = [m for m in re.finditer(pattern, text or "") if good(m)]
        counts.append(len(own))
        told += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in own]
    return (*counts, hashlib.sha256(",".join(x[2] for x in sorted(told)).encode()).hexdigest())


TERMS = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def leaks(rows, items):
    """``{(doc_id, item_id)}``: the shingles of question and answer that a text has, four fifths or more."""
    parts = {
        i: [shingles(TERMS.findall((x or "").translate(LOWER))) for x in (q, a)] for i, q, a in items
    }
    found = set()
    for d, t in rows:
        own = TERMS.findall((t or "").translate(LOWER))
        grams = {tuple(own[i : i + k]) for k in range(1, 6) for i in range(len(own) - k + 1)}
        for item, (q, a) in parts.items():
            if q | a and len(q & grams) + len(a & grams) >= 0.8 * (len(q) + len(a)):
                found.add((d, item))
    return found


def quality(rows, labels, uniform, buckets, hashed, share=None):
    """``{doc_id: (n_grams, log_weight, gumbel_key, kept)}``: target and raw counts of hashed words and
    word pairs, one added to each; ``hashed`` gives the hash of a word, and of a pair of hashes."""
    kinds = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0D]+")
    grams = {}
    for d, t in rows:
        own = [hashed(w) for w in kinds.findall((t or "").translate(LOWER).encode())]
        first = [h % (buckets - 1) + 1 for h in own]
        both = [0 if a == b else hashed(a, b) % (buckets - 1) + 1 for a, b in zip(own, own[1:], strict=False)]
        grams[d] = Counter(first + both)
    raw, target = Counter(), Counter()
    for d, own in grams.items():
        raw.update(own)
        if labels.get(d) == 1:
            target.update(own)
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    keys = {}
    for d, own in grams.items():
        weight = sum(n * math.log((target[g] + 1) / n_target * n_raw / (raw[g] + 1)) for g, n in own.items())
        keys[d] = (sum(own.values()), weight, weight - math.log(-math.log(uniform[d])))
    share = sum(labels.values()) / len(labels) if share is None else share
    k = round(share * len(rows))
    least = sorted((x[2] for x in keys.values()), reverse=True)[k - 1] if k else math.inf
    return {d: (*x, x[2] >= least) for d, x in keys.items()}


def exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        plain = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups[plain].append((-len(t or ""), d))
    out = {}
    for plain, own in groups.items():
        keep = min(own)[1]
        for _, d in own:
            out[d] = (keep, len(own), d == keep, hashlib.sha256(plain.encode()).hexdigest())
    return out
