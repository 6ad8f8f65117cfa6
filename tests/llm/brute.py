"""Plain-Python versions of the operators, written from their contracts."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def jaccard_groups(texts):
    """(shingles, smallest linked index) per text, links by position."""
    sets = [shingles(t) for t in texts]
    union = Union(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                union.join(i, j)
    return [(len(s), union.find(i)) for i, s in enumerate(sets)]


def repeated(texts, width=200):
    """(kept bytes, removed, runs) per text."""
    raws = [(t or "").encode() if isinstance(t, str) or t is None else t for t in texts]
    count = Counter(r[i:i + width] for r in raws for i in range(len(r) - width + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - width + 1):
            if count[r[i:i + width]] > 1:
                gone[i:i + width] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((bytes(np.frombuffer(r, np.uint8)[~gone[:-1]]), int(gone.sum()), runs))
    return out


def sources(sizes):
    """source -> (size, target) from [(source, size)], by repeated resharing."""
    total = defaultdict(int)
    for s, n in sizes:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(total.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] > 2 * total[s]]
        if not full:
            for s in free:
                target[s] = level * weight[s]
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
            free.remove(s)
    return {s: (total[s], target[s]) for s in order}


def mix_key(doc_id, text):
    u = (int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
    body = "".join(words(text))
    clean = body.translate({ord(c): None for c in "0123456789#*$%&|<>{}[]=_~^"})
    return -math.log(u) / max(0.05, len(clean) / max(len(body), 1))


def mix(rows):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source)."""
    sizes = [len(words(t)) for _, t, _ in rows]
    goal = sources([(s, n) for (_, _, s), n in zip(rows, sizes)])
    rank = lambda d, t, n: (mix_key(d, t), d is not None, d or 0, n)
    copies = {}
    for s, (size, target) in goal.items():
        own = Counter(rank(d, t, n) for (d, t, src), n in zip(rows, sizes) if src == s and n)
        epochs = math.floor(target / size) if size else 0
        budget, before = target - epochs * size, 0
        for key in sorted(own):
            group = own[key] * key[-1]
            copies[s, key] = epochs + (epochs < 2 and (budget - before) * 2 >= group)
            before += group
    return [(d, n, *goal[s], n * copies.get((s, rank(d, t, n)), 0)) for (d, t, s), n in zip(rows, sizes)]


def counts(text):
    """The base counts and the rules' other counts of a text."""
    w = words(text)
    text = text or ""
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if windows[w[i], w[i + 1], w[i + 2]] > 1:
            hit.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit), "n_lines": len(lines),
            "n_kinds": len(set(w)), "n_upper": len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text)),
            "n_digits": sum(c in "0123456789" for c in text)}


def quality(texts, module):
    """(counts, base_failed, kept) per text, EM in plain floats."""
    table = [counts(t) for t in texts]
    votes = []
    for c in table:
        row = []
        for ratio, good, bad in module.RULES.values():
            value = eval(ratio, {"greatest": max}, c)  # noqa: S307 - the rules' own expressions
            row.append(0 if not c["n_words"] else 1 if value <= good else -1 if value > bad else 0)
        votes.append(row)
    accuracy, share = [module.START_ACCURACY] * len(module.RULES), module.START_GOOD

    def posterior(row):
        s = math.log(share / (1 - share))
        for v, (g, b) in zip(row, accuracy):
            s += math.log(g / (1 - b)) if v == 1 else math.log((1 - g) / b) if v == -1 else 0.0
        return 1 / (1 + math.exp(-s))

    for _ in range(module.ROUNDS if votes else 0):
        p = [posterior(r) for r in votes]
        old = (accuracy, share)
        share = min(max(sum(p) / len(p), module.GOOD_RANGE[0]), module.GOOD_RANGE[1])
        accuracy = []
        for k in range(len(module.RULES)):
            pair = []
            for side, sign, q in ((0, 1, p), (1, -1, [1 - x for x in p])):
                voted = sum(x for x, r in zip(q, votes) if r[k])
                right = sum(x for x, r in zip(q, votes) if r[k] == sign)
                pair.append(min(max(right / voted, module.ACCURACY_RANGE[0]), module.ACCURACY_RANGE[1])
                            if voted > 1e-9 else module.START_ACCURACY[side])
            accuracy.append(tuple(pair))
        if max(abs(share - old[1]), *(abs(a - b) for x, y in zip(accuracy, old[0]) for a, b in zip(x, y))) < 1e-6:
            break
    out = []
    for c, row in zip(table, votes):
        failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        out.append((c, failed, not failed and posterior(row) >= module.KEEP_FROM))
    return out


def tokenizer(path, pattern):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("brute", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokens(enc, text):
    """(n_tokens, ids_sha256, decoded_sha256)."""
    ids = enc.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
