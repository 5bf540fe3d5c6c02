"""Plain restatements of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re

WHITE = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def decontamination(docs, items, window=10):
    """doc_id -> (n_words, n_hit, item ids)."""
    records = []
    for item, text in items:
        if item is None or text is None:
            continue
        w = ALNUM.findall(text.encode().lower())
        n = min(window, len(w))
        records += [(str(item), w[s : s + n]) for s in range(len(w) - n + 1)] if w else []
    out = []
    for doc, text in docs:
        w = ALNUM.findall((text or "").encode().lower())
        hit, found = set(), set()
        for item, r in records:
            for s in range(len(w) - len(r) + 1):
                if w[s : s + len(r)] == r:
                    hit.update(range(s, s + len(r)))
                    found.add(item)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def quality(docs):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of each."""
    out = []
    for doc, text in docs:
        text = text or ""
        w = [x.decode() for x in WHITE.findall(text.encode())]
        lines = [x for x in text.split("\n") if WHITE.search(x.encode())]
        seen: dict = {}
        for i in range(len(w) - 2):
            seen.setdefault(tuple(w[i : i + 3]), []).append(i)
        covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)))
    return out


def near_duplicates(docs, k=3, percent=85):
    """(doc_id, n_shingles, component_id, kept) of each."""
    sets = []
    for _, text in docs:
        w = WHITE.findall((text or "").encode().lower())
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where: dict = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        near: dict = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, n in near.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(docs[i][0]), find(docs[j][0])))
                root[b] = a
    return [(d, len(s), find(d), find(d) == d) for (d, _), s in zip(docs, sets)]


def lm_base(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of each."""
    import math
    import zlib
    from collections import Counter

    tokens = [[*WHITE.findall((t or "").encode().lower()), None] for _, t in docs]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    counts = Counter(x for t, h in zip(tokens, held) if not h for x in t)
    n, v = sum(counts.values()), len(counts)
    return [(d, h, len(t), sum(counts[x] > 0 for x in t), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t)) for (d, _), h, t in zip(docs, held, tokens)]


def lm_scores(docs):
    """(doc_id, log10 probability) of each, learnt from all: pair shares by power of 1.5 of the context's count, each token left out of its counts."""
    import math
    from collections import Counter

    tokens = [[*WHITE.findall((t or "").encode().lower()), None] for _, t in docs]
    words = Counter(x for t in tokens for x in t)
    pairs = Counter(p for t in tokens for p in zip([None, *t], t))
    n, v = sum(words.values()), len(words)

    def group(c):
        return math.floor(math.log(c) / math.log(1.5) + 1e-9)

    ratios: dict = {}
    for t in tokens:
        for a, b in zip([None, *t], t):
            left = min((pairs[a, b] - 1) / max(words[a] - 1, 1), 1)
            ratios.setdefault(group(words[a]), []).append(left * (n + v) / words[b])
    shares = {}
    for g, r in ratios.items():
        m = 0.5
        for _ in range(200):
            m = min(max(sum(m * x / (m * x + 1 - m) for x in r) / len(r), 1e-6), 1 - 1e-3)
        shares[g] = m
    out = []
    for (d, _), t in zip(docs, tokens):
        total = 0.0
        for a, b in zip([None, *t], t):
            m = shares[group(words[a])]
            total += math.log10(m * pairs[a, b] / words[a] + (1 - m) * (words[b] + 1) / (n + v + 1))
        out.append((d, total))
    return out


def suffix_dedup(docs, span=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each."""
    first: dict = {}
    data = [(d, (t or "").encode()) for d, t in docs]
    for d, b in data:
        for i in range(len(b) - span + 1):
            w = b[i : i + span]
            if w not in first or d < first[w]:
                first[w] = d
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if first[b[i : i + span]] < d:
                gone[i : i + span] = b"\x01" * span
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def languages(rows, texts, longest=5):
    """(language, score) of each text by word-first backoff, learnt from rows (text, label) with each word and n-gram that occurs twice."""
    import math
    from collections import Counter

    def words(text):
        return re.findall(r"[^\W\d_]+", (text or "").lower())

    def grams(word):
        padded = f"^{word}$"
        return [padded[i : i + n] for n in range(1, longest + 1) for i in range(len(padded) - n + 1)]

    labels = sorted({label for _, label in rows})
    seen = {x: Counter(w for t, y in rows if y == x for w in words(t)) for x in labels}
    parts = {x: Counter(g for w, n in seen[x].items() for g in grams(w) for _ in range(n)) for x in labels}

    def logs(counts):
        known = [k for k in set().union(*counts.values()) if sum(counts[x][k] for x in labels) > 1]
        total = {x: sum(counts[x][k] + 0.5 for k in known) for x in labels}
        return {k: [math.log((counts[x][k] + 0.5) / total[x]) for x in labels] for k in known}

    by_word = logs(seen)
    by_gram: dict = {}
    for n in range(1, longest + 1):
        by_gram |= logs({x: Counter({g: c for g, c in parts[x].items() if len(g) == n}) for x in labels})
    out = []
    for text in texts:
        own = words(text)
        if not own:
            out.append(("und", 0.0))
            continue
        sums = [math.log(sum(y == x for _, y in rows) / len(rows)) for x in labels]
        for w in own:
            if w in by_word:
                sums = [a + b for a, b in zip(sums, by_word[w])]
                continue
            padded, i = f"^{w}$", 0
            while i < len(padded):
                n = next((n for n in range(longest, 0, -1) if padded[i : i + n] in by_gram and i + n <= len(padded)), 0)
                if n:
                    sums = [a + b for a, b in zip(sums, by_gram[padded[i : i + n]])]
                i += max(n, 1)
        best = max(range(len(labels)), key=lambda i: sums[i])
        out.append((labels[best], 1 / sum(math.exp((s - sums[best]) / max(1, len(own) / 8)) for s in sums)))
    return out
