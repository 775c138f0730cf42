"""What operators give, by the plainest means, on small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def substring_dedup(rows, window=20):
    """doc_id, n_words, n_removed, digest of what is kept, for rows of distinct ids."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for a in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][a : a + window]), (i, a))
    out = []
    for i, w in words.items():
        gone = set()
        for a in range(len(w) - window + 1):
            if first[tuple(w[a : a + window])] != (i, a):
                gone.update(range(a, a + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out)


def suffix_dedup(rows, window=50):
    """doc_id, n_bytes, n_removed, n_spans, digest of what is kept, for rows of distinct ids."""
    data = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(data):
        for a in range(len(data[i]) - window + 1):
            first.setdefault(data[i][a : a + window], i)
    out = []
    for i, d in data.items():
        gone = bytearray(len(d))
        for a in range(len(d) - window + 1):
            if first[d[a : a + window]] != i:
                gone[a : a + window] = b"\x01" * window
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((i, len(d), sum(gone), spans, sha(bytes(b for b, g in zip(d, gone) if not g))))
    return sorted(out)


def passages(rows, window=50):
    """What is left of each text where characters go whole, for rows of distinct ids."""
    data = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(data):
        for a in range(len(data[i]) - window + 1):
            first.setdefault(data[i][a : a + window], i)
    out = {}
    for i, t in rows:
        gone = bytearray(len(data[i]))
        for a in range(len(gone) - window + 1):
            if first[data[i][a : a + window]] != i:
                gone[a : a + window] = b"\x01" * window
        kept, at = [], 0
        for c in t or "":
            size = len(c.encode())
            if not any(gone[at : at + size]):
                kept.append(c)
            at += size
        out[i] = "".join(kept)
    return out


def simhash(rows, shingle=4, max_bits=4):
    """doc_id, fingerprint, component, by comparing all pairs of fingerprints."""
    import xxhash

    prints = {}
    for i, t in rows:
        words = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        words = WORD.findall(words)
        parts = [" ".join(words[a : a + shingle]) for a in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((i, f"{prints[i]:016x}", find(i)) for i in ids)


def kneser_ney(rows, order=2):
    """doc_id, n_tokens, n_known, N, base score, score; ``rows`` are (id, text, learnt)."""
    import math
    from collections import Counter, defaultdict

    docs = []
    for i, t, learnt in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        docs.append((i, ["<s>"] * (order - 1) + WORD.findall(text) + ["</s>"], learnt))
    counts = {m: Counter() for m in range(1, order + 1)}
    plain = Counter()
    for _, tokens, learnt in docs:
        for at in range(order - 1, len(tokens)) if learnt else ():
            plain[tokens[at]] += 1
            counts[order][tuple(tokens[at - order + 1 : at + 1])] += 1
            for m in range(1, order):
                gram = tuple(tokens[at - m + 1 : at + 1])
                if gram[0] == "<s>":
                    counts[m][gram] += 1
    for m in range(order - 1, 0, -1):
        before = defaultdict(set)
        for gram in counts[m + 1]:
            if gram[1] != "<s>":
                before[gram[1:]].add(gram[0])
        for gram, found in before.items():
            counts[m][gram] = len(found)
    discounts, behind = {}, {m: defaultdict(Counter) for m in counts}
    for m in counts:
        n = Counter(counts[m].values())
        discounts[m] = [0.0]
        for i in (1, 2, 3):
            if n[1] and n[2] and n[i] and n[i + 1]:
                d = i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i]
                discounts[m].append(min(max(d, 0.0), float(i)))
            else:
                discounts[m].append((0.5, 1.0, 1.5)[i - 1])
        for gram, c in counts[m].items():
            behind[m][gram[:-1]]["sum"] += c
            behind[m][gram[:-1]][min(c, 3)] += 1
    total, distinct = sum(plain.values()), len(plain)
    out = []
    for i, tokens, _ in docs:
        base = score = 0.0
        for at in range(order - 1, len(tokens)):
            chance = 1 / (distinct + 1)
            for m in range(1, order + 1):
                gram = tuple(tokens[at - m + 1 : at + 1])
                context, d = behind[m].get(gram[:-1]), discounts[m]
                if context:
                    c = counts[m][gram]
                    left = sum(d[k] * context[k] for k in (1, 2, 3))
                    chance = (c - d[min(c, 3)]) / context["sum"] + left / context["sum"] * chance
            score += math.log10(chance)
            base += math.log10((plain[tokens[at]] + 0.1) / (total + 0.1 * (distinct + 1)))
        known = sum(plain[t] > 0 for t in tokens[order - 1 :])
        out.append((i, len(tokens) - order + 1, known, total, base, score))
    return sorted(out)
