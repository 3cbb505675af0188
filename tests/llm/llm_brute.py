"""Plain versions of the training-data operators, and awkward tables to hold them against."""

import collections
import hashlib
import math
import re
import struct
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names an operator might use itself
CLASHES = ["uid", "row", "m", "fp", "score", "kept", "node", "slot", "rank", "length", "b", "found", "k", "n", "host", "value", "rid"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def awkward_documents():
    """Nulls in every column, empty and white texts, a very long one, ties, repeated rows, wide spaces."""
    sentence = "the cat sat on the mat and the dog ran after the red ball in the park"
    other = "Some quite different words make up this line of text and nothing else is said here"
    lines = [
        (1, sentence, "en", "a", 10), (2, sentence.upper(), "en", "a", 10), (3, sentence + " today", "en", "b", None),
        (4, None, "en", "b", None), (5, "", None, None, 0), (6, " \t\n\x0b\x0c\r ", "fr", None, 6),
        (7, "one", "fr", "c", 3), (8, "$$$ &&& *** | <x> 100%", "de", "c", 1), (9, other, "de", "c", 2), (9, other, "de", "c", 2),
        (None, other + " indeed", None, "d", 5), (None, None, None, None, None), (10, "a b c d e a b c d e a b c d e f", "en", "d", 0),
        (11, "x\ny\nx\n\n x\nx\r\nx", "en", "d", 0), (12, "é " * 40 + "ß ü ö　x\x1cy z", "de", "e", 0),
        (13, "word " * 30, "en", "e", 0), (14, sentence + "\n" + other + "\n" + sentence, "en", "e", 0),
        (15, " ".join(f"w{i % 9973}" for i in range(60_000)), "en", "f", 0), (16, "z" * 200_000, "en", "f", 0),
        (17, "İstanbul ǅ ÀÉ 😀 </s>[INST] <|endoftext|> x", "tr", "f", 0),
    ]
    return lines + [(100 + i, f"{sentence} number {i} of many rather like it", "en", "g", i) for i in range(40)]


def words(text):
    return WORD.findall(text or "")


def base_metrics(text):
    text = text or ""
    w = words(text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    covered = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def fingerprint(text):
    w = words(lower(text))
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def near_duplicates(docs, distance=4):
    """(doc_id, text) rows -> [(doc_id, fingerprint, component_id)]"""
    fps = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(docs)]


def contamination(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall(lower(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])] |= {item} - {None}
    sizes = {len(k) for k in windows}
    out = []
    for d, text in docs:
        w = ITEM_WORD.findall(lower(text))
        hit, ids = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    ids |= windows[tuple(w[i:i + n])]
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), digest, bool(hit)))
    return out


def conversations(rows):
    """(conv_id, turn, role, text) -> {conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}"""
    by = collections.defaultdict(list)
    key = lambda r: [(x is not None, x if x is not None else 0) for x in r[1:]]
    for r in sorted(rows, key=lambda r: [(x is not None, str(x) if isinstance(x, str) else x or 0) for x in key(r)]):
        by[r[0]].append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def pieces(text, tokenizer, size):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
    return [(i, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def crc_mod(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def base_scores(docs):
    """(doc_id, text) -> [(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)]"""
    tokens = [[*words(lower(t)), " "] for _, t in docs]
    counts = collections.Counter()
    for (d, _), w in zip(docs, tokens, strict=True):
        if crc_mod(d, 7) != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return [(d, crc_mod(d, 7) == 2, len(w), sum(counts[x] > 0 for x in w), n,
             math.fsum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for (d, _), w in zip(docs, tokens, strict=True)]


def bigram_scores(docs, mix):
    """(doc_id, text) -> log10 probability of each text from exact counts of its tokens and pairs of tokens."""
    one, two = collections.Counter(), collections.Counter()
    tokens = {d: [*words(lower(t)), " "] for d, t in docs}
    for d, w in tokens.items():
        if crc_mod(d, 7) != 2:
            one.update(["", *w])                            # the start stands before the first token
            two.update(zip(["", *w], w, strict=False))
    total = sum(one.values()) - one[""] + len(one) - ("" in one) + 1
    return {d: math.fsum(math.log10((1 - mix) * (one[b] + 1) / total + mix * (two[a, b] / one[a] if one[a] else 0))
                         for a, b in zip(["", *w], w, strict=False)) for d, w in tokens.items()}


def kd_leaves(rows, shards):
    """(id, size, coordinates) -> sets of ids: split at the weighted median of the widest dimension. The values of a
    dimension must differ."""
    if shards < 2:
        return [frozenset(r[0] for r in rows)]
    span = [[min(x), max(x)] for x in zip(*(r[2] for r in rows), strict=True)]
    dim = max(range(len(span)), key=lambda d: (span[d][1] - span[d][0], -d))
    rows = sorted(rows, key=lambda r: r[2][dim])
    want = sum(r[1] for r in rows) * (shards // 2) / shards
    sums = [0]
    for r in rows:
        sums.append(sums[-1] + r[1])
    cut = min(range(len(sums)), key=lambda i: (abs(sums[i] - want), i))
    return kd_leaves(rows[:cut], shards // 2) + kd_leaves(rows[cut:], shards - shards // 2)


def segmentation(word, vocabulary):
    best, count = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for begin in range(end - 1, max(-1, end - 1 - vocabulary.longest), -1):
            s = vocabulary.scores.get(word[begin:end])
            if s is not None and best[begin] + s > best[end]:
                best[end], count[end] = best[begin] + s, count[begin] + 1
        if word[end - 1] not in vocabulary.scores:
            k = len(word[end - 1].encode())
            if best[end - 1] + k * vocabulary.unknown > best[end]:
                best[end], count[end] = best[end - 1] + k * vocabulary.unknown, count[end - 1] + k
    return count[-1], best[-1]


def best_fit_decreasing(lengths, size):
    """Windows as lists of lengths, by searching all open windows for each piece."""
    windows = []
    for n in sorted(lengths, reverse=True):
        fit = [w for w in windows if sum(w) + n <= size]
        if fit:
            max(fit, key=sum).append(n)
        else:
            windows.append([n])
    return windows


def ngrams(text, max_n):
    w = ITEM_WORD.findall(lower(text))
    return [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def resampled(docs, target, percent=25, min_words=20, buckets=10_000, max_n=2):
    """(doc_id, text), [text] -> [(doc_id, n_features, weight, score, rank)]"""
    crc = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(map(crc, ngrams(text, max_n)))
    for text in target:
        t.update(map(crc, ngrams(text, max_n)))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    rows = []
    for d, text in docs:
        f = ngrams(text, max_n)
        weight = sum(gain(crc(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r, (_, text) in zip(rows, docs, strict=True) if len(ITEM_WORD.findall(lower(text))) >= min_words]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return [tuple(r) for r in rows]


def divergence(docs, top=200):
    """(lang, source, text) -> {(lang, source, part, item, value, rank)}"""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(a or "", b or "", term.findall(lower(t))) for a, b, t in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= 3)
        groups = {s: collections.Counter(t for d in own if d[1] == s for t in d[2] if df[t] >= 3) for s in {d[1] for d in own}}
        whole = sum(groups.values(), collections.Counter())
        p = {s: {t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in [*groups.items(), (None, whole)]}
        for s, c in groups.items():
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in groups if o != s]
            terms = [(t, (p[s][t] - p[None][t]) ** 2 // p[None][t]) for t in kept if c[t] and p[s][t] > p[None][t]]
            for part, rows, most in (("pair", pairs, None), ("term", terms, top)):
                for i, (item, value) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:most]):
                    out.add((lang, s, part, item, value, i + 1))
    return out


def pu_scores(rows, positives, steps=1000):
    """Plain non-negative PU learning over feature rows ``(row_hash, x)``, positives ``x``: (prior, score function).

    Every training row is an unlabelled one; nothing is drawn and repeated rows stand for themselves.
    """
    import numpy as np
    every = np.array([x for _, x in rows], float)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    z = lambda x: np.clip((np.array(x, float) - mean) / scale, -8, 8)
    sigmoid = lambda s: 1 / (1 + np.exp(-np.clip(s, -30, 30)))

    def learn(p, u, prior, n, decay):
        w = np.zeros(p.shape[1] + 1)
        p, u = np.column_stack([p, np.ones(len(p))]), np.column_stack([u, np.ones(len(u))])
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, n + 1):
            a, b = sigmoid(p @ w), sigmoid(u @ w)
            positive = -(p * (1 - a)[:, None]).mean(axis=0)            # slope of E_p[l(z)]
            negative = (u * b[:, None]).mean(axis=0) - prior * (p * a[:, None]).mean(axis=0)
            risk = -np.log(1 - np.minimum(b, 1 - 1e-12)).mean() + prior * np.log(1 - np.minimum(a, 1 - 1e-12)).mean()
            g = prior * positive + negative if risk >= 0 else -negative
            g = g + decay * np.append(w[:-1], 0)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        return w

    p = z(sorted(positives, key=tuple))
    even, odd = z([x for h, x in rows if h % 2 == 0]), z([x for h, x in rows if h % 2])
    w = learn(p[::2], even, 0.5, 150, 1e-3)
    held, other = p[1::2] @ w[:-1] + w[-1], odd @ w[:-1] + w[-1]
    margin = math.sqrt(math.log(40) / 2 / len(held)) + math.sqrt(math.log(40) / 2 / len(other))
    ratios = []
    for q in np.linspace(0, 0.8, 161):
        cut = np.quantile(held, q) - 1e-9
        fp, fu = (held >= cut).mean(), (other >= cut).mean()
        ratios.append(((fu + margin) / max(fp, 1e-9), fu / fp))
    prior = min(max(min(ratios, key=lambda r: r[0])[1], 0.05), 0.99)
    w = learn(p, z([x for _, x in rows]), prior, steps, 1e-4)
    return prior, lambda x: sigmoid(z(x) @ w[:-1] + w[-1])
