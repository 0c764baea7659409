"""Plain single-process versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import public_tokenizers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def jaccard(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text)."""
    sets = []
    for i, text in rows:
        w = WORD.findall(lower(text))
        sets.append((i, {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set()))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        low[find(k)] = min(low.get(find(k), i), i)
    return [(i, len(s), low[find(k)]) for k, (i, s) in enumerate(sets)]


def quality(rows):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    out = []
    for i, text in rows:
        text = text or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        count, hit = Counter(windows), set()
        for k, x in enumerate(windows):
            if count[x] > 1:
                hit.update(range(k, k + 8))
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)))
    return out


def contamination(rows, items):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows = {}
    for i, text in items:
        w = ALNUM.findall(lower(text))
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    sizes, out = {len(x) for x in windows}, []
    for i, text in rows:
        w = ALNUM.findall(lower(text))
        hit, ids = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    ids |= own
        out.append((i, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def substrings(rows, n=35):
    """(doc_id, n_words, n_removed, kept_sha256)."""
    words = [WORD.findall(text or "") for _, text in rows]
    count = Counter(tuple(w[k : k + n]) for w in words for k in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(rows, words):
        hit = set()
        for k in range(len(w) - n + 1):
            if count[tuple(w[k : k + n])] > 1:
                hit.update(range(k, k + n))
        out.append((i, len(w), len(hit), sha(" ".join(x for k, x in enumerate(w) if k not in hit))))
    return out


def base_licenses(rows):
    """(doc_id, n_words, n_base, first_word, last_word, base_labels)."""
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    out = []
    for i, text in rows:
        w = ALNUM.findall(lower(text))
        at = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in at]
        out.append((i, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    return out


def unigram(rows, divisor=7, held=2):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    texts = [(i, WORD.findall(lower(text)) + [None], i is not None and zlib.crc32(str(i).encode()) % divisor == held) for i, text in rows]
    count = Counter(t for _, own, out in texts if not out for t in own)
    total, distinct = sum(count.values()), len(count)
    floor = math.log10(total + distinct + 1)
    return [(i, out, len(own), sum(count[t] > 0 for t in own), total, sum(math.log10(count[t] + 1) - floor for t in own)) for i, own, out in texts]


def lattice_log10(word, logs):
    """Sum over all segmentations of a word, piece by piece; ``logs``: natural logs by piece."""
    ways = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        ways[j] = sum(ways[i] * math.exp(logs[word[i:j]]) for i in range(j) if word[i:j] in logs)
    return math.log10(ways[-1])


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def token_counts(rows):
    t = tokenizer("byte_bpe_50k.json")
    sizes = [len(t.encode(text or "", add_special_tokens=False).ids) for _, text in rows]
    return [(i, len((text or "").encode()), n, n > 1024) for (i, text), n in zip(rows, sizes)]
