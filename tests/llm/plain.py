"""Plain versions of the operators, on lists, to hold results against."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = re.compile(r"[\x20\x09-\x0D]")


def sha(x) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def exact(docs):
    """Rows (doc_id, keep_id, group_size, kept, sha) of (doc_id, text); ids are unique."""
    groups = {}
    for i, t in docs:
        groups.setdefault(BLANK.sub("", t or ""), []).append((-len(t or ""), i))
    out = []
    for norm, rows in groups.items():
        keep = min(rows)[1]
        out += [(i, keep, len(rows), i == keep, sha(norm)) for _, i in rows]
    return sorted(out)


def substring(docs, length=13):
    """doc_id, n_words, n_removed, sha."""
    first, words = {}, {i: WORD.findall(t or "") for i, t in docs}
    for i in sorted(words):
        for p in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][p : p + length]), i)
    out = []
    for i, w in words.items():
        covered = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < i:
                covered[p : p + length] = [True] * length
        kept = [x for x, c in zip(w, covered, strict=True) if not c]
        out.append((i, len(w), sum(covered), sha(" ".join(kept))))
    return sorted(out)


def runs(text, width=5):
    w = WORD.findall(text or "")
    k = min(width, len(w))
    return frozenset(tuple(w[p : p + k]) for p in range(len(w) - k + 1)) if w else frozenset()


def jaccard(docs):
    """doc_id: (class_id, n_links), by comparing all pairs."""
    sets = {i: runs(t) for i, t in docs}
    label, links = {i: i for i in sets}, Counter()
    pairs = []
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                pairs.append((i, j))
                links[i] += 1
                links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return {i: (label[i], links[i]) for i in sets}


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    times = Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
    covered = [False] * len(w)
    for p in range(len(w) - 2):
        if times[tuple(w[p : p + 3])] > 1:
            covered[p : p + 3] = [True] * 3
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), sum(covered)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(x) for x in digits[::-1]]
    doubled[1::2] = [sum(divmod(2 * x, 10)) for x in doubled[1::2]]
    return sum(doubled) % 10 == 0


def personal(text):
    """(start, kind, end) of the base spans."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def terms(text):
    """(start, end, lower-case word) of the words outside of personal data."""
    taken = {p for a, _, b in personal(text) for p in range(a, b)}
    return [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", text) if not taken & set(range(m.start(), m.end()))]


def disclosing(texts, support, least):
    """Words whose disclosure of an entity is `least` or more, proven by `support` texts with surroundings of their own."""
    same = sorted({" ".join(t.lower().split()) for t in texts}, key=xxhash.xxh3_64_intdigest)
    value = lambda t, a, k, b: (k, t[a:b] if k < 2 else re.sub("[^0-9]", "", t[a:b]))
    entities = [{value(t, *s) for s in personal(t)} for t in same]
    words = [{w for _, _, w in terms(t)} for t in same]
    split = [re.findall(r"[^\W_]+", t) for t in same]
    found = set()
    for e in set().union(*entities):
        there = [k for k, x in enumerate(entities) if e in x]
        seen, proofs = set(), set()
        for k in there:
            own = []
            n = max(1, len(split[k]) - 2)
            for p in range(n):
                run = tuple(split[k][p : p + 3])
                own.append("x" if run not in seen else " ")
                seen.add(run)
            if "x" * min(n, 8, max(4, -(-n // 2))) in "".join(own):
                proofs.add(k)
        for w in set().union(*(words[k] for k in there)):
            together = [k for k in there if w in words[k]]
            if len(proofs.intersection(together)) >= support:
                members = sum(w in x for x in words)
                if 1 + math.log(len(together) / members) / max(1e-9, math.log(len(same) / len(there))) >= least - 1e-12:
                    found.add(w)
    return found
