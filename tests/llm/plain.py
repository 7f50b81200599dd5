"""Plain versions of the text operators, one document or pair at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import regex

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [] if text is None else WORD.findall(text)


def base_statistics(text):
    w = words(text)
    n = len(w)
    windows = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    repeated = {i + k for i in range(n - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return {
        "n_words": n,
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": n < 50 or 100 * len(repeated) > 50 * n,
    }, len(lines)


def shingles(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_groups(rows):
    """doc_id -> (n_shingles, component); every pair that shares a shingle is compared."""
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(i)
    pairs = {(a, b) for held in by.values() if len(held) > 1 for n, a in enumerate(held) for b in held[:n]}
    for a, b in pairs:
        both = len(sets[a][1] & sets[b][1])
        if 100 * both >= 75 * (len(sets[a][1]) + len(sets[b][1]) - both):
            parent[root(a)] = root(b)
    lowest = {}
    for i, (doc_id, _) in enumerate(sets):
        r = root(i)
        known = [x for x in (lowest.get(r), doc_id) if x is not None]
        lowest[r] = min(known) if known else None
    return [(doc_id, len(s), lowest[root(i)]) for i, (doc_id, s) in enumerate(sets)]


def without_repeats(rows, window=35):
    """(doc_id, n_words, n_removed, sha) of each row."""
    tokens = [words(text) for _, text in rows]
    counts = Counter(
        tuple(w[i : i + window]) for w in tokens for i in range(len(w) - window + 1)
    )
    out = []
    for (doc_id, _), w in zip(rows, tokens, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        sha = hashlib.sha256(" ".join(kept).encode("utf-8", "surrogatepass")).hexdigest()
        out.append((doc_id, len(w), len(gone), sha))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def within_one_edit(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    for i in range(min(len(a), len(b)) + 1):
        if a[:i] == b[:i] and (a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]):
            return True
    return False


def mcd(vectors, share=0.75, steps=3, unit=64.0, bins=16, consistency=1.486):
    """Centre and inverse scatter of one group, by the operator's definition."""
    import numpy as np

    x = np.array(vectors, float)
    n, dims = x.shape
    ridge = np.eye(dims) * unit**2
    medians = np.median(x, axis=0)
    starts = [(medians, ridge), (x.mean(axis=0), np.cov(x.T, bias=True) + ridge)]
    best = None
    for centre, scatter in starts:
        for _ in range(steps):
            diff = x - centre
            d = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(scatter), diff)
            b = np.floor(np.log2(1 + d) * bins).astype(int)
            taken = np.zeros(n, bool)
            for value in sorted(set(b)):
                if taken.sum() >= share * n:
                    break
                taken |= b == value
            centre = x[taken].mean(axis=0)
            scatter = np.cov(x[taken].T, bias=True) * consistency + ridge
        size = math.sqrt(np.linalg.det(scatter))
        if best is None or size < best[0]:
            best = (size, centre, np.linalg.inv(scatter))
    return best[1], best[2]


def damage(conv_id, turn, role, text):
    """The rows that become of a conversation's row."""
    role, text = " " if role is None else role, " " if text is None else text
    key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
    kind = zlib.crc32(key.encode()) % 20
    text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
    row = (turn, "user" if kind == 4 else role, text)
    return [row] * {0: 0, 3: 2}.get(kind, 1)


_UNITS = r"(?i)(?<=\b0\s)(?:%s)(?![\p{L}\p{N}])"
_MARKS = r"[^\p{L}\p{N}\x20\x09-\x0D]+"
_SLOTS = ("0", "00", "000")


def shapes(text, units):
    """(template words, raw words)."""
    bare = lambda t: words(regex.sub(_MARKS, "", t).lower())
    shaped = regex.sub(r"\p{Nd}+(?:[.,:/]\p{Nd}+)*", "0", text)
    shaped = regex.sub(_UNITS % "|".join(sorted(units, key=len, reverse=True)), "00", shaped)
    return bare(regex.sub(r"(?<=[\p{L}\p{N},;]\s)\p{Lu}[\p{L}'’-]*", "000", shaped)), bare(text)


def _consistent(pairs):
    changed = {(k, was, now) for k, was, now in pairs}
    return len(changed) == len({(k, was) for k, was, _ in changed})


def leaks(docs, items, units, window=8, holders=5, literal=4, excerpt=13):
    """(doc_id, item_id) of every document and item, one pair after the other."""
    shaped = {i: shapes(t, units) for i, t in items}
    at = {i: [p for p in range(len(t) - window + 1) if sum(w not in _SLOTS for w in t[p : p + window]) >= literal]
          for i, (t, _) in shaped.items()}
    held = defaultdict(set)
    for i, (t, _) in shaped.items():
        for p in at[i]:
            held[tuple(t[p : p + window])].add(tuple(t))
    own = {i: [p for p in at[i] if len(held[tuple(t[p : p + window])]) <= holders] for i, (t, _) in shaped.items()}
    out = set()
    for d, text in docs:
        doc, now = shapes(text or "", units)
        places = defaultdict(list)
        for p in range(len(doc) - window + 1):
            places[tuple(doc[p : p + window])].append(p)
        for i, (t, was) in shaped.items():
            n = len(was)
            if not own[i]:
                if n and any(now[p : p + n] == was for p in range(len(now) - n + 1)):
                    out.add((d, i))
                continue
            shifts = defaultdict(list)
            for p in own[i]:
                for q in places.get(tuple(t[p : p + window]), ()):
                    shifts[q - p].append(p)
            share, found = 0, False
            for shift, met in shifts.items():
                beside = [(t[p], was[p], now[p + shift], doc[p + shift] == t[p]) if 0 <= p + shift < len(now)
                          else (t[p], was[p], None, False) for p in range(n)]
                slots = [b[:3] for b in beside[min(met) : max(met) + window] if b[0] in _SLOTS and b[3]]
                if _consistent(slots):
                    share += len(met)
                    run, marked = 0, False
                    for p, b in enumerate(beside):
                        run = run + 1 if b[1] == b[2] else 0
                        marked = run >= window and (marked or p - window + 1 in own[i])
                        found |= marked and run >= excerpt
                agreed = sum(b[3] for b in beside)
                found |= agreed >= 0.75 * n and _consistent([b[:3] for b in beside if b[0] in _SLOTS and b[3]])
            if found or share >= 0.5 * len(own[i]):
                out.add((d, i))
    return out


_NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def _inserted(best):
    best = dict(best)
    for _ in range(3):
        for state in list(best):
            cost, audit, lines = best[state]
            role = _NEXT[state]
            found = (cost + 5, audit + "I", (*lines, (role, "")))
            if role[0] not in best or found[:2] < best[role[0]][:2]:
                best[role[0]] = found
    return best


def repaired(rows):
    """Contract row of one conversation's (conv_id, turn, role, text): the best of each state, row by row."""
    found = [r for row in rows for r in damage(*row)]
    found.sort(key=lambda r: (
        r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    ))
    seen, faults, best = set(), [], {"": (0, "", ())}
    for _, role, text in found:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        if not body:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    for (_, role, text), fault in zip(found, faults, strict=True):
        after = {}
        for state, (cost, audit, lines) in _inserted(best).items():
            more = 5 * (fault == "truncated")
            ways = [(state, cost + 2, "D", lines)]
            if fault not in ("blank", "duplicate"):
                new = _NEXT[state]
                if role[:1] == new[0] or (role[:1] == "s" and state == ""):
                    ways.append((role[0], cost + more, "K", (*lines, (role, text))))
                ways.append((new[0], cost + 1 + more, "R", (*lines, (new, text))))
            for to, price, edit, kept in ways:
                if to not in after or (price, audit + edit) < after[to][:2]:
                    after[to] = (price, audit + edit, kept)
        best = after
    best = _inserted(best)
    cost, audit, lines = min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])
    initials = [role[:1] for _, role, _ in found]
    turns = [turn for turn, _, _ in found if turn is not None]
    return (
        rows[0][0], max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
        faults.count("duplicate"), faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    )


def conversations(rows):
    by = defaultdict(list)
    for row in rows:
        by[row[0]].append(row)
    return [repaired(own) for own in by.values()]


def archived(rows):
    """Contract rows of (page_id, html)."""
    payloads = [(page, (html or "").encode()) for page, html in rows]
    held = defaultdict(list)
    for page, payload in payloads:
        held[payload].append(page)
    out = []
    for page, payload in payloads:
        known = [p for p in held[payload] if p is not None]
        again = len(payload) >= 100 and known and page != min(known)
        out.append((
            page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response",
            min(known) if again else None,
        ))
    return out
