"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def drop_repeats(rows, length: int, unit: str):
    """{doc_id: (symbols, removed, spans, sha256)} for rows with distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        symbols = words(text) if unit == "words" else (text or "").encode()
        gone = [False] * len(symbols)
        for i in range(len(symbols) - length + 1):
            window = tuple(symbols[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        kept = [s for s, g in zip(symbols, gone) if not g]
        joined = b" ".join(kept) if unit == "words" else bytes(kept)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(symbols), sum(gone), spans, hashlib.sha256(joined).hexdigest())
    return out


def shingle_set(text: str | None, size: int) -> frozenset:
    own = [w.lower() if w.isascii() else re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    if len(own) < size:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def components(rows, percent: int, size: int):
    """{doc_id: (set size, smallest reachable doc_id)} for rows with distinct ids."""
    sets = {d: shingle_set(t, size) for d, t in rows}
    shared: dict = defaultdict(int)
    holders = defaultdict(list)
    for d in sorted(sets):
        for s in sets[d]:
            for other in holders[s]:
                shared[other, d] += 1
            holders[s].append(d)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def alike(x: list[bytes], y: list[bytes], min_edit: int) -> bool:
    """Equal, or one word apart if both have enough words."""
    if x == y:
        return True
    if min(len(x), len(y)) < min_edit or abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    if len(x) < len(y):
        x, y = y, x
    return any(x[:i] + x[i + 1 :] == y for i in range(len(x)))


def removed_lines(rows, min_words: int, min_edit: int):
    """{doc_id: numbers of removed lines} for rows with distinct ids."""
    before: list[list[bytes]] = []
    out = {}
    for doc, text in sorted(rows):
        gone = set()
        for i, line in enumerate((text or "").split("\n")):
            own = words(line)
            if len(own) < min_words:
                continue
            if any(alike(own, other, min_edit) for other in before):
                gone.add(i)
            before.append(own)
        out[doc] = gone
    return out


def segment(text: str | None, scores: dict, unknown: int, longest: int, byte_ids: list[int]):
    """Ids of the best pieces; ``scores`` maps a piece to (score, id)."""
    if not text:
        return []
    s = "▁" + text.replace(" ", "▁")
    best = [(0, 0)]
    for end in range(1, len(s) + 1):
        ways = []
        for size in range(min(longest, end), 0, -1):
            own = scores.get(s[end - size : end])
            if own or size == 1:
                ways.append((best[end - size][0] + (own[0] if own else unknown), size))
        best.append(max(ways))
    out, end = [], len(s)
    while end:
        piece = s[end - best[end][1] : end]
        ids = [scores[piece][1]] if piece in scores else [byte_ids[b] for b in piece.encode()]
        out[:0] = ids
        end -= best[end][1]
    return out


def _discounts(counts) -> list[float]:
    n1, n2, n3, n4 = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        if all(0 < d <= k for k, d in enumerate(found, 1)):
            return [0.0, *found]
    return [0.0, 0.5, 1.0, 1.5]


def kneser_ney(rows):
    """[(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)], as ``rows``."""
    start, end = object(), object()
    texts = []
    for doc, text in rows:
        own = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
        held = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1
        texts.append((doc, held, [*own, end]))
    single, three, two, one = Counter(), Counter(), Counter(), Counter()
    for _, held, own in texts:
        if held:
            continue
        single.update(own)
        two[start, own[0]] += 1
        padded = [start, *own]
        three.update(zip(padded, padded[1:], padded[2:]))
    for _, v, w in three:
        two[v, w] += 1
    for _, w in two:
        one[w] += 1
    total, kinds = sum(single.values()), len(single)
    tables = []
    for table in (one, two, three):
        cut = _discounts(list(table.values()))
        sums, freed = Counter(), Counter()
        for key, c in table.items():
            context = key[:-1] if table is not one else ()
            sums[context] += c
            freed[context] += cut[min(c, 3)]
        tables.append((table, cut, sums, freed))

    def probability(context, w):
        if context is None:
            return 1 / (kinds + 1)
        table, cut, sums, freed = tables[len(context)]
        lower = probability(context[1:] if context else None, w)
        if not sums[context]:
            return lower
        c = table[(*context, w) if context else w]
        return (c - cut[min(c, 3)]) / sums[context] + freed[context] / sums[context] * lower

    out = []
    for doc, held, own in texts:
        padded = [start, *own]
        base = sum(math.log10((single[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        score = sum(
            math.log10(probability(tuple(padded[max(i - 1, 0) : i + 1]), w)) for i, w in enumerate(own)
        )
        out.append((doc, held, len(own), sum(single[w] > 0 for w in own), total, base, score))
    return out


def runs(own: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    found, n = set(), len(own)
    for q in range(1, n // 4 + 1):
        same = [own[i] == own[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(
                (i, size, p) in found or all(own[x] == own[x + p] for x in range(i, i + size - p))
                for p in range(1, q)
            ):
                found.add((i, size, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_report(doc, text: str | None):
    own = words(text)
    n, h = len(own), 1 if doc is None else zlib.crc32(str(doc).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)]
    found = runs(own)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    told = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    left = b" ".join(w for i, w in enumerate(own) if i not in gone)
    milli = math.floor(1000 * best[1] / best[2]) if found else None
    digests = [hashlib.sha256(x).hexdigest() for x in (told.encode(), left)]
    return (doc, len(found), *best, milli, *digests)


def hard_negatives(rows, is_anchor):
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    out = []
    for a, anchor, label in whole:
        if not is_anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(anchor, v)), i, other) for i, v, other in whole if i != a]
        for p, positive, _ in sorted(r for r in scored if r[2] == label)[:5]:
            fits = [r for r in scored if r[2] != label and 30 * -p <= 100 * -r[0] <= 90 * -p]
            for rank, (s, negative, _) in enumerate(sorted(fits)[:10], 1):
                out.append((a, positive, rank, negative, -p, -s))
    return sorted(out)


def license_words(text: str | None) -> list[bytes]:
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[0-9a-z\x80-\xff]+", lower)


def aligned(template: list[bytes], own: list[bytes]) -> int:
    """Matched words of a best alignment of a template anywhere in a text."""
    best = [(0, 0)] * (len(own) + 1)  # score, matches
    for i, word in enumerate(template):
        row = [(best[0][0] - 1, best[0][1])]
        for j, other in enumerate(own):
            score, matched = best[j]
            both = (score + 2, matched + 1) if word == other else (score - 1, matched)
            row.append(max(both, (best[j + 1][0] - 1, best[j + 1][1]), (row[j][0] - 1, row[j][1])))
        best = row
    return max(best)[1]


def licenses_of(rows, templates, coverage: float):
    """Pairs (doc_id, template) found by aligning whole texts, without an index.

    Templates of which a text has too few words, in any order, are left out first.
    """
    found = set()
    sought = [(name, license_words(text)) for name, text in templates]
    for doc, text in rows:
        own = license_words(text)
        counts = Counter(own)
        for name, words_ in sought:
            most = sum((counts & Counter(words_)).values())
            if words_ and most >= coverage * len(words_) and aligned(words_, own) >= coverage * len(words_):
                found.add((doc, name))
    return found
