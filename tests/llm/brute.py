"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, k, num, den):
    """{id: (set size, smallest id reachable)}"""
    sets = {d: shingle_set(t, k) for d, t in rows}
    ids, up = sorted(sets), {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def removed(rows, k=50):
    """{id: (words, removed, digest)}"""
    first, words = {}, {d: WORD.findall(t or "") for d, t in rows}
    for d, w in words.items():
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone[i : i + k] = [True] * k
        out[d] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest())
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]  # noqa: B023
            if good():
                out.append((kind, m.start(), m.end()))
    return out


def targets(sizes, weights, cap=3.0):
    """Shares by weight, none above cap * size, by repeated resharing."""
    out, free = {}, set(sizes)
    left = float(sum(sizes.values()))
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over
    return out


def group(pairs):
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return out


def losses(texts, target):
    """(id, words, target loss, background loss, difference) of each text by plain counts, each text left out of its own model."""
    words = [(d, (t or "").split()) for d, t in texts]
    bigrams = [list(zip([None, *w], w, strict=False)) for _, w in words]
    vocab = {x for _, w in words for x in w} | {None}
    models = []
    for side in (True, False):
        m = ({}, {}, {}, [0])
        for (d, _), pairs in zip(words, bigrams, strict=True):
            for a, b in pairs if (d in target) == side else []:
                for table, key in zip(m, ((a, b), b, a, 0), strict=True):
                    table[key] = (table[key] if key in table or table is m[3] else 0) + 1
        models.append(m)
    least = min(m[3][0] for m in models)
    out = []
    for (d, w), pairs in zip(words, bigrams, strict=True):
        loss = []
        for side, m in zip((True, False), models, strict=True):
            own = (d in target) == side
            f, bits, total = least / max(m[3][0], 1), 0.0, m[3][0] - own * len(w)
            for a, b in pairs:
                count = lambda table, key, seen: m[table].get(key, 0) - own * seen  # noqa: B023, E731
                one = (f * count(1, b, w.count(b)) + 0.5) / (f * total + 0.5 * len(vocab))
                ctx = sum(1 for x, _ in pairs if x == a)
                bits -= math.log2((f * count(0, (a, b), pairs.count((a, b))) + 4 * one) / (f * count(2, a, ctx) + 4))
            loss.append(bits / len(w) if w else None)
        out.append((d, len(w), *loss, loss[0] - loss[1] if w else None))
    return out


STOP, NUMERIC = set("!.?:\n"), set("0123456789,./:-")


def fold(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or "\xc0" <= c <= "\xde" and c != "\xd7" else c for c in word)


def template_words(text, units, openers):
    """[(word, placeholder or None, placeholder if it opens a sentence as a name)] of a text."""
    core = re.compile(r"[0-9A-Za-z%\x80-\U0010ffff]")
    spans = []
    for m in WORD.finditer(text):
        at = [i for i in range(m.start(), m.end()) if core.match(text[i])]
        if not at:
            continue
        a, b = at[0], at[-1] + 1
        cut = a
        while cut < b and text[cut] in NUMERIC:
            cut += 1
        if text[a].isascii() and text[a].isdigit() and cut < b and fold(text[cut:b]) in units:
            number = [i for i in range(a, cut) if core.match(text[i])]
            spans += [(a, number[-1] + 1), (cut, b)]
        else:
            spans.append((a, b))
    out, last, was_number = [], None, False
    for a, b in spans:
        w = text[a:b]
        number = any(c in "0123456789" for c in w) and set(w) <= NUMERIC
        unit = was_number and not number and fold(w) in units
        capital = "A" <= w[0] <= "Z" or "\xc0" <= w[0] <= "\xde"
        named = capital and sum("A" <= c <= "Z" for c in w) <= 1 and not number and len(w.encode()) > 1
        opens = last is None or bool(STOP & set(text[last:a]))
        kind = "unit" if unit else "number" if number else "name" if named and not opens else None
        out.append((fold(w), kind, "name" if named and opens and not unit and fold(w) not in openers else kind))
        last, was_number = b, number
    return out


def template_forms(words, size, exact, literals):
    """{(first form, form): slot values seen} of all windows of this many words."""
    out = defaultdict(set)
    for i in range(len(words) - size + 1):
        part = words[i : i + size]
        if exact:
            form = ("exact", *[w for w, _, _ in part])
            out[form, form].add(())
            continue
        first = tuple(kind and ("slot", kind) or w for w, kind, _ in part)
        for which in {1, 2} if any(x[1] != x[2] for x in part) else {1}:
            slots = tuple(x[0] for x in part if x[which])
            if size - len(slots) >= min(literals, max(1, size // 2)):
                out[first, tuple(x[which] and ("slot", x[which]) or x[0] for x in part)].add(slots)
    return out


def leaked(docs, items, units, openers, order, k=6, literals=3, share=0.4):
    """{(doc_id, item_id): (windows, matched, consistent, verbatim)}; ``order`` ranks words where votes tie."""
    rank = lambda slots: [order(w) for w in slots]
    forms, shapes = {}, {(k, False)}
    for i, text in items:
        words = template_words(text or "", units, openers)
        size = min(k, len(words))
        if not words:
            continue
        found, exact = template_forms(words, size, False, literals), False
        if not found:
            found, exact = template_forms(words, size, True, literals), True
        shapes.add((size, exact))
        forms[i] = {key: min(v, key=rank) for key, v in found.items()}
    out = {}
    for d, text in docs:
        words, here = template_words(text or "", units, openers), defaultdict(set)
        for size, exact in shapes:
            for (_, form), slots in template_forms(words, size, exact, literals).items():
                here[form] |= slots
        for i, of in forms.items():
            met = [(win, a, b) for (win, form), a in of.items() for b in here.get(form, ())]
            wins, matched = {win for win, _ in of}, {win for win, _, _ in met}
            if not met or len(matched) < share * len(wins):
                continue
            best = [min(((a, b) for w, a, b in met if w == win), key=lambda x: (x[0] != x[1], rank(x[1]))) for win in matched]
            good = max(one_substitution(best, order), min(len(best), one_substitution([x[1:] for x in met], order)))
            if good >= share * len(wins):
                out[d, i] = (len(wins), len(matched), good, all(a == b for a, b in best))
    return out


def one_substitution(pairs, order):
    """How many pairs of slot values follow the one-to-one substitution that takes the pair of words with most votes first."""
    votes = defaultdict(int)
    for a, b in pairs:
        for xy in set(zip(a, b, strict=True)):
            votes[xy] += 1
    chosen = set()
    while votes:
        x, y = min(votes, key=lambda v: (-votes[v], v[0] != v[1], order(v[0]), order(v[1])))
        chosen.add((x, y))
        votes = {v: n for v, n in votes.items() if v[0] != x and v[1] != y}
    return sum(set(zip(a, b, strict=True)) <= chosen for a, b in pairs)


def passage_features(text, kinds, n_kinds, size, hashed, word_hash):
    """Features of each passage of a text, word by word."""
    raw = (text or "").encode()
    words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    said = [raw[a:b] for a, b in words]
    out = []
    for first in range(0, len(words), size):
        part = range(first, min(first + size, len(words)))
        body = raw[words[first][0] : words[first + size][0] if first + size < len(words) else len(raw)]
        n = len(part)
        row = [sum(kinds[c] == k for c in body) / len(body) for k in range(n_kinds)]
        row += [math.log1p(n) / 5, sum(len(said[i]) for i in part) / n / 10, sum(len(said[i]) == 1 for i in part) / n, sum(len(said[i]) > 20 for i in part) / n]
        row += [sum(i >= lag and said[i] == said[i - lag] for i in part) / n for lag in (1, 2, 3)]
        row.append(sum(65 <= said[i][0] <= 90 for i in part) / n)
        bins = [0] * hashed
        for i in part:
            h = word_hash(said[i])
            bins[(h >> 5) % hashed] += 1 - 2 * (h & 1)
        out.append(row + [x / n for x in bins])
    return out or [[0.0] * (n_kinds + 8 + hashed)]


def attention_score(rows, mean, scale, p):
    """The score of one bag of passages, with plain loops."""
    dot = lambda v, m, j: sum(float(a) * float(r[j]) for a, r in zip(v, m, strict=True))
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    hidden, weights = [], []
    for x in rows:
        z = [max(-8.0, min(8.0, (a - float(m)) / float(s))) for a, m, s in zip(x, mean, scale, strict=True)]
        h = [math.tanh(dot(z, p["W"], j) + float(p["b"][j])) for j in range(len(p["b"]))]
        hidden.append(h)
        weights.append(math.exp(sum(math.tanh(dot(h, p["V"], j)) * sigmoid(dot(h, p["U"], j)) * float(p["w"][j]) for j in range(len(p["w"])))))
    bag = [sum(a * h[j] for a, h in zip(weights, hidden, strict=True)) / sum(weights) for j in range(len(hidden[0]))]
    return sigmoid(sum(a * float(c) for a, c in zip(bag, p["c"], strict=True)) + float(p["d"][0]))
