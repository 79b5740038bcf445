"""Plain Python versions of what the operators compute, for small inputs."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def line_units(line, reach=3, longest=32):
    """[(start, end, normal form)] over the line's characters."""
    found = [(m.start(), low(m.group())) for m in SPACED.finditer(line)]
    sums = [hashlib.md5(w.encode()).digest()[:8] for _, w in found]
    starts = []
    for i, own in enumerate(sums):
        around = sums[max(0, i - reach):i] + sums[i + 1:i + 1 + reach]
        if i == 0 or all(own < x for x in around) or (i - starts[-1]) % longest == 0:
            starts.append(i)
    out = []
    for a, z in zip(starts, [*starts[1:], len(found)]):
        out.append((0 if a == 0 else found[a][0], len(line) if z == len(found) else found[z][0],
                    tuple(w for _, w in found[a:z])))
    return out


def line_dedup(rows, words=24, size=200):
    """{doc_id: (units, removed, text left)} for rows in rank order, ids unique."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = [] if text is None else text.split("\n")
        units = [(k, *u) for k, line in enumerate(lines) for u in line_units(line)]
        again = []
        for u in units:
            again.append(u[3] in seen)
            seen.add(u[3])
        gone = [False] * len(units)
        for flag, run in itertools.groupby(range(len(units)), again.__getitem__):
            run = list(run)
            if flag and (sum(len(units[r][3]) for r in run) >= words
                         or sum(len(" ".join(units[r][3]).encode()) for r in run) >= size):
                for r in run:
                    gone[r] = True
        kept = []
        for k, line in enumerate(lines):
            mine = [(u, g) for u, g in zip(units, gone) if u[0] == k]
            if not mine or not all(g for _, g in mine):
                kept.append("".join(line[u[1]:u[2]] for u, g in mine if not g) if mine else line)
        out[i] = len(units), sum(gone), None if text is None else "\n".join(kept)
    return out


def contamination(text, items, window=10):
    """(n_words, n_hit, sorted item ids)."""
    w, hit, found = WORD.findall(low(text)), set(), set()
    for item, body in items:
        x = WORD.findall(low(body))
        n = min(window, len(x))
        grams = {tuple(x[k:k + n]) for k in range(len(x) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if tuple(w[k:k + n]) in grams:
                hit.update(range(k, k + n))
                found.add(item)
    return len(w), len(hit), sorted(found)


def byte_dedup(rows, length=100):
    """{doc_id: (bytes, removed, spans, bytes left)}."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = [True] * length
            seen.add(s)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def repeat_cover(words, size):
    """Words inside windows of ``size`` that occur twice or more."""
    count = Counter(tuple(words[k:k + size]) for k in range(len(words) - size + 1))
    return len({q for k in range(len(words) - size + 1)
                if count[tuple(words[k:k + size])] > 1 for q in range(k, k + size)})


def shingle_set(text, size=5):
    w = SPACED.findall(low(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(max(len(w) - size, 0) + 1))


def near_components(rows, percent=75):
    """{doc_id: (set size, least id reachable)}."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = top(a), top(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def top_k(rows, queries, k=5, scale=256):
    """(query id, rank, id, score) for (id, vector) rows, in order."""
    def whole(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and whole(v)]
    out = []
    for i, q in sorted({(i, tuple(v)) for i, v in kept if queries(i)}):
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in kept
                      if j != i and len(v) == len(q))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(best[:k], 1)]
    return sorted(out)


def audit(rows, labels):
    """The rows of the filter audit, every order simulated document by document."""
    facts = []
    for i, text, part in rows:
        text = text or ""
        w = SPACED.findall(text)
        fails = "".join(f for f, x in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w),
            100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text),
            any(i is not None and j is not None and j < i and (t or "") == text for j, t, _ in rows))) if x)
        facts.append((part or "", fails, (i, "quality") in labels, (i, "toxic") in labels))
    out = {}
    for part in {f[0] for f in facts}:
        mine, worth = [f for f in facts if f[0] == part], Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                worth[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] for x in mine) - len(gone),
                    sum(x[1] == f for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone), f]
        for (p, _, _), v in out.items():
            if p == part:
                v[-1] = worth[v[-1]]
    return sorted((*k, *v) for k, v in out.items())


def spelling(rows, every=199, least=5):
    """(word, form, root, n, n_near, form_n) by cutting out every letter."""
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= least}
    holes, near = {}, {w: set() for w in n}
    for w in n:
        for k in range(len(w)):
            holes.setdefault((w[:k], w[k + 1:]), set()).add(w)
            if (x := w[:k] + w[k + 1:]) in n:
                near[w].add(x)
                near[x].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {w: min(x, key=lambda o: (-n[o], o)) for w, x in near.items() if x}
    form = {w: f for w, f in form.items() if n[f] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, form.get(w) or "", root(w), n[w], len(near[w]), n.get(form.get(w), 0)) for w in n)


def maximal_repeats(words, least):
    """Per place the longest maximal repeated substring of ``least`` words or
    more that starts there (0 if none): no occurrence count survives a word more
    on either side."""
    n, out = len(words), [0] * len(words)
    for size in range(least, n):
        places = {}
        for k in range(n - size + 1):
            places.setdefault(tuple(words[k:k + size]), []).append(k)
        for at in places.values():
            before = {words[k - 1] if k else None for k in at}
            after = {words[k + size] if k + size < n else None for k in at}
            if len(at) > 1 and len(before) > 1 and len(after) > 1:
                for k in at:
                    out[k] = size
    return out


def gru_log10(p, ids, size, units):
    """log10 probability of each word id after those before it, number by number."""
    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    def log_softmax(scores, k):
        top = max(scores)
        return scores[k] - top - math.log(sum(math.exp(x - top) for x in scores))

    h, out = [0.0] * units, []
    for given, target in zip([-1, *ids], ids):
        a = [float(x) for x in p["embed"][given]]
        s = [sum(h[i] * float(p["state"][i][j]) for i in range(units)) for j in range(3 * units)]
        r = [sigmoid(a[i] + s[i]) for i in range(units)]
        z = [sigmoid(a[units + i] + s[units + i]) for i in range(units)]
        n = [math.tanh(a[2 * units + i] + r[i] * s[2 * units + i]) for i in range(units)]
        h = [(1 - z[i]) * n[i] + z[i] * h[i] for i in range(units)]
        c, w = divmod(target, size)
        log = log_softmax([float(p["class_b"][k]) + sum(h[i] * float(p["class_w"][i][k]) for i in range(units))
                           for k in range(size + 1)], c)
        if c < size:
            log += log_softmax([float(p["word_b"][c][k]) + sum(h[i] * float(p["word_w"][c][i][k])
                                                               for i in range(units)) for k in range(size)], w)
        out.append(log / math.log(10))
    return out


def regularised_leader(rows, epochs, alpha, beta, l1, l2):
    """Weights {feature: weight} after follow-the-regularised-leader updates on
    ({feature: value}, label) rows."""
    z, n = Counter(), Counter()

    def weight(f):
        if abs(z[f]) <= l1:
            return 0.0
        return -(z[f] - math.copysign(l1, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    for _ in range(epochs):
        for values, label in rows:
            w = {f: weight(f) for f in values}
            p = 1 / (1 + math.exp(-sum(w[f] * v for f, v in values.items())))
            for f, v in values.items():
                g = (p - label) * v
                step = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / alpha
                z[f] += g - step * w[f]
                n[f] += g * g
    return {f: weight(f) for f in z}


def quality_features(text):
    """{n-gram: value} of words and word shapes, and the bias."""
    raw = SPACED.findall(text or "")
    shapes = []
    for w in raw:
        kinds = ["A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or ord(c) > 127
                 else "0" if "0" <= c <= "9" else c for c in w]
        shapes.append("".join(k for k, _ in itertools.groupby(kinds)))
    count = Counter()
    for kind, units, most in (("word", [low(w) for w in raw], 2), ("shape", shapes, 3)):
        for n in range(1, most + 1):
            count.update((kind, *units[k:k + n]) for k in range(len(units) - n + 1))
    norm = max(math.sqrt(sum(c * c for c in count.values())), 1.0)
    return {**{f: c / norm for f, c in count.items()}, "bias": 1.0}
