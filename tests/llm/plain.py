"""Plain one-process versions of the training-data operators, for small inputs."""

import collections
import hashlib
import re

SF = "/root/testdata/sf0.001"
WS = " \t\n\x0b\x0c\r"
LAST = 1 << 63


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def line_key(line):
    return lower(line.strip(WS))


def shingles(text, size):
    w = [lower(x) for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def components(rows, size, percent):
    """(id, set size, smallest id reachable) per (id, text) row."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = collections.defaultdict(list)
    for a, own in enumerate(sets):
        common = collections.Counter(b for s in own for b in having[s])
        for b, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[b]) - n):
                parent[root(a)] = root(b)
        for s in own:
            having[s].append(a)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[root(a)] = min(least.get(root(a), LAST), LAST if i is None else i)
    return [(i, len(sets[a]), i if not sets[a] else least[root(a)]) for a, (i, _) in enumerate(rows)]


def substrings(rows, window=13):
    order = lambda d: LAST if d is None else d
    first = {}
    split = [(d, words(t)) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, LAST + 1), order(d))
    out = []
    for d, w in split:
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < order(d) for j in range(i, i + window)}
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 12, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if low <= len(d) <= high and (kind == "phone" or luhn(d)):
                out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], ("email", "ip", "card", "phone").index(x[0])))


def base_counts(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again))


def quality(rows, min_docs=20, min_share=0, keep_percent=30):
    """Verdict per (id, host, text) row."""
    hosts, having = collections.defaultdict(set), collections.defaultdict(set)
    for _, h, t in rows:
        hosts[h].add(t or "")
        for k in {line_key(x) for x in (t or "").split("\n") if words(x)}:
            having[h, k].add(t or "")
    out = []
    for _, h, t in rows:
        n, *_, again = base_counts(t)
        lost = sum(len(words(x)) for x in (t or "").split("\n") if words(x)
                   and len(having[h, line_key(x)]) >= min_docs and 100 * len(having[h, line_key(x)]) >= min_share * len(hosts[h]))
        out.append(not (n < 50 or 100 * again > 50 * n) and 100 * (n - lost) >= keep_percent * n)
    return out


def cut_lines(rows, min_docs=10, keep="none"):
    """Kept lines (or None for no loss) per (id, text) row."""
    having, first = collections.defaultdict(set), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        for p, x in enumerate((t or "").split("\n")):
            if k := line_key(x):
                having[k].add(d)
                first.setdefault(k, (d, p))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        out.append([x for p, x in enumerate(lines) if not (line_key(x) and len(having[line_key(x)]) >= min_docs
                                                           and not (keep == "first" and first[line_key(x)] == (d, p)))])
    return out


def leak(text, items, percent=80):
    """Items with a window of their own size at that weighted similarity (weights: 1 / items that have the shingle)."""
    own = [collections.Counter(_runs(i)) for _, i in items]
    df = collections.Counter(s for c in own for s in c)
    g = _runs(text)
    found = []
    for (item, t), c in zip(items, own):
        width = len(_runs(t))
        for s in range(max(1, len(g) - width + 1)):
            x = collections.Counter(g[s:s + width])
            if not x.keys() & c.keys():
                continue
            w = lambda k: 1 / df[k] if df[k] else 1
            if 100 * sum(min(x[k], c[k]) * w(k) for k in x | c) >= (percent - 1e-9) * sum(max(x[k], c[k]) * w(k) for k in x | c):
                found.append(item)
                break
    return found


def _runs(text, size=5):
    w = [lower(x) for x in words(text)]
    return [tuple(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [tuple(w)] if w else []


def pipeline(rows, items):
    """(id, text) of the documents that reach the last stage, from (id, host, text) rows."""
    rows = [r for r, ok in zip(rows, quality(rows)) if ok]
    rows = [(d, t) for d, _, t in rows]
    cut = cut_lines(rows, keep="first")
    rows = [(d, "\n".join(k)) for (d, t), k in zip(rows, cut) if len(k) == len((t or "").split("\n")) or "\n".join(k).strip(WS)]
    rows = [r for r, (d, n, c) in zip(rows, components(rows, 5, 80)) if n == 0 or c == d]
    return [(d, t) for d, t in rows if not leak(t, items)]
