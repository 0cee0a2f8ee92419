"""Plain versions of the fixed parts of the operators, and rows that trip up careless code."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def crc(key, fold):
    return zlib.crc32(str(key).encode()) % fold


def edge_rows():
    """(doc_id, text, lang, source, n_chars, and columns whose names the operators use themselves)."""
    long = "alpha beta gamma delta " * 20000
    texts = [None, "", " \t\n", "word", "word", "two words", "Ünï çødé 日本 🙂 a\x00b", "x" * 200_000, long, long,
             "a\nb\n\na\nb\n", "same text here " * 30, "same text here " * 30]
    rows = [(i, t, "en", "s", 1, 7, 0.5, "k", True) for i, t in enumerate(texts)]
    rows += [(5, "two words", "en", "s", 1, 7, 0.5, "k", True)] * 2  # repeated rows
    rows += [(None, "null key", None, None, None, None, None, None, None)] * 2
    return rows


EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, score double, "
               "key string, kept boolean")


def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


def quality(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)]


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w)} if len(w) == 1 else set(zip(w, w[1:]))


def near_groups(rows, percent=80):
    """Smallest key reachable, by all pairs."""
    sets = {}
    for k, t in rows:
        sets.setdefault(k, shingles(t))
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def secrets(text):
    t, out = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for k, (p, n) in enumerate(((r"AKIA[A-Z0-9]+", 20), (r"[0-9a-f]+", 24)), 1):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, t) if len(m[0]) >= n]
    return sorted(out)


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
