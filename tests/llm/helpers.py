"""Brute-force counterparts, and documents with all odd cases."""

import random
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = "part int, key string, kind string, bucket int, n_words string, _rank string, first string, label string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def frame(spark, rows, *, clash=False):
    """Rows of (doc_id, text), with columns named like those the operators make."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clash:
        for name, kind in (c.split(" ") for c in CLASHING.split(", ")):
            df = df.selectExpr("*", f"cast(7 as {kind}) as {name}")
    return df


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def odd_rows(seed=1, count=60, vocabulary=150):
    """Near and exact copies, shared passages, nulls, empty, blank, long and repeated texts, missing and repeated ids."""
    rnd = random.Random(seed)
    voc = [f"W{n}" if n % 3 else f"é{n}" for n in range(vocabulary)]
    base = [[rnd.choice(voc) for _ in range(rnd.randint(5, 60))] for _ in range(6)]
    rows = []
    for n in range(count):
        own = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 4)):
            own[rnd.randrange(len(own))] = rnd.choice(voc)
        text = rnd.choice([" ", "  ", "\n", "\t "]).join(own)
        rows.append((n, text if rnd.random() < 0.5 else text.lower()))
    rows += [
        (200, None), (201, ""), (202, " \n\t "), (203, "a b"), (204, "A  b"), (205, "b a"), (206, "x"),
        (None, rows[0][1]), (None, "z z z z z z z z z z z z z z z"), (None, None), (206, rows[1][1]),
        (7, rows[7][1]), (7, rows[7][1]), (300, " ".join(rnd.choice(voc) for _ in range(5000))),
        (301, "▁   　 日本 語 \U0001F642"),
    ]
    rnd.shuffle(rows)
    return rows


def repeated_words(rows, window):
    first = {}
    order = lambda d: (d is None, d or 0)
    for doc, text in rows:
        own = words(text)
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, order(doc)), order(doc))
    out = []
    for doc, text in rows:
        own = words(text)
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < order(doc):
                gone.update(range(i, i + window))
        out.append((doc, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return ordered(out)


def repeated_bytes(rows, length):
    count = Counter()
    for _, text in rows:
        data = (text or "").encode()
        count.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if count[data[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return ordered(out)


class Union:
    def __init__(self, count):
        self.up = list(range(count))

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        self.up[self.find(i)] = self.find(j)


def shingles(text, size=5):
    own = words((text or "").translate(LOWER))
    if len(own) < size:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def similar_groups(rows, percent=80):
    sets = [shingles(text) for _, text in rows]
    having, groups, ids = defaultdict(list), Union(len(rows)), {}
    for n, (doc, _) in enumerate(rows):
        for s in sets[n]:
            having[s].append(n)
        if doc is not None:
            groups.join(n, ids.setdefault(doc, n))
    for n, own in enumerate(sets):
        shared = Counter(m for s in own for m in having[s] if m < n)
        for m, c in shared.items():
            if 100 * c >= percent * (len(own) + len(sets[m]) - c):
                groups.join(n, m)
    least = {}
    for n, (doc, _) in enumerate(rows):
        if doc is not None:
            root = groups.find(n)
            least[root] = min(least.get(root, doc), doc)
    return ordered((doc, len(sets[n]), least.get(groups.find(n))) for n, (doc, _) in enumerate(rows))
