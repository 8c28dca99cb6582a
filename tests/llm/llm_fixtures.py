"""Awkward documents, and plain versions of what the operators compute."""

import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use for their own columns
    T.StructField("n_words", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("rank", T.IntegerType()),
])


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def awkward_rows(seed=5):
    """Texts: null, empty, blank, one word, ties, copies, near copies, a shared passage, a very long one, odd characters."""
    rng = random.Random(seed)
    base, passage = prose(rng, 150), prose(rng, 40)
    texts = [None, "", " \n\t ", "one", "Two words", "two WORDS", "Été ΣΣ İ 日本 <|endoftext|> \u0085x\x1cy", base, base, base, base.upper()]
    for k in range(12):
        words = base.split()
        for _ in range(k):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10 ** 6)}"
        texts.append(" ".join(words))
    for _ in range(25):
        texts.append(prose(rng, rng.randrange(1, 200)) + (" " + passage if rng.random() < 0.4 else "") + "\n" + prose(rng, 12))
    texts += ["a b c d e f " * 30, "% # $ junk " * 20, "same line\nsame line\nother\n\n same line ", prose(rng, 30000, 20000)]
    texts += ["footer of the site\n" + prose(rng, 30) for _ in range(15)]
    rows = [(i * 3 + 1, t, [None, "en", "fr"][i % 3], [None, "s1", "hot", "hot"][i % 4], None if t is None else len(t), "x", "y", 0) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def plain_substrings(rows, window=20):
    seen, out = set(), {}
    for i, w in sorted((r[0], (r[1] or "").encode().split()) for r in rows):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            if x in seen:
                gone[k:k + window] = [True] * window
            seen.add(x)
        kept = b" ".join(a for a, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def plain_near(rows, width=2, percent=80):
    """doc_id -> (shingles, least id of the component), by all pairs that share a shingle."""
    sets, up = {}, {}
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets[r[0]] = frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
        up[r[0]] = r[0]

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, common in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def plain_lines(rows, percent=10):
    """doc_id -> text without the boilerplate lines of its source."""
    blank = " \t\x0b\x0c\r"
    pages, hold = Counter(r[3] for r in rows), Counter()
    for r in rows:
        hold.update({(r[3], x.strip(blank)) for x in (r[1] or "").split("\n") if x.strip(blank)})
    bad = {k for k, n in hold.items() if n > 1 and 100 * n > percent * pages[k[0]]}
    return {r[0]: None if r[1] is None else "\n".join(x for x in r[1].split("\n") if (r[3], x.strip(blank)) not in bad) for r in rows}
