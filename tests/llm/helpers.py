"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Nulls, blanks, ties, repeated rows, odd scripts.
EDGE_TEXTS = [None, "", " \n\t", "one", "one two three four five", "one two three four five", "ONE two three four five", "!?", "12 34", "日本語 の テキスト", "naïve café — déjà vu", "\x00\x1c", "a" * 3000, "ab " * 900, "<|endoftext|> x <|startoftext|>"]


def edge_docs(spark):
    """The edge texts with a null id, a repeated id, and extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en" if i % 2 else "fr", "src0", len(t or ""), 1, "x", True) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "a text without an id", None, None, None, 2, "y", False), (3, "one", "en", "src0", 3, 1, "x", True)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_bytes int, own string, kept boolean")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def near_duplicate_components(docs, percent=85):
    """doc_id -> smallest id reachable, by all pairs; ``docs`` are (id, text)."""
    sets = {i: shingle_set(t) for i, t in docs}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def without_repeats(texts, span=400):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) per text, by counting every window."""
    count = Counter()
    for t in texts:
        data = (t or "").encode()
        count.update(data[i : i + span] for i in range(len(data) - span + 1))
    out = []
    for t in texts:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - span + 1):
            if count[data[i : i + span]] > 1:
                gone[i : i + span] = True
        rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out
