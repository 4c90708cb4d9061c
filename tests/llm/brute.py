"""Plain Python versions of the operators, for small tables."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def backoff(docs, order, alpha, min_count):
    """{row number: log score} of texts."""
    split = [words(text) for text in docs]
    counts = Counter(
        tuple(w[i : i + n]) for w in split for n in range(1, order + 1) for i in range(len(w) - n + 1)
    )
    total = sum(map(len, split))

    def score(gram):
        if len(gram) == 1:
            return counts[gram] / total
        if counts[gram] >= min_count:
            return counts[gram] / counts[gram[:-1]]
        return alpha * score(gram[1:])

    return [
        sum(math.log(score(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(len(w))) for w in split
    ]


def shingle_set(text, size):
    w = words(text)
    if not w:
        return frozenset()
    size = min(size, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def jaccard_components(rows, size, percent):
    """{id: (n, component)} for rows (id, text) with ids that occur once."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(ids[x]), find(ids[y])))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def dedup_lines(rows, min_docs=2, min_chars=10):
    """{id: (n_lines, n_dropped, text)} for rows (id, text)."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[line_key(line)].add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(line_key(x)) < min_chars or len(holders[line_key(x)]) < min_docs or min(holders[line_key(x)]) == i
        ]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def warc(rows):
    first = {}
    for i, html in sorted(rows):
        first.setdefault(html or "", i)
    out = []
    for i, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        keeper = first[html or ""]
        out.append((i, len(data), digest, "response" if keeper == i else "revisit", None if keeper == i else keeper))
    return out


def shared_targets(sizes, weights=(1, 2, 3), repeat=3):
    """{source: words to take}; what caps leave over is shared anew until none is above."""
    ranked = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ranked)}
    targets, open_, left = {}, set(ranked), float(sum(sizes.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * unit > repeat * sizes[s]}
        if not above:
            return targets | {s: weight[s] * unit for s in open_}
        targets |= {s: float(repeat * sizes[s]) for s in above}
        open_ -= above
        left -= sum(targets[s] for s in above)
    return targets


def conversation_lists(rows):
    """{conv_id: [(role, text), ...]} of rows (conv_id, turn, role, text)."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [x[2:] for x in sorted(turns)] for conv, turns in found.items()}


def rebuilt_lists(lists):
    out = {}
    for conv, turns in lists.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = lists.get(conv - conv % 20, [])[:h] + turns[h:]
    return out


def trie_nodes(lists):
    """Rows of the trie as the operator returns them."""
    if not lists:
        return []
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in lists.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        cost = (len(convs) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += not children[node]
    return [
        (
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node],
            leaves[node], saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, convs in members.items()
    ]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k):
    """Rows (item_id, rank, doc_id, score) for docs (id, text) and items {id: text}."""
    split = [(i, Counter(terms(text))) for i, text in docs]
    split = [(i, tf) for i, tf in split if tf]
    count, total = len(split), sum(sum(tf.values()) for _, tf in split)
    df = Counter(term for _, tf in split for term in tf)
    out = []
    for item, text in items.items():
        scored = []
        for i, tf in split:
            m = 10 + (90 * sum(tf.values()) * count) // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in set(terms(text)) & set(tf)
            )
            if score > 0:
                scored.append((-score, i is None, i, score))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, rank, x[2], x[3]) for rank, x in enumerate(scored[:k], 1)]
    return out
