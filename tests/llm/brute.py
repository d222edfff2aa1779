"""Plain Python versions of what the operators say they do."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text):
    return len(re.findall(WORD, text or ""))


def targets(sizes: dict, weights=(1, 2, 3), cap=3):
    """By the rule's own words: stop at the cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else share[s] for s in names}
        full |= over


def mixed(docs, block_words=2048, corpus_blocks=2**17, source_blocks=256, seed=4):
    """Of docs(doc_id, text, source): ({place: (taken, first, last)}, [(place, words)] in the order of the mix), word by word."""
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += n_words(text)
    want, total = targets(dict(sizes)), sum(sizes.values())
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    blocks_of, slots_of, block_of = {}, {}, {}
    for s in names:
        block = min(max(1, min(block_words, total // corpus_blocks)), max(1, math.floor(min(sizes[s], want[s]) / source_blocks)))
        block_of[s], blocks_of[s] = block, -(-sizes[s] // block)
        slots_of[s] = math.floor(want[s] * blocks_of[s] / sizes[s] + 0.5) if sizes[s] else 0
    bits = max(1, sum(slots_of.values()) - 1).bit_length()
    places, stats, rows = 0, defaultdict(lambda: [0, None, None]), []
    for s in names:
        times = sorted(int(f"{p:0{bits}b}"[::-1], 2) for p in range(places, places + slots_of[s]))
        places += slots_of[s]
        key = lambda i: (hashlib.md5(f"{seed}:{'' if docs[i][0] is None else docs[i][0]}".encode()).hexdigest(), docs[i][0] is not None, docs[i][0] or 0, n_words(docs[i][1]))
        own = sorted((i for i, d in enumerate(docs) if d[2] == s), key=key)
        owner = [i for i in own for _ in range(n_words(docs[i][1]))]
        for rank, time in enumerate(times):
            epoch, at = divmod(rank, blocks_of[s])
            part = owner[at * block_of[s] : (at + 1) * block_of[s]]
            for i in dict.fromkeys(part):
                stats[i][0] += part.count(i)
                stats[i][1] = time if stats[i][1] is None else min(stats[i][1], time)
                stats[i][2] = time if stats[i][2] is None else max(stats[i][2], time)
                if owner.index(i) >= at * block_of[s]:  # the slot takes its first word
                    until = min(len(owner), (min(blocks_of[s], len(times) - epoch * blocks_of[s])) * block_of[s])
                    rows.append((time, owner.index(i), i, min(owner.index(i) + owner.count(i), until) - owner.index(i)))
    return dict(stats), [(i, n) for _, _, i, n in sorted(rows)]


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def near_groups(texts):
    """For every text the smallest place of its group."""
    root, sets = list(range(len(texts))), [shingles(t) for t in texts]
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = sorted((root[i], root[j]))
                root = [x if r == y else r for r in root]
    return root


def holds(text, item, op):
    """Whether any stretch of the text is a match of the item, by the checks of operator 2 alone."""
    words, sought, answer = (text or "").lower().split(), item.lower().split(), op.answer_of(item).lower().split()
    if 0 < len(sought) < op.MIN_WORDS:
        return any(words[a : a + len(sought)] == sought for a in range(len(words)))
    if not sought:
        return False

    def share(part, of):
        where = op.places_of(of)
        return op.common_subsequence(len(of), [where[w] for w in part if w in where]) / len(of)

    if share(words, sought) < op.PARAPHRASE:  # no stretch has more
        return False
    parts = [words[a : a + 3 * len(sought)] for a in range(max(1, len(words) - len(sought)))]
    return any((s := share(p, sought)) >= op.NEAR or s >= op.PARAPHRASE and share(p, answer) >= op.ANSWER for p in parts)
