"""The caption rules once more in plain Python, for samples (time, text, confidence, quality) of one video."""

from __future__ import annotations

import math
import re
import unicodedata
from difflib import SequenceMatcher
from itertools import pairwise

MEANINGFUL = re.compile("[A-Za-z0-9぀-ヿ㐀-鿿]")


def key_of(text):
    kept = "".join(c for c in text or "" if unicodedata.category(c)[0] in "LN")
    return kept.lower().replace("ß", "ss")


def length(text):
    return len(MEANINGFUL.findall(text or ""))


def readable(text):
    return "".join((text or "").split()) not in ("", "[unrecognized]", "[unabletorecognize]")


def alike(a, b, fuzzy=True):
    if not a or not b:
        return False
    if a in b or b in a:
        return True
    return fuzzy and SequenceMatcher(None, a, b).ratio() >= (0.88 if min(len(a), len(b)) >= 8 else 0.92)


def islands(samples, fuzzy=True):
    out, before = [], None
    for s in sorted(samples):
        own = key_of(s[1]) if readable(s[1]) else None
        if own is not None:
            if not out or before is None or not alike(before, own, fuzzy):
                out.append([])
            out[-1].append(s)
        before = own
    return out


def best_text(island, support=True):
    top = max(s[3] for s in island)
    credible = [s for s in island if s[2] >= 0.55 and s[3] >= top - 0.16]
    if not credible:
        return max(island, key=lambda s: (s[3] * 0.65 + s[2] * 0.35, length(s[1]), s[2], -s[0]))[1]
    longest = max(length(s[1]) for s in credible)
    credible = [s for s in credible if length(s[1]) == longest]
    members = [key_of(s[1]) for s in island]

    def backing(s):
        own = key_of(s[1])
        return sum(SequenceMatcher(None, own, m).ratio() for m in members) / len(members) if own else 0.0

    asked = support and len({key_of(s[1]) for s in credible}) > 1
    return max(credible, key=lambda s: (backing(s) if asked else 0.0, s[3], -s[0]))[1]


def segment(island, support=True):
    text, times = best_text(island, support), [s[0] for s in island]
    return {
        "start": times[0], "end": times[-1] + 3.0, "text": text.strip(), "confidence": math.fsum(s[2] for s in island) / len(island), "times": times,
        "how": "temporal_consensus" if len(island) > 1 else "direct_ocr", "others": [t for t in dict.fromkeys(s[1] for s in island) if t and t != text],
    }


def common(left, right):
    return next((n for n in range(min(12, len(left), len(right)), 0, -1) if left[-n:] == right[:n]), 0)


def joined(found):
    out = []
    for x in found:
        if out:
            last = out[-1]
            left, right = " ".join(last["text"].split()), " ".join(x["text"].split())
            n = common(left, right)
            merged = left + right[n:]
            if x["start"] - last["end"] <= 1.5 and last["text"].rstrip()[-1:] not in tuple(".!?。！？…") and n >= 2 and merged not in (left, right):
                a, b = len(last["times"]), len(x["times"])
                others = [t for t in dict.fromkeys([*last["others"], last["text"], *x["others"], x["text"]]) if t]
                out[-1] = {
                    "start": last["start"], "end": x["end"], "text": merged, "confidence": (last["confidence"] * a + x["confidence"] * b) / (a + b),
                    "times": last["times"] + x["times"], "how": "overlap_join", "others": others,
                }
                continue
        out.append(x)
    return out


def assembled(samples, fuzzy=True, support=True):
    found = [segment(i, support) for i in islands(samples, fuzzy)]
    kept = [s for s in found if length(s["text"]) > 1 or length(s["text"]) == 1 and s["confidence"] >= 0.72]
    out = joined(kept)
    for a, b in pairwise(out):
        a["end"] = min(a["end"], b["start"])
    stats = (len(samples), sum(readable(s[1]) for s in samples), sum(len(s["times"]) > 1 for s in kept), len(kept) - len(out), len(found) - len(kept))
    return out, stats
