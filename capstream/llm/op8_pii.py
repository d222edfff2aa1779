"""Personal data by fixed patterns and a semi-Markov conditional random field.

The base spans are those of four patterns with checks (digits, ranges, Luhn). Where the text holds
further digits or signs of an address that no base span covers, a semi-Markov CRF splits the tokens
around them into segments: entity segments of at most MAX_TOKENS tokens, typed, and single other
tokens. Features score whole spans (the pattern of digit groups and separators, number of digits,
Luhn, ranges, what stands left and right, cue words before it), and dynamic programming over bounded
entities picks boundaries and types together. It finds addresses written with [at] and [dot] and
numbers without the country's plus, for instance. Its spans are added where they overlap no base span.

There are no labels for personal data in the tables, so the CRF is trained here on a bounded set of
generated examples (EXAMPLES of them, fixed seed), by the gradient of its exact likelihood.

Scale: one pass without a shuffle; the model (a few thousand weights) goes along with the tasks. The
patterns are run so that no text, however long or odd, costs more than its length. The CRF sees every
stretch with signs, however many or long, in windows of STRETCH_TOKENS tokens that overlap by the tokens of two
entities; a window keeps the entities that start in its middle, so that none is cut. Spans that can't be an
entity are left early, and scores of repeated spans are kept.

Null text is an empty one and has no spans. Null doc_id and repeated rows are handled like any
other. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from capstream.llm.common import table

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, CONTEXT_TOKENS, EXAMPLES, EPOCHS, RATE, DECAY = 16, 4, 480, 6, 0.3, 1e-4
#: Stretches are searched in windows of so many tokens; an entity has MAX_TOKENS at most.
STRETCH_TOKENS = 256
#: Scores of spans that are kept, as lists of numbers often repeat theirs; longer spans are not kept.
KEPT_SCORES, KEPT_CHARACTERS = 1 << 15, 128

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's place, start, end), by kind and then start."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            found.append((0, start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
                found.append((1, m.start(), m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    found.append((3, m.start(), m.end()))
    return found


# --- the semi-Markov CRF

TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
#: What an entity needs at least; stretches without any of these hold none.
TRIGGER = re.compile(r"@|[\[({]\s?(?:at|AT)\s?[\])}]|[0-9]+(?:\.[0-9]+){3}|[0-9](?:[\x20().\-/]{0,3}[0-9]){8,}")
CUES = {
    "tel": "phone", "phone": "phone", "call": "phone", "fax": "phone", "mobile": "phone", "mail": "email", "email": "email",
    "contact": "email", "card": "card", "visa": "card", "credit": "card", "ip": "ip", "host": "ip", "server": "ip",
    "order": "other", "id": "other", "invoice": "other", "version": "other", "date": "other", "isbn": "other",
}


def tokens_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text)]


def _around(text: str, tokens: list[tuple[int, int]], i: int) -> str:
    if not 0 <= i < len(tokens):
        return "edge"
    t = text[tokens[i][0] : tokens[i][1]]
    return "digit" if t[0].isdigit() else "word" if t[0].isalpha() else t


def span_features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[str] | None:
    """Features of tokens i to j as one entity; None where they can't be one."""
    first, last = text[tokens[i][0]], text[tokens[j - 1][1] - 1]
    if not (first.isalnum() or first in "+(") or not last.isalnum():
        return None
    span = text[tokens[i][0] : tokens[j - 1][1]]
    digits = re.sub(r"[^0-9]", "", span)
    at = "@" in span or re.search(r"[\[({]\s?at\s?[\])}]", span, re.I) is not None
    if not at and len(digits) < 9 and span.count(".") < 3 or "\n" in span:
        return None
    shape = re.sub(r"[0-9]+", lambda m: str(len(m[0])), re.sub(r"[^\W\d_]+", "a", span))
    words = [text[a:b].lower() for a, b in tokens[max(0, i - 3) : i]]
    out = [f"shape={shape}", f"n={min(len(digits), 24)}", f"left={_around(text, tokens, i - 1)}", f"right={_around(text, tokens, j)}"]
    touching = tokens[i][0] > 0 and not text[tokens[i][0] - 1].isspace(), tokens[j - 1][1] < len(text) and text[tokens[j - 1][1]].isalnum()
    out += [f"touch={touching}", f"plus={first == '+'}", f"paren={'(' in span}", f"at={at}", f"gaps={len(re.findall(r'[^0-9]+', span))}"]
    out += [f"letters={bool(re.search(r'[^\W\d_]', span))}", f"at={at},spaces={min(3, span.count(' '))},dots={min(3, len(re.findall(r'[.]|dot', span)))}"]
    out += [f"sep={''.join(sorted(set(re.sub(r'[^-. /]', '', span))))}", f"even={len({len(g) for g in re.findall('[0-9]+', span)}) == 1}"]
    if 13 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", span):
        out.append(f"quad={all(len(p) < 4 and int(p) < 256 for p in span.split('.'))}")
    out += [f"cue={CUES[w]}" for w in words if w in CUES]
    return out


class SemiMarkov:
    """Weights of (type, feature); label 0 is a single other token, 1 to 4 the kinds."""

    def __init__(self, weights: dict | None = None):
        self.weights = weights if weights is not None else {}
        self.kept: dict[tuple, tuple[float, int] | None] = {}

    def lattice(self, text: str, tokens: list[tuple[int, int]]) -> list[list[tuple[int, int, list]]]:
        """For every end: (start, label, features) of the segments that end there."""
        ends: list[list[tuple[int, int, list]]] = [[] for _ in range(len(tokens) + 1)]
        for i in range(len(tokens)):
            a, b = tokens[i]
            kind = _around(text, tokens, i)
            ends[i + 1].append((i, 0, [(0, kind), (0, f"len={min(b - a, 20)}", kind)]))
            for j in range(i + 1, min(len(tokens), i + MAX_TOKENS) + 1):
                features = span_features(text, tokens, i, j)
                if features:
                    ends[j] += [(i, y, [(y, f) for f in features] + [(y, "bias"), ("entity", f"tokens={j - i}")]) for y in range(1, 5)]
        return ends

    def value(self, features: list) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features)

    def best_type(self, text: str, tokens: list[tuple[int, int]], i: int, j: int, cues: tuple) -> tuple[float, int] | None:
        """The highest score of tokens i to j as an entity and its label, or None where they can't be one."""
        low, high = tokens[i][0], tokens[j - 1][1]
        key = None
        if high - low <= KEPT_CHARACTERS:  # all that span_features looks at
            touching = low > 0 and not text[low - 1].isspace(), high < len(text) and text[high].isalnum()
            key = text[low:high], j - i, touching, _around(text, tokens, i - 1), _around(text, tokens, j), cues
            if key in self.kept:
                return self.kept[key]
        found, features = None, span_features(text, tokens, i, j)
        if features:
            more = ("entity", f"tokens={j - i}")
            found = max(((self.value([*((y, f) for f in features), (y, "bias"), more]), y) for y in range(1, 5)), key=lambda b: b[0])
        if key:
            if len(self.kept) >= KEPT_SCORES:
                self.kept.clear()
            self.kept[key] = found
        return found

    def decode(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(kind's place, start, end) of the best split's entities."""
        n = len(tokens)
        best: list[tuple[float, tuple | None]] = [(0.0, None)] + [(-math.inf, None)] * n
        for i, (a, b) in enumerate(tokens):
            score, kind = best[i][0], _around(text, tokens, i)
            other = score + self.value([(0, kind), (0, f"len={min(b - a, 20)}", kind)])
            if other > best[i + 1][0]:
                best[i + 1] = other, (i, 0)
            if not (text[a].isalnum() or text[a] in "+("):
                continue
            cues = tuple(CUES[w] for w in (text[x:y].lower() for x, y in tokens[max(0, i - 3) : i]) if w in CUES)
            for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
                if text[tokens[j - 1][1] - 1].isalnum():
                    found = self.best_type(text, tokens, i, j, cues)
                    if found and score + found[0] > best[j][0]:
                        best[j] = score + found[0], (i, found[1])
        out, j = [], n
        while j:
            i, y = best[j][1]
            if y:
                out.append((y - 1, tokens[i][0], tokens[j - 1][1]))
            j = i
        return out[::-1]

    def step(self, lattice: list, gold: set[tuple[int, int, int]], rate: float) -> None:
        """One step along the gradient of the log likelihood of the gold segments (start, end, label)."""
        n = len(lattice) - 1
        score = [[self.value(f) for _, _, f in ends] for ends in lattice]
        forward, backward = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for j in range(1, n + 1):
            forward[j] = _log_sum([forward[i] + s for (i, _, _), s in zip(lattice[j], score[j], strict=True)])
        incoming: list[list[float]] = [[] for _ in range(n + 1)]
        for j in range(n, 0, -1):
            if j < n:
                backward[j] = _log_sum(incoming[j])
            for (i, _, _), s in zip(lattice[j], score[j], strict=True):
                incoming[i].append(s + backward[j])
        for j in range(1, n + 1):
            for (i, y, features), s in zip(lattice[j], score[j], strict=True):
                gap = ((i, j, y) in gold) - math.exp(min(0.0, forward[i] + s + backward[j] - forward[n]))
                if abs(gap) > 1e-4:
                    for f in features:
                        self.weights[f] = self.weights.get(f, 0.0) * (1 - DECAY) + rate * gap


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


def _examples(n: int, rng: random.Random) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Generated texts and their entities: (kind's place, start, end)."""
    word = lambda: "".join(rng.choice("abcdefghilmnorstuv") for _ in range(rng.randint(2, 8)))
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card(valid: bool) -> str:
        while True:
            d = digits(rng.choice((16, 16, 16, 15, 14, 13)))
            if luhn(d) == valid:
                sep = rng.choice(("", " ", "-", ".", " ", "-"))
                return sep.join(d[i : i + 4] for i in range(0, len(d), 4))

    def entity() -> tuple[int, str]:
        kind = rng.randrange(4)
        if kind == 0:
            at, dot = rng.choice((("@", "."), ("@", "."), (" [at] ", " [dot] "), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]")))
            name = rng.choice((word(), word() + rng.choice("._-") + word(), word() + digits(2), word() + "." + digits(2)))
            return 0, name + at + word() + rng.choice(("", digits(1))) + dot + rng.choice(("com", "org", "net", "de", word()))
        if kind == 1:
            return 1, ".".join(str(rng.randrange(256)) for _ in range(4))
        if kind == 2:
            return 2, card(True)
        a, b, c = digits(3), digits(3), digits(4)
        form = rng.choice(("+{p} ({a}) {b}-{c}", "+{p} {a} {b} {c}", "+{p}-{a}-{b}-{c}", "({a}) {b}-{c}", "{a}-{b}-{c}", "{a}.{b}.{c}", "00{p} {a} {b} {c}", "+{p}{a}{b}{c}"))
        return 3, form.format(p=rng.choice(("1", "44", "49", "33", "34")), a=a, b=b, c=c)

    def other() -> str:
        return rng.choice(
            (
                lambda: f"{rng.randint(1900, 2030)}-{digits(2)}-{digits(2)}", lambda: f"{digits(2)}/{digits(2)}/{rng.randint(1900, 2030)}",
                lambda: f"{digits(1)}.{digits(1)}.{digits(1)}", lambda: f"{rng.randint(256, 999)}.{rng.randint(256, 999)}.{digits(3)}.{rng.randint(256, 999)}",
                lambda: card(False), lambda: digits(rng.randint(1, 12)), lambda: f"order {digits(10)}", lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
                lambda: f"isbn {digits(3)}-{digits(1)}-{digits(5)}-{digits(3)}-{digits(1)}", lambda: f"{digits(4)}-{digits(4)}-{digits(4)}", lambda: f"@{word()}",
                lambda: f"{digits(2)}:{digits(2)}:{digits(2)} {digits(3)} {digits(4)}", lambda: f"{word()}@{word()}", lambda: f"${digits(3)}.{digits(2)}", lambda: f"{digits(24)}",
            )
        )()

    cues = {0: ("mail", "contact", "email"), 1: ("host", "server", "ip"), 2: ("card", "visa"), 3: ("tel", "call", "phone")}
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 2)):
            text += " ".join(word() for _ in range(rng.randint(0, 3))) + " "
            if rng.random() < 0.5:
                kind, body = entity()
                text += f"{rng.choice(cues[kind])}{rng.choice((':', ''))} " * (rng.random() < 0.3)
                spans.append((kind, len(text), len(text) + len(body)))
            else:
                body = other()
            text += body + rng.choice(("", "", ".", ",")) + " "
        out.append((text + " ".join(word() for _ in range(rng.randint(0, 3))), spans))
    return out


@lru_cache(maxsize=4)
def trained(examples: int = EXAMPLES, epochs: int = EPOCHS, seed: int = 8) -> SemiMarkov:
    """A CRF fitted to generated examples; takes some seconds, once in a driver process."""
    rng, model, ready = random.Random(seed), SemiMarkov(), []
    for text, spans in _examples(examples, rng):
        tokens = tokens_of(text)
        starts, ends = {t[0]: i for i, t in enumerate(tokens)}, {t[1]: i + 1 for i, t in enumerate(tokens)}
        gold = {(starts[a], ends[b], k + 1) for k, a, b in spans if a in starts and b in ends}
        covered = {i for a, b, _ in gold for i in range(a, b)}
        ready.append((model.lattice(text, tokens), gold | {(i, i + 1, 0) for i in range(len(tokens)) if i not in covered}))
    for epoch in range(epochs):
        rng.shuffle(ready)
        for lattice, gold in ready:
            model.step(lattice, gold, RATE / (1 + epoch))
    model.weights = {f: w for f, w in model.weights.items() if abs(w) > 1e-3}
    return model


def added_spans(text: str, base: list[tuple[int, int, int]], model: SemiMarkov) -> list[tuple[int, int, int]]:
    """What the CRF finds around triggers that no base span covers."""
    taken = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    stretches: list[list[int]] = []
    k = 0
    for m in TRIGGER.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] <= m.start() and m.end() <= taken[k][1]:
            continue
        low, high = max(0, m.start() - 96), min(len(text), m.end() + 96)
        if stretches and low <= stretches[-1][1]:
            stretches[-1][1] = high
        else:
            stretches.append([low, high])
    out: list[tuple[int, int, int]] = []
    step = STRETCH_TOKENS - 2 * MAX_TOKENS
    for low, high in stretches:
        part = text[low:high]
        tokens = tokens_of(part)
        for at in range(0, max(1, len(tokens) - 2 * MAX_TOKENS), step):
            window = tokens[at : at + STRETCH_TOKENS]
            first = window[MAX_TOKENS][0] if at else 0
            end = window[STRETCH_TOKENS - MAX_TOKENS][0] if at + STRETCH_TOKENS < len(tokens) else len(part)
            for kind, a, b in model.decode(part, window):
                inside, a, b = first <= a < end, a + low, b + low
                before = bisect_left(starts, b)
                if inside and not (before and reach[before - 1] > a) and not (out and out[-1][2] > a):
                    out.append((kind, a, b))
    return out


def spans_of(text: str, model: SemiMarkov) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans, both by kind and then start."""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, model)) if TRIGGER.search(text) else base


_RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame) -> DataFrame:
    """doc_id, numbers of base spans by kind, digest of the base spans, all spans."""
    rows = docs.select("doc_id", "text")
    weights = trained().weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(weights)
        join = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
        for batch in batches:
            counts, digests, found = [], [], []
            for text in batch.column("text").to_pylist():
                base, spans = spans_of(text or "", model)
                counts.append([sum(s[0] == k for s in base) for k in range(4)])
                digests.append(hashlib.sha256(join(base).encode()).hexdigest())
                found.append(join(spans))
            columns = [*[pa.array([c[k] for c in counts], pa.int64()) for k in range(4)], pa.array(digests, pa.string()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *[x.split()[0] for x in _RESULT.split(", ")]])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {_RESULT}")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))


QUERIES = {"op8_pii": op8_pii}
ORACLE_SQL: dict[str, str] = {}
