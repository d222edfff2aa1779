"""Removal of repeated passages with suffix arrays built by linear Lyndon grouping.

A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller doc_id. To
share such a string, two documents must agree in its anchor: the K bytes in it with the least
hash. So strings are compared only where anchors are equal:

1. Every part of the documents sends the hashes of its anchors; those found in two documents or more return.
2. For these it sends the contexts: the stretch of text whose strings have the anchor, equal ones
   once, with the smallest document.
3. Per anchor, different contexts are compared by the suffix array of all of them laid end to end
   (see suffixes.py): equal strings stand next to each other in it, and take the smallest
   document of all. One context alone needs no comparing.
4. The answers return to the parts, which cover the bytes and keep the rest.

Hashes only choose what is compared; comparisons are of bytes, so collisions cost time, not results.

Scale: documents are shuffled once, by part, and that exchange serves all three passes; what else
moves is 4 bytes for each anchor (some 13 bytes of text), and the contexts of repeated ones.
Everything is folded within a part before it moves, so a passage that a third of all documents
hold arrives once per part. Parts and buckets are bounded by PART_BYTES of text. An anchor with many
different contexts is split by where in the string it stands, as often as needed, until few are left.

Null text is empty: nothing is removed. Documents with null doc_id come after all others, and rows
with the same doc_id don't count as repeats of each other. Texts under LENGTH bytes stay whole.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm.common import table
from capstream.llm.suffixes import suffix_arrays

LENGTH, K = 50, 26
PART_BYTES, SLICE_BYTES = 8 << 20, 1 << 18
#: Symbols of a text given to the suffix sorter, of all texts given at once, and of one anchor before it is split.
TEXT_SYMBOLS, BATCH_SYMBOLS, ANCHOR_SYMBOLS = 2000, 1 << 20, 6000
NO_ID = 2**63 - 1
_PLACES, _FEW = np.uint64((1 << 20) - 1), np.uint64((1 << 22) - 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    step, back = np.uint64(0x5851F42D4C957F2D), np.uint64(pow(0x5851F42D4C957F2D, -1, 2**64))
    return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x, np.uint64))]) for x in (step, back))


class Part:
    """The documents of a part, in order of doc_id, and their anchors."""

    _forth, _back = _powers(SLICE_BYTES + LENGTH)

    def __init__(self, docs: pa.Table):
        rows = zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=True)
        rows = sorted(((NO_ID if d is None else d, d is None, (t or "").encode("utf-8", "surrogatepass")) for d, t in rows))
        self.ids = [None if none else d for d, none, _ in rows]
        self.order = np.array([d for d, _, _ in rows], np.int64)
        self.whole = b"".join(r[2] for r in rows)
        self.bytes = np.frombuffer(self.whole, np.uint8)
        self.ends = np.cumsum([len(r[2]) for r in rows], dtype=np.int64)
        self.starts = self.ends - np.array([len(r[2]) for r in rows], np.int64)
        self.inside = np.ones(len(self.bytes), bool)
        for low, high in zip(np.maximum(self.starts, self.ends - LENGTH + 1).tolist(), self.ends.tolist(), strict=True):
            self.inside[low:high] = False
        found = [self._anchors(at) for at in range(0, max(0, len(self.bytes) - LENGTH + 1), SLICE_BYTES)]
        #: Hash of the anchor, its place, the first and last start of a string that has it, and the document.
        self.hash, self.place, self.low, self.high, self.doc = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (
            np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 4,
        )

    def _anchors(self, at: int) -> tuple[np.ndarray, ...]:
        part = self.bytes[at : at + SLICE_BYTES + LENGTH - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * self._forth[: len(part)], out=sums[1:])
        x = sums[K:] - sums[:-K]
        x *= self._back[: len(part) - K + 1]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        # the first of the least hashes in every window: places in the low bits, windows of twice the size
        least, size, window = x & ~_PLACES | np.arange(len(x), dtype=np.uint64), 1, LENGTH - K + 1
        while size < window:
            step = min(size, window - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        where = (least & _PLACES).astype(np.int64)
        inside = self.inside[at : at + len(where)]
        new = np.ones(len(where), bool)
        np.not_equal(where[1:], where[:-1], out=new[1:])
        new[1:] |= ~inside[:-1]  # strings that end in another document stand between any two
        last = np.ones(len(where), bool)
        last[:-1] = new[1:] | ~inside[1:]
        first = np.flatnonzero(new & inside)
        return x[where[first]], where[first] + at, first + at, np.flatnonzero(last & inside) + at, np.searchsorted(self.ends, first + at, "right")

    def bucketed(self, buckets: int) -> np.ndarray:
        """Bucket of every anchor, above 32 bits of its hash."""
        return (((self.hash >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (self.hash & np.uint64(0xFFFFFFFF))

    def contexts(self, codes: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Occurrences (places in the anchors) that share their code, the context of each, the contexts, and the first occurrence of each.

        A context's text tells its anchor: the one that its first string has.
        """
        some = np.zeros(1 << 22, bool)
        some[shared & _FEW] = True
        hit = np.flatnonzero(some[codes & _FEW])
        at = np.searchsorted(shared, codes[hit])
        hit = hit[shared[np.minimum(at, max(0, len(shared) - 1))] == codes[hit]] if len(shared) else hit[:0]
        whole = self.whole
        texts = [whole[a:b] for a, b in zip(self.low[hit].tolist(), (self.high[hit] + LENGTH).tolist(), strict=True)]
        number = {text: k for k, text in enumerate(dict.fromkeys(texts))}
        which = np.fromiter(map(number.__getitem__, texts), np.int64, len(texts))
        first = np.full(len(number), len(hit))
        first[which[::-1]] = np.arange(len(hit))[::-1]
        return hit, which, list(number), first


def _blob(value) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def _value(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _rows(bucket: list[int], part: list[int], kind: list[int], data: list[bytes]) -> pa.Table:
    return pa.table({"bucket": pa.array(bucket, pa.int64()), "part": pa.array(part, pa.int64()), "kind": pa.array(kind, pa.int32()), "data": pa.array(data, pa.binary())})


_ROWS = "bucket long, part long, kind int, data binary"


def _cut(codes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, codes) of sorted codes."""
    if not len(codes):
        return []
    bucket = (codes >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    return [(int(bucket[a]), codes[a:b]) for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(codes)], strict=True)]


def _send_hashes(docs: pa.Table, buckets: int) -> pa.Table:
    """A part's anchors by bucket, each once, and whether two of its documents have it."""
    part = Part(docs)
    codes = part.bucketed(buckets)
    order = np.lexsort((part.doc, codes))
    codes, doc = codes[order], part.doc[order]
    edge = np.ones(len(codes), bool)
    edge[1:] = codes[1:] != codes[:-1]
    firsts = np.flatnonzero(edge)
    lasts = np.append(firsts[1:], len(codes)) - 1
    several = doc[firsts] != doc[lasts]
    out, at = [], 0
    for bucket, some in _cut(codes[firsts]):
        n = len(some)
        out.append((bucket, _blob(((some & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.packbits(several[at : at + n])))))
        at += n
    number = docs.column("part")[0].as_py()
    return _rows([b for b, _ in out], [number] * len(out), [0] * len(out), [d for _, d in out])


def _shared_hashes(sent: pa.Table) -> pa.Table:
    """For every part, its hashes of this bucket that some other document has too."""
    bucket = sent.column("bucket")[0].as_py()
    parts = sent.column("part").to_pylist()
    values = [_value(d) for d in sent.column("data").to_pylist()]
    hashes = np.concatenate([h for h, _ in values])
    several = np.concatenate([np.unpackbits(s, count=len(h)) for h, s in values]).astype(bool)
    known, place, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = counts > 1
    shared[place[several]] = True
    out, at = [], 0
    for part, (h, _) in zip(parts, values, strict=True):
        own = h[shared[place[at : at + len(h)]]]
        at += len(h)
        if len(own):
            out.append((part, _blob((np.uint64(bucket) << np.uint64(32)) | own.astype(np.uint64))))
    return _rows([bucket] * len(out), [p for p, _ in out], [0] * len(out), [d for _, d in out])


def _codes(info: pa.Table) -> np.ndarray:
    blobs = [d for d, k in zip(info.column("data").to_pylist(), info.column("kind").to_pylist(), strict=True) if k == 0]
    return np.sort(np.concatenate([np.empty(0, np.uint64), *map(_value, blobs)]))


def _send_contexts(docs: pa.Table, info: pa.Table, buckets: int) -> pa.Table:
    if not docs.num_rows or not info.num_rows:
        return _rows([], [], [], [])
    part = Part(docs)
    codes = part.bucketed(buckets)
    hit, _, texts, first = part.contexts(codes, _codes(info))
    own = hit[first]
    bucket, rel, doc = (codes[own] >> np.uint64(32)).astype(np.int64), part.place[own] - part.low[own], part.order[part.doc[own]]
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    numbers, out = [], []
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(order)], strict=True):
        if a < b:
            some = order[a:b]
            numbers.append(int(bucket[some[0]]))
            out.append(_blob((rel[some], doc[some], [texts[k] for k in some.tolist()])))
    number = docs.column("part")[0].as_py()
    return _rows(numbers, [number] * len(out), [1] * len(out), out)


class Comparer:
    """Finds, for every string of some contexts, the least document of all equal strings."""

    def __init__(self):
        self.waiting: list[list] = []
        self.symbols = 0

    def add(self, contexts: list[tuple[int, bytes, int, list]]) -> None:
        """Contexts of one anchor: place of the anchor, text, least document, and where results go: [(array, first place)]."""
        self._split(contexts, 0, LENGTH - K)

    def _split(self, contexts: list, low: int, high: int) -> None:
        """The anchor stands `low` to `high` bytes after the start of the strings looked at."""
        if len(contexts) == 1:
            rel, text, doc, results = contexts[0]
            for array, at in results:
                array[at : at + len(text) - LENGTH + 1] = doc
            return
        size = sum(len(c[1]) + 1 for c in contexts)
        if size <= ANCHOR_SYMBOLS or low == high:
            self.waiting.append(contexts)
            self.symbols += size
            if self.symbols >= BATCH_SYMBOLS:
                self.flush()
            return
        middle = (low + high) // 2
        for a, b in ((low, middle), (middle + 1, high)):
            # strings with the anchor a to b bytes in share what lies from a before it to LENGTH - b after
            cores: dict[bytes, dict[tuple[int, bytes], list]] = defaultdict(dict)
            for rel, text, doc, results in contexts:
                first, last = max(0, rel - b), min(len(text) - LENGTH, rel - a)
                if first > last:
                    continue
                block = (rel - first, text[first : last + LENGTH])
                same = cores[text[rel - a : rel - b + LENGTH]].setdefault(block, [*block, doc, []])
                same[2] = min(same[2], doc)
                same[3] += [(array, at + first) for array, at in results]
            for group in cores.values():
                self._split(list(group.values()), a, b)

    def flush(self) -> None:
        """Suffix arrays of all that waits: anchors are packed into texts, as no string has two."""
        texts: list[list] = []
        size = TEXT_SYMBOLS
        for contexts in self.waiting:
            if size >= TEXT_SYMBOLS:
                texts.append([])
                size = 0
            texts[-1] += contexts
            size += sum(len(c[1]) + 1 for c in contexts)
        self.waiting, self.symbols = [], 0
        laid = []
        for text in texts:
            whole = np.frombuffer(b"\0".join(c[1] for c in text) + b"\0", np.uint8).astype(np.int64) + 1
            stops = np.cumsum([len(c[1]) + 1 for c in text]) - 1
            whole[stops] = 0
            laid.append((whole, stops))
        for text, (whole, stops), array in zip(texts, laid, suffix_arrays([w for w, _ in laid]), strict=True):
            counts = np.array([len(c[1]) - LENGTH + 1 for c in text])
            begins = stops - np.array([len(c[1]) for c in text])
            starts = np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
            number = np.full(len(whole), -1)
            number[starts] = np.arange(len(starts))
            docs = np.repeat(np.array([c[2] for c in text], np.int64), counts)
            array = array[number[array] >= 0]  # the strings, in order
            strings = np.lib.stride_tricks.sliding_window_view(whole.astype(np.uint16), LENGTH)[array]
            edges = np.flatnonzero(np.concatenate([[True], (strings[1:] != strings[:-1]).any(axis=1)]))
            least = np.minimum.reduceat(docs[number[array]], edges)
            result = np.empty(len(starts), np.int64)
            result[number[array]] = np.repeat(least, np.diff(np.append(edges, len(array))))
            for (_, _, _, results), at, n in zip(text, (np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True):
                for target, first in results:
                    target[first : first + n] = result[at : at + n]


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of stretches given by start and size, one after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _compare(sent: pa.Table) -> pa.Table:
    """For every part's contexts of this bucket, in the order sent: the least document of each string."""
    bucket = sent.column("bucket")[0].as_py()
    parts = sent.column("part").to_pylist()
    values = [_value(d) for d in sent.column("data").to_pylist()]
    number: dict[bytes, int] = {}
    which = [np.array([number.setdefault(text, len(number)) for text in texts], np.int64) for _, _, texts in values]
    rel, least = np.zeros(len(number), np.int64), np.full(len(number), NO_ID)
    for own, (r, doc, _) in zip(which, values, strict=True):
        rel[own] = r
        np.minimum.at(least, own, doc)
    del values
    sizes = np.array([len(text) - LENGTH + 1 for text in number], np.int64)
    begins = np.cumsum(sizes) - sizes
    result = np.repeat(least, sizes)  # right where an anchor has one context
    anchors: dict[bytes, list[int]] = {}
    for k, (text, r) in enumerate(zip(number, rel.tolist(), strict=True)):
        anchors.setdefault(text[r : r + K], []).append(k)
    texts, comparer = list(number), Comparer()
    for same in anchors.values():
        if len(same) > 1:
            comparer.add([(int(rel[k]), texts[k], int(least[k]), [(result, int(begins[k]))]) for k in same])
    comparer.flush()
    answers = [result[_stretches(begins[own], sizes[own])] for own in which]
    return _rows([bucket] * len(parts), parts, [1] * len(parts), [_blob(a) for a in answers])


def _kept_type(id_type: str) -> str:
    return f"doc_id {id_type}, n_bytes long, starts array<long>, ends array<long>, kept binary"


def _keep(docs: pa.Table, info: pa.Table, buckets: int, schema: pa.Schema) -> pa.Table:
    """Cover what the answers say and keep the rest."""
    if not docs.num_rows:
        return schema.empty_table()
    part = Part(docs)
    codes = part.bucketed(buckets)
    hit, which, texts, first = part.contexts(codes, _codes(info))
    change = np.zeros(len(part.bytes) + 1, np.int64)
    if len(texts):
        answers = {b: _value(d) for b, k, d in zip(*(info.column(c).to_pylist() for c in ("bucket", "kind", "data")), strict=True) if k == 1}
        sizes = np.array([len(t) - LENGTH + 1 for t in texts])
        bucket = (codes[hit[first]] >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")  # as they were sent
        least = np.concatenate([answers[b] for b in sorted(answers)])
        begins = np.empty(len(texts), np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        for at in range(0, len(hit), 1 << 18):
            occurrence, n = hit[at : at + (1 << 18)], sizes[which[at : at + (1 << 18)]]
            gone = least[_stretches(begins[which[at : at + (1 << 18)]], n)] < np.repeat(part.order[part.doc[occurrence]], n)
            start = _stretches(part.low[occurrence], n)[gone]
            change += np.bincount(start, minlength=len(change)) - np.bincount(start + LENGTH, minlength=len(change))
    covered = np.cumsum(change[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    # runs that meet at the border of two documents are two
    borders = part.starts[1:][(part.starts[1:] > 0) & (part.starts[1:] < len(covered))]
    borders = np.unique(borders[covered[borders] & covered[borders - 1]]) if len(borders) else borders
    starts, ends = np.sort(np.append(starts, borders)), np.sort(np.append(ends, borders))
    rows, lows = [], np.searchsorted(starts, part.starts).tolist()
    highs = np.searchsorted(starts, part.ends).tolist()
    for k, (a, b, low, high) in enumerate(zip(part.starts.tolist(), part.ends.tolist(), lows, highs, strict=True)):
        kept = part.bytes[a:b][~covered[a:b]].tobytes() if high > low else part.whole[a:b]
        rows.append((part.ids[k], b - a, (starts[low:high] - a).tolist(), (ends[low:high] - a).tolist(), kept))
    return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def without_repeats(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_bytes, starts and ends of what is removed, and the bytes kept, of every document."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4, -(-total // part_bytes))
    rows = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).alias("part"))
    id_type = dict(rows.dtypes)["doc_id"]
    schema = pa.schema([("doc_id", pa.int32() if id_type == "int" else pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])
    by_part = rows.groupBy("part")
    shared = by_part.applyInArrow(lambda t: _send_hashes(t, parts), _ROWS).groupBy("bucket").applyInArrow(_shared_hashes, _ROWS)
    contexts = by_part.cogroup(shared.groupBy("part")).applyInArrow(lambda d, i: _send_contexts(d, i, parts), _ROWS)
    answers = contexts.groupBy("bucket").applyInArrow(_compare, _ROWS)
    return by_part.cogroup(shared.unionByName(answers).groupBy("part")).applyInArrow(lambda d, i: _keep(d, i, parts, schema), _kept_type(id_type))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op7_repeats": op7_repeats}
ORACLE_SQL: dict[str, str] = {}
