"""Benchmark decontamination by latent semantic retrieval, then common-subsequence and answer checks.

Words of passages are weighted by inverse document frequency, counted over all documents. A randomised
SVD of TF-IDF passages gives the latent space: executors multiply their passages with a random
basis and send back sums, the driver makes them orthogonal, twice. It is fitted once, on every
benchmark item and on every passage of FIT_WORDS words of every document; all documents together weigh as much
as FIT_DOCUMENTS of them, and a long text as FIT_PASSAGES passages, so that items stand out among any number. Every stretch of every
document, at half-overlapping windows of the items' lengths, is then compared with all items by
cosine in that space. A window whose cosine reaches CANDIDATE of what the item has with itself is a
candidate: the longest common subsequence of its surroundings and the item must cover NEAR of
the item's words, or PARAPHRASE of them if ANSWER of the words of the item's answer (its last line,
or last sentence) are also there.

An item of fewer than MIN_WORDS words has no window of its own: it is found where just its words stand in
its order, next to each other.

Scale: one pass counts words, two fit the basis, one searches; none shuffles text. Counts and sums are bounded by
VOCABULARY, are added up on executors slice by slice, and only sums reach the driver. A fit has a task for each core, as
every task sends sums as large as the basis. The latent
basis (VOCABULARY * RANK floats) and about MAX_ITEMS items are broadcast at a time; a larger benchmark is searched in
so many blocks, each with a pass of its own, and never held by the driver as a whole. Windows run over whole batches of documents, so many short
documents cost what one long one does, and a long one is cut into stretches of bounded size.

Null or empty text has no windows; null items and items without words match nothing. Null ids stay as they are. Repeated
rows each give their own result; repeated items too. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm.common import table

VOCABULARY_BITS, RANK, OVERSAMPLE, ROUNDS = 16, 48, 16, 2
VOCABULARY = 1 << VOCABULARY_BITS
FIT_DOCUMENTS, FIT_PASSAGES, FIT_WORDS, MAX_ITEMS = 4000, 64, 48, 4096
#: How much the items weigh in the fit, so that the latent space tells them apart.
ITEM_WEIGHT = 8.0
#: Length of the shortest windows; further ones double up to the longest item.
WINDOW = 16
CANDIDATE, NEAR, PARAPHRASE, ANSWER = 0.4, 0.8, 0.55, 0.6
#: Words whose sums are taken first: half of the shortest window.
BLOCK = WINDOW // 2
MIN_WORDS, GROUP_BYTES, OVERLAP_BYTES, SLICES, SALTS = 5, 1 << 18, 1 << 14, 16, 64
#: Rows of the basis that are taken at once, a multiple of BLOCK.
AT_ONCE = 4096

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """Hashes of the words of some texts laid end to end, without making a string of any."""

    _powers, _inverses = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, texts: list[bytes]):
        whole = b"\n" + b"\n".join(texts) + b"\n"
        at = np.frombuffer(whole, np.uint8)
        self._reach(len(at))
        space = _SPACE[at]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        # differences of prefix sums of byte * R**place, moved back to place 0, modulo 2**64
        sums = np.cumsum(at * self._powers[: len(at)], dtype=np.uint64)
        self.hashes = (sums[ends - 1] - sums[starts - 1]) * self._inverses[starts]
        self.places = ((self.hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - VOCABULARY_BITS)).astype(np.int64)
        self.firsts = np.searchsorted(starts, np.cumsum([1, *(len(t) + 1 for t in texts)]))

    @classmethod
    def _reach(cls, n: int) -> None:
        if len(cls._powers) < n:
            step, back = np.uint64(0x5851F42D4C957F2D), np.uint64(pow(0x5851F42D4C957F2D, -1, 2**64))
            cls._powers, cls._inverses = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(n + n // 2, x, np.uint64))]) for x in (step, back))


def encoded(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def windows_up_to(longest: int) -> list[int]:
    """Doubling lengths, the last at least as long as the longest item."""
    out = [WINDOW]
    while out[-1] < longest:
        out.append(2 * out[-1])
    return out


def in_groups(texts: list[str | None], overlap: int = OVERLAP_BYTES) -> Iterator[tuple[list[int], list[bytes]]]:
    """(places in the list, encoded texts) of about GROUP_BYTES each; a longer text comes in overlapping parts."""
    most = max(GROUP_BYTES, 4 * overlap)
    places: list[int] = []
    group: list[bytes] = []
    size = 0
    for place, text in enumerate(texts):
        whole, at = encoded(text), 0
        while True:
            part = whole[at : at + most]
            if group and size + len(part) > most:
                yield places, group
                places, group, size = [], [], 0
            places.append(place)
            group.append(part)
            size += len(part)
            if at + most >= len(whole):
                break
            at += most - overlap
    if group:
        yield places, group


def _summed(parts: DataFrame, kind: str, salts: int = 1) -> dict[int, np.ndarray]:
    """The sums of parts(slice, data) by slice, added on executors; data: arrays of one dtype as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch.column("slice").to_pylist(), batch.column("data").to_pylist(), strict=True):
                values = np.frombuffer(data, kind)
                total[at] = total[at] + values if at in total else values
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["slice", "data"])

    if salts > 1:  # first by salt, as a slice's task would else read what every task has made
        parts = parts.repartition("slice", F.pmod(F.spark_partition_id(), F.lit(salts))).mapInArrow(run, "slice int, data binary")
    added = parts.repartition(SLICES, "slice").mapInArrow(run, "slice int, data binary")
    return {r["slice"]: np.frombuffer(r["data"], kind) for r in added.collect()}


def _slices(values: np.ndarray) -> pa.RecordBatch:
    cut = np.split(values, SLICES)
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([np.ascontiguousarray(c).tobytes() for c in cut], pa.binary())], names=["slice", "data"])


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """In how many documents each place of the vocabulary occurs; the last value is the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(VOCABULARY, np.int64), 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n += len(texts)
            cells, parts = [np.empty(0, np.int64)], 0
            for places, group in in_groups(texts):
                words, parts = Words(group), parts + len(places)
                text = np.repeat(np.array(places, np.int64), np.diff(words.firsts))
                own = np.sort((text << VOCABULARY_BITS) | words.places)
                cells.append(own[np.diff(own, prepend=-1) > 0])
            found = np.concatenate(cells)
            if parts > len(texts):  # a long text comes in parts
                found = np.unique(found)
            counts += np.bincount(found & (VOCABULARY - 1), minlength=VOCABULARY)
        if n:
            yield _slices(counts)
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([np.array([n], np.int64).tobytes()], pa.binary())], names=["slice", "data"])

    found = _summed(docs.select("text").mapInArrow(run, "slice int, data binary"), "int64", SALTS)
    if not found:
        return np.zeros(VOCABULARY + 1, np.int64)
    return np.concatenate([*[found[s] for s in range(SLICES)], found[-1]])


def _weighed(first: np.ndarray, n: np.ndarray, which: np.ndarray, shares: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For every run of n entries from `first`, the sum of rows[which] * shares; runs of about one length together."""
    out = np.zeros((len(first), rows.shape[1]), np.float32)
    before, width, longest = 0, 1, n.max(initial=0)
    while before < longest:
        some, step = np.flatnonzero((n > before) & (n <= width)), max(1, AT_ONCE // width)
        for a in range(0, len(some), step):
            run = some[a : a + step]
            at, inside = first[run, None] + np.arange(width), np.arange(width) < n[run, None]
            at *= inside
            out[run] = ((shares[at] * inside)[:, None] @ rows.take(which[at], axis=0))[:, 0] if width > 1 else shares[at] * rows.take(which[at[:, 0]], axis=0)
        before, width = width, max(width + 1, width * 4 // 3 if width % 3 == 0 else width * 3 // 2)  # 1, 2, 3, 4, 6, 8, 12 ... 48
    return out


def _add_times_own(out: np.ndarray, passage: np.ndarray, places: np.ndarray, weights: np.ndarray, scale: np.ndarray, basis: np.ndarray) -> None:
    """Add A'(A basis) to `out` for words with their passage (numbers from 0, ascending) and place, with `scale` as idf."""
    cells = np.sort((passage << VOCABULARY_BITS) | places)
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    times, cells = np.diff(first, append=len(cells)), cells[first]
    rows, columns = cells >> VOCABULARY_BITS, cells & (VOCABULARY - 1)
    values = times * scale[columns]
    lengths = np.sqrt(np.bincount(rows, values**2, len(weights)))
    values = (values * (weights / np.maximum(lengths, 1e-30))[rows]).astype(np.float32)
    starts = np.searchsorted(rows, np.arange(len(weights) + 1))
    own = _weighed(starts[:-1], np.diff(starts), columns, values, basis)
    by_word = np.argsort(columns.astype(np.uint16), kind="stable")
    columns = columns[by_word]
    first = np.flatnonzero(np.diff(columns, prepend=-1))
    sums = _weighed(first, np.diff(first, append=len(columns)), rows[by_word], values[by_word], own)
    sums += out.take(columns[first], axis=0)
    out[columns[first]] = sums


def passages(firsts: np.ndarray, of_items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The passage and the text of every word, and of every passage its share of its text's weight; an item is one passage."""
    n = np.diff(firsts)
    size = np.where(of_items, np.maximum(1, n), FIT_WORDS)
    many = -(-n // size)
    text = np.repeat(np.arange(len(n)), n)
    passage = (np.cumsum(many) - many)[text] + (np.arange(len(text)) - (firsts[:-1] - firsts[0])[text]) // size[text]
    return passage, text, np.repeat(np.sqrt(np.minimum(1, FIT_PASSAGES / np.maximum(1, many))), many)


def orthogonal(sums: np.ndarray, rank: int) -> np.ndarray:
    """The `rank` strongest left singular vectors of a tall matrix, by the small matrix of its columns' products."""
    products = sums.T.astype(np.float64) @ sums
    values, vectors = np.linalg.eigh(products)
    strongest = np.argsort(-values, kind="stable")[:rank]
    scale = np.where(values[strongest] > 1e-10 * max(values.max(), 1e-30), 1 / np.sqrt(np.maximum(values[strongest], 1e-30)), 0.0)
    return (sums @ (vectors[:, strongest] * scale).astype(np.float32)).astype(np.float32)


def latent_basis(docs: DataFrame, items: DataFrame, idf: np.ndarray, n_docs: int, seed: int = 2) -> np.ndarray:
    """VOCABULARY x RANK: right singular vectors of the TF-IDF passages, by a distributed randomised SVD."""
    context = docs.sparkSession.sparkContext
    basis = np.random.default_rng(seed).standard_normal((VOCABULARY, RANK + OVERSAMPLE)).astype(np.float32)
    of_docs = min(1.0, FIT_DOCUMENTS / max(1, n_docs)) ** 0.5
    texts = docs.select("text", F.lit(False).alias("item")).unionByName(items.select("text", F.lit(True).alias("item")))
    texts = texts.coalesce(context.defaultParallelism)  # every task sends sums as large as the basis
    for last in [*[False] * (ROUNDS - 1), True]:
        sent = context.broadcast((basis, idf))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            (own, scale), out = sent.value, None
            for batch in batches:
                added = None
                of_items = np.array(batch.column("item").to_pylist(), bool)
                for places, group in in_groups(batch.column("text").to_pylist(), 0):
                    words = Words(group)
                    if not len(words.places):
                        continue
                    added = np.zeros(own.shape, np.float32) if added is None else added
                    passage, text, weights = passages(words.firsts, of_items[places])
                    first = np.flatnonzero(np.diff(passage, prepend=-1))  # word of every passage
                    weights *= np.where(of_items[places][text[first]], ITEM_WEIGHT, of_docs)
                    _add_times_own(added, passage, words.places, weights, scale, own)
                if added is not None:  # of 64 bits, as the sums of very many passages are long
                    out = added.astype(np.float64) if out is None else np.add(out, added, out=out)
            if out is not None:
                yield _slices(out.astype(np.float32))

        found = _summed(texts.mapInArrow(run, "slice int, data binary"), "float32")
        sent.destroy()  # what it was for has been collected
        if found:
            total = np.concatenate([found[s].reshape(-1, basis.shape[1]) for s in range(SLICES)])
            del found
            basis = orthogonal(total, RANK if last else basis.shape[1])
    return np.ascontiguousarray(basis[:, :RANK])


def places_of(words: list[int]) -> dict[int, int]:
    """For every word, the bits of its places."""
    where: dict[int, int] = {}
    for i, w in enumerate(words):
        where[w] = where.get(w, 0) | 1 << i
    return where


def common_subsequence(n: int, hits: list[int]) -> int:
    """Length of the longest common subsequence of n words and others, given as the bits of their places among the n."""
    full = (1 << n) - 1
    row = full
    for places in hits:
        hit = row & places
        row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def answer_of(text: str) -> str:
    """The last line, or the last sentence of a single line."""
    lines = [x for x in text.strip().splitlines() if x.strip()]
    return lines[-1] if len(lines) > 1 else re.split(r"(?<=[.!?])\s+", text.strip())[-1]


class Item:
    """A benchmark item, with its words and those of its answer as hashes."""

    def __init__(self, item_id: int | None, text: str):
        words, answer = Words([encoded(text)]), Words([encoded(answer_of(text))])
        self.item_id, self.n, self.n_answer, self.places = item_id, len(words.hashes), len(answer.hashes), words.places
        self.n_bytes, self.hashes = len(encoded(text)), words.hashes if len(words.hashes) < MIN_WORDS else None
        self.where, self.where_answer = places_of(words.hashes.tolist()), places_of(answer.hashes.tolist())


class Searcher:
    """Finds benchmark items in documents."""

    def __init__(self, all_items: list[Item], idf: np.ndarray, basis: np.ndarray):
        self.items = items = [item for item in all_items if item.n >= MIN_WORDS]
        self.short: dict[int, list[Item]] = {}
        for item in all_items:
            if 0 < item.n < MIN_WORDS:
                self.short.setdefault(int(item.hashes[0]), []).append(item)
        self.short_firsts = np.array(list(self.short), np.uint64)
        self.rank = basis.shape[1]
        # the last column sums the squared weights, for the length of a window's whole vector
        self.table = np.concatenate([basis * idf[:, None], (idf**2)[:, None]], axis=1).astype(np.float32)
        own = np.array([self.table[item.places].sum(axis=0) for item in items]).reshape(len(items), self.rank + 1)
        self.lengths = np.array([item.n for item in items])
        self.windows = windows_up_to(int(self.lengths.max(initial=0)))
        # parts of a long text overlap by twice the longest item, so that none is cut in all of them
        self.overlap = max(OVERLAP_BYTES, 2 * max((item.n_bytes for item in items), default=0))
        fit = np.abs(np.log(np.array(self.windows)[None, :] / np.maximum(1, self.lengths)[:, None])).argmin(axis=1)
        latent = own[:, : self.rank]
        self_score = (latent**2).sum(axis=1) / np.maximum(np.sqrt(own[:, -1]), 1e-9)
        # windows are divided by their length, items by their score with themselves: 1 is a copy
        self.sought = {k: (np.flatnonzero(fit == k), (latent / np.maximum(self_score, 1e-9)[:, None])[fit == k].T.astype(np.float32)) for k in sorted(set(fit.tolist()))}

    def candidates(self, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first words, ends, items, cosines) of the candidate windows over words given as places."""
        n = len(places)
        half, size = np.empty((-(-n // BLOCK), self.table.shape[1]), np.float32), 2 * BLOCK
        for a in range(0, n, AT_ONCE):
            rows = self.table.take(places[a : a + AT_ONCE], axis=0)
            if len(rows) % BLOCK:
                rows = np.concatenate([rows, np.zeros((-len(rows) % BLOCK, rows.shape[1]), np.float32)])
            half[a // BLOCK : a // BLOCK + len(rows) // BLOCK] = np.add.reduce(rows.reshape(-1, BLOCK, rows.shape[1]), axis=1)
        for k, window in enumerate(self.windows):
            while size < window:  # from sums over half a window to sums over twice as much
                half, last, size = half[:-1:2] + half[1::2], half[len(half) & ~1 :], 2 * size
                half = np.concatenate([half, last]) if len(last) else half
            if k not in self.sought:
                continue
            which, sought = self.sought[k]
            windows = half[:-1] + half[1:] if len(half) > 1 else half
            score = windows[:, : self.rank] @ sought
            score /= np.sqrt(np.maximum(windows[:, -1:], 1e-6))
            w, i = np.nonzero(score >= CANDIDATE)
            starts = w * (size // 2)
            yield starts, np.minimum(starts + size, n), which[i], score[w, i]

    def verify(self, words: list[int], item: Item) -> tuple[float, float] | None:
        """Shares of the item's words and of its answer's found in order, or None where they don't make a match."""
        hits = list(filter(None, map(item.where.get, words)))
        if len(hits) < PARAPHRASE * item.n:  # no common subsequence is longer
            return None
        share = common_subsequence(item.n, hits) / item.n
        if share < PARAPHRASE:
            return None
        answered = common_subsequence(item.n_answer, list(filter(None, map(item.where_answer.get, words)))) / max(1, item.n_answer)
        return (share, answered) if share >= NEAR or answered >= ANSWER else None

    def sequences(self, words: Words) -> Iterator[tuple[int, Item]]:
        """(document, item) wherever the words of a short item stand next to each other."""
        for at in np.flatnonzero(np.isin(words.hashes, self.short_firsts)).tolist() if self.short else []:
            d = int(np.searchsorted(words.firsts, at, "right")) - 1
            for item in self.short[int(words.hashes[at])]:
                if at + item.n <= words.firsts[d + 1] and (words.hashes[at : at + item.n] == item.hashes).all():
                    yield d, item

    def search(self, texts: list[str | None]) -> list[tuple[int, Item, float, float, float]]:
        """(document's place, item, cosine, subsequence, answer) of contaminated documents, each pair once."""
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        known: dict[int, Item] = {}
        for places, group in in_groups(texts, self.overlap):
            words = Words(group)
            if not len(words.hashes):
                continue
            firsts = words.firsts
            for d, item in self.sequences(words):
                known[id(item)] = item
                best[places[d], id(item)] = (1.0, 1.0, 1.0)
            for starts, ends, which, cosines in self.candidates(words.places):
                # neighbouring windows of an item are looked at together, as they reach into each other anyway
                order = np.lexsort((starts, which))
                starts, ends, which, cosines = starts[order], ends[order], which[order], cosines[order]
                reach = self.lengths[which]
                apart = np.flatnonzero((which[1:] != which[:-1]) | (starts[1:] > ends[:-1] + reach[1:])) + 1
                for low, high in zip([0, *apart.tolist()], [*apart.tolist(), len(which)], strict=True):
                    if low == high:
                        continue
                    at, more = int(which[low]), int(reach[low])
                    start, end, cosine = int(starts[low]) - more, int(ends[high - 1]) + more, float(cosines[low:high].max())
                    for d in range(int(np.searchsorted(firsts, starts[low], "right")) - 1, int(np.searchsorted(firsts[:-1], ends[high - 1], "left"))):
                        a, b = max(start, int(firsts[d])), min(end, int(firsts[d + 1]))
                        shares = self.best_in(words.hashes[a:b], self.items[at])
                        if shares:
                            known[id(self.items[at])] = self.items[at]
                            key, new = (places[d], id(self.items[at])), (*shares, cosine)
                            best[key] = max(best.get(key, new), new)
        return [(d, known[i], c, s, a) for (d, i), (s, a, c) in best.items()]

    def best_in(self, hashes: np.ndarray, item: Item) -> tuple[float, float] | None:
        """The best match within any stretch of three item lengths."""
        step = max(1, item.n)
        found = [self.verify(hashes[a : a + 3 * step].tolist(), item) for a in range(0, max(1, len(hashes) - step), step)]
        return max((f for f in found if f), default=None)


def prepared(benchmark: DataFrame, docs: DataFrame) -> Iterator[tuple[list[Item], np.ndarray, np.ndarray]]:
    """(items, idf, basis) for each block of items."""
    items = benchmark.where("text is not null").select("item_id", "text")
    n_items = items.count()
    if not n_items:
        return
    counts = document_frequencies(docs)
    n = int(counts[-1])
    # squared, as a word's weight in a passage must not come from how often a frequent one is repeated there
    idf = (np.log((n + 1) / (counts[:-1] + 0.5)).clip(0.05) ** 2).astype(np.float32)
    basis = latent_basis(docs, items, idf, n)
    blocks = -(-n_items // MAX_ITEMS)
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        rows = [Item(r.item_id, r.text) for r in some.collect()]  # about MAX_ITEMS
        yield sorted(rows, key=lambda r: (r.item_id is None, r.item_id or 0, r.n)), idf, basis


_HITS = "item_id long, cosine double, subsequence double, answer double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, subsequence, answer: which documents hold which items."""
    rows = docs.select("doc_id", "text")
    result = None
    for block in prepared(benchmark, rows):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(*sent.value)
            for batch in batches:
                hits = searcher.search(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64())),
                        pa.array([h[1].item_id for h in hits], pa.int64()),
                        *[pa.array([round(float(h[k]), 6) for h in hits], pa.float64()) for k in (2, 3, 4)],
                    ],
                    names=["doc_id", "item_id", "cosine", "subsequence", "answer"],
                )

        found = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {_HITS}")
        result = found if result is None else result.unionByName(found)
    if result is None:
        return rows.where("false").select("doc_id", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in _HITS.split(", ")])
    return result


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns, in one pass."""
    for block in prepared(benchmark, docs.select("doc_id", "text")):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(*sent.value)
            for batch in batches:
                bad = {h[0] for h in searcher.search(batch.column("text").to_pylist())}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLE_SQL: dict[str, str] = {}
