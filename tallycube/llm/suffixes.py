"""Removal of repeated byte strings with suffix arrays.

A byte of a document goes when a string of LENGTH bytes over it also starts in a document with a smaller id.

Strings are first dealt to tasks by content: the smallest hash among the grams inside a string is the same wherever the
string occurs, so equal strings meet in one task. Neighbouring strings mostly have the same smallest hash, and travel as
one segment of text. Segments whose smallest hash occurs in one document only are left out beforehand. Where a hash has
HOT segments or more (a frequent gram in ever different surroundings), its strings travel one by one instead and are dealt
by a hash of the whole string, to tasks of their own, so that no task gets all of them.

A task takes its segments group by group and joins those of a group that share a long gram with another document to shards
of bounded size. Each shard is sorted by a suffix array, refined as by Larsson and Sadakane; common prefixes of the suffixes that begin with a whole string come from Kasai's scan, run over all segments
side by side; runs of suffixes with a common prefix of LENGTH bytes are equal strings. Where a task has several shards, equal strings of two shards are found by
binary search.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tallycube.llm.common import bit_filter, passes, quoted, ranges, slices, texts_of, written
from tallycube.llm.shingles import BYTE_VALUE, mix, powers

LENGTH = 50
GRAM = 20
LONG_GRAM = 40  # of the grams inside a string, those that two documents of a group must share before its suffixes are sorted
FILTER_BITS = 26  # 8 MB: marks the hashes that occur in two documents
MOST_BITS = 30  # 128 MB, where there are many of them
MOST_STRINGS = 200  # strings in one segment
SHARD = 1_500_000  # bytes
SLICE = 2_000_000
CHUNK = 200_000  # bytes hashed at once, which stay in a core's cache
PER_TASK = 12_000_000  # bytes of text for each task that segments are dealt to
GROUP = 4_000_000  # bytes of text for each group of segments that a task compares at once; they are about four times that
SENT = 10_000_000  # bytes of segments that a task gathers, so that those for one group travel in few bundles, however many groups there are
HOT = 20_000  # segments of one hash from which its strings are dealt one by one
WAITING = 200_000  # rows of a group that wait until those of larger ids are told
STRING_COST = 1_500  # bytes of the strings of a segment, about: 31 of 50 bytes

HASHES = "part long, hashes binary, often binary"
FREQUENT = "hash long, load long"
SEGMENTS = "part long, rows binary, text binary"
REMOVED = "doc_id long, text_hash long, start int, end int"
OUTPUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def smallest_hashes(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each start of a string of `length` bytes, the smallest hash of the grams inside it."""
    n = len(data) - gram + 1
    if n < length - gram + 1:
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUE[data] * up[: len(data)])])
    least = mix((sums[gram:] - sums[:n]) * down[:n])
    width, target = 1, length - gram + 1
    while 2 * width <= target:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = target - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def segments_of(texts: list[bytes], gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of strings with the same smallest hash: (hash, text, first start, last start) as arrays."""
    found = [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
    first = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK or k == len(texts) - 1:
            value, of, start, end = _segments_in(texts[first : k + 1], gram)
            found.append((value, of + first, start, end))
            first, size = k + 1, 0
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _segments_in(texts: list[bytes], gram: int) -> tuple[np.ndarray, ...]:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    least = smallest_hashes(np.frombuffer(b"".join(texts), np.uint8), LENGTH, gram)
    # A run begins where the smallest hash changes, where a text begins, and where the last whole string of a text is past.
    begins = np.ones(len(least) + 1, bool)
    np.not_equal(least[1:], least[:-1], out=begins[1:-1])
    begins[bounds[bounds < len(least)]] = True
    past = np.maximum(bounds[1:] - LENGTH + 1, bounds[:-1])
    begins[past[past < len(least)]] = True
    begin = np.flatnonzero(begins)
    begin, end = begin[:-1], begin[1:]
    of = np.searchsorted(bounds, begin, side="right") - 1
    whole = begin + LENGTH <= bounds[1:][of]
    begin, end, of = begin[whole], end[whole], of[whole]
    # Long runs (a repeated character) are cut, so that segments stay short.
    times = -(-(end - begin) // MOST_STRINGS)
    if (times > 1).any():
        nth = ranges(np.zeros(len(times), np.int64), times)
        begin, end, of = np.repeat(begin, times) + nth * MOST_STRINGS, np.repeat(end, times), np.repeat(of, times)
        end = np.minimum(end, begin + MOST_STRINGS)
    # Smallest hashes are small numbers; mixed again they are spread evenly over tasks and over the filter.
    return mix(least[begin]), of, begin - bounds[of], end - 1 - bounds[of]


def _dealt(values: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    return _grouped((((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64))


def _grouped(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(part)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(part[order[a]]), order[a:b]


def _often(texts: list[bytes], value: np.ndarray, of: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Rows (hash, number of further segments) of the hashes, in order, that have over two distinct segments here."""
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    counts = np.diff(np.append(head, len(value)))
    rows = []
    for a, n in zip(head[counts > 2].tolist(), counts[counts > 2].tolist(), strict=True):
        distinct = {texts[o][x : y + LENGTH] for o, x, y in zip(of[a : a + n].tolist(), first[a : a + n].tolist(), last[a : a + n].tolist(), strict=True)}
        if len(distinct) > 2:
            rows.append((value[a], len(distinct) - 2))
    return np.array(rows, np.uint64).reshape(-1, 2)


def _hashes(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in slices(batch.column(0), SLICE):
            value, of, first, last = segments_of(texts)
            order = np.lexsort((of, value))
            value, of = value[order], of[order]
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            # The first document of a hash and one more stand for all of them.
            other = np.zeros(len(value), bool)
            other[1:] = ~new[1:] & (of[1:] != of[:-1])
            second = np.flatnonzero(other)
            second = second[np.unique(value[second], return_index=True)[1]]
            told = value[np.concatenate([np.flatnonzero(new), second])]
            more = _often(texts, value, of, first[order], last[order])
            rows = [(p, told[some].tobytes(), b"") for p, some in _dealt(told, parts)]
            rows += [(p, b"", np.ascontiguousarray(more[some]).tobytes()) for p, some in _dealt(more[:, 0], parts)]
            if rows:
                p, raw, often = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(raw, pa.binary()), pa.array(often, pa.binary())], ["part", "hashes", "often"])


def _frequent(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """Hashes that occur twice, each once with load 0, and those of `hot` segments or more once again with their number."""
    kept, times, load = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    some: list[np.ndarray] = []
    often: list[np.ndarray] = []
    size = 0

    def told(hashes: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(number)], ["hash", "load"])

    def compact() -> pa.RecordBatch:
        nonlocal kept, times, load
        one = np.concatenate([np.zeros(0, np.uint64), *some])
        more = np.concatenate([np.zeros((0, 2), np.uint64), *often])
        values = np.concatenate([kept, one, more[:, 0]])
        order = np.argsort(values, kind="stable")
        values = values[order]
        head = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)

        def summed(old: np.ndarray, ones: np.ndarray, extra: np.ndarray) -> np.ndarray:
            return np.add.reduceat(np.concatenate([old, ones, extra])[order], head) if len(head) else old

        ones, none = np.ones(len(one), np.int64), np.zeros(len(more), np.int64)
        known = summed((times > 1).astype(np.int64), 0 * ones, none) > 0
        times, load = summed(times, ones, none), summed(load, ones, more[:, 1].astype(np.int64))
        kept = values[head]
        new = kept[(times > 1) & ~known]
        return told(new, np.zeros(len(new), np.int64))

    for batch in batches:
        for raw, extra in zip(texts_of(batch.column(1)), texts_of(batch.column(2)), strict=True):
            some.append(np.frombuffer(raw, np.uint64))
            often.append(np.frombuffer(extra, np.uint64).reshape(-1, 2))
            size += len(some[-1]) + len(often[-1])
        if size > 4_000_000:
            yield compact()
            some, often, size = [], [], 0
    yield compact()
    many = (load >= hot) & (times > 1)
    yield told(kept[many], load[many])


def filter_bits(hashes: int) -> int:
    """Bits of the filter's size: four or more bits for each hash that it marks, so that at most a quarter of the other hashes pass."""
    return min(max(FILTER_BITS, (4 * hashes).bit_length()), MOST_BITS)


def _bundle(part: int, a: np.ndarray, text: bytes, packed: Callable[[bytes], bytes]) -> tuple:
    """One row of SEGMENTS from rows (doc, key, start, end) and their texts, one behind the other."""
    return part, packed(a[:, :2].T.tobytes() + a[:, 2:].T.astype(np.int32).tobytes()), packed(text)


def _unbundled(raw: bytes) -> np.ndarray:
    """The rows (doc, key, start, end) of a bundle."""
    n = len(raw) // 24
    ids, places = np.frombuffer(raw, np.int64, 2 * n), np.frombuffer(raw, np.int32, 2 * n, 16 * n)
    return np.concatenate([ids.reshape(2, n), places.reshape(2, n)]).T


def _segments(batches: Iterator[pa.RecordBatch], shared, parts: int, hot_parts: int) -> Iterator[pa.RecordBatch]:
    """Segments for the tasks to compare, of hot hashes each string as one, for tasks of their own."""
    marked, hashes = shared.value
    waiting, size = [], 0
    for batch in batches:
        ids, keys = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        for at, texts in slices(batch.column(1), SLICE):
            value, of, first, last = segments_of(texts)
            may = np.flatnonzero(passes(marked, value))
            value, of, first, last = value[may], of[may], first[may], last[may]
            hot = np.isin(value, hashes)
            if hot.any():
                times = np.where(hot, last - first + 1, 1)
                row = np.repeat(np.arange(len(value)), times)
                value, of, hot = value[row], of[row], hot[row]
                first = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                last = np.where(hot, first, last[row])
            told = np.stack([ids[at + of], keys[at + of], first, last + LENGTH], 1)
            waiting.append((value, hot, told, [texts[o][a:b] for o, a, b in zip(of.tolist(), first.tolist(), told[:, 3].tolist(), strict=True)]))
            size += int((told[:, 3] - told[:, 2]).sum())
            if size >= SENT:
                yield from _sent(waiting, parts, hot_parts)
                waiting, size = [], 0
    if waiting:
        yield from _sent(waiting, parts, hot_parts)


def _sent(waiting: list[tuple], parts: int, hot_parts: int) -> Iterator[pa.RecordBatch]:
    """Some slices' segments in bundles. Of equal segments one with the smallest id travels; of the others it is known here
    that they go: they travel without text."""
    value, hot, told = (np.concatenate(c) for c in list(zip(*waiting, strict=True))[:3])
    raws = [raw for *_, some in waiting for raw in some]
    packed = zstandard.ZstdCompressor().compress
    kind, distinct = _numbered(raws, {})
    least = np.full(distinct, np.iinfo(np.int64).max)
    np.minimum.at(least, kind, told[:, 0])
    stays = least[kind] == told[:, 0]
    gone = _joined(told[~stays])
    rows = [_bundle(int(gone[0, 1]) % parts, gone, b"", packed)] if len(gone) else []
    sent = np.flatnonzero(stays)
    if len(sent):
        part = (((value[sent] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        for k in np.flatnonzero(hot[sent]).tolist():
            part[k] = parts + zlib.crc32(raws[sent[k]]) % hot_parts
        for p, some in _grouped(part):
            own = sent[some]
            rows.append(_bundle(p, told[own], b"".join([raws[k] for k in own.tolist()]), packed))
    if rows:
        p, places, texts = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(places, pa.binary()), pa.array(texts, pa.binary())], ["part", "rows", "text"])


def _numbered(raws: list[bytes], numbers: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """A number for each string, the same for equal ones, and how many numbers are given by now."""
    out = np.fromiter((numbers.setdefault(raw, len(numbers)) for raw in raws), np.int64, len(raws))
    return out, len(numbers)


def _joined(rows: np.ndarray) -> np.ndarray:
    """Rows (doc, key, start, end), text by text and in order of their starts, with those that overlap or touch as one."""
    if not len(rows):
        return rows
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1) | (rows[1:, 2] < rows[:-1, 2]) | (rows[1:, 2] > rows[:-1, 3])
    head = np.flatnonzero(new)
    return np.column_stack([rows[head, :3], np.maximum.reduceat(rows[:, 3], head)])


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes of `data` in order.

    Ranks by seven bytes come first. Then each round sorts the suffixes that share a rank by the rank of what follows,
    which doubles the sorted length; suffixes alone in their rank are left alone. The order has to be complete: Kasai's
    scan relies on it.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    # The end of the data is less than any byte.
    padded = np.concatenate([data.astype(np.int64) + 1, np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = key * 257 + padded[k : n + k]
    order = np.argsort(key, kind="stable")
    head = np.ones(n, bool)
    head[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    sorted_ = 7
    while sorted_ < n:
        alone = head & np.append(head[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        some = order[open_]
        pair = rank[some] * np.int64(n + 1) + rank[np.minimum(some + sorted_, n)] + 1
        by = np.argsort(pair, kind="stable")
        order[open_] = some[by]
        pair = pair[by]
        new = np.ones(len(pair), bool)
        new[1:] = pair[1:] != pair[:-1]
        head[open_] = new
        rank[order[open_]] = open_[np.flatnonzero(new)[np.cumsum(new) - 1]]
        sorted_ *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in `order`, by its place in `data`, the length (up to `most`) it shares with the one before it there.

    `order` has the suffixes that begin between `starts` and `ends`; the order of all suffixes may leave out others.
    Kasai's scan: the suffix one byte further shares at least one byte less with the one before it, if that moves by one
    byte to a suffix that is in the order too; otherwise the count begins anew. The scan runs along all segments at once
    and compares eight bytes at a time.
    """
    n, counts = len(data), ends - starts
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    listed = np.zeros(n + 1, bool)
    listed[order] = True
    shared = np.zeros(n, np.int32)
    lanes = np.argsort(-counts, kind="stable")  # longest first
    starts, counts = starts[lanes].astype(np.int32), counts[lanes]
    current = np.zeros(len(starts), np.int32)
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8 + most, np.uint8)]), 8)
    words = lambda at: eight[at].view("<u8").ravel()
    for step in range(int(counts[0]) if len(counts) else 0):
        running = int(np.searchsorted(-counts, -step, side="left"))
        here = starts[:running] + np.int32(step)
        there = before[here]
        length = current[:running]
        length[there < 0] = 0
        room = np.minimum(most, n - np.maximum(here, there))
        growing = np.flatnonzero((there >= 0) & (length < room))
        while len(growing):
            done = length[growing]
            differ = words(here[growing] + done) ^ words(there[growing] + done)
            same = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3  # equal leading bytes
            done = np.minimum(done + same, room[growing])
            length[growing] = done
            growing = growing[(same == 8) & (done < room[growing])]
        shared[here] = length
        current[:running] = np.where(listed[there + 1], np.maximum(length - 1, 0), 0)
    return shared


class Shard:
    """Segments of one task, their strings in order, and the smallest document of each distinct string."""

    def __init__(self, segments: list[tuple[bytes, list[int]]]):
        self.rows = np.array([r for _, r in segments], np.int64).reshape(-1, 4)
        self.data = np.frombuffer(b"".join([t for t, _ in segments]), np.uint8)
        lengths = np.array([len(t) for t, _ in segments], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        owner = np.repeat(np.arange(len(segments), dtype=np.int32), lengths)
        whole = self.bounds[1:][owner] - np.arange(len(owner)) >= LENGTH
        order = suffix_array(self.data)
        self.place = order[whole[order]].astype(np.int32)  # the suffixes that begin with a whole string
        shared = common_prefixes(self.data, self.place, self.bounds[:-1], self.bounds[:-1] + np.maximum(lengths - LENGTH + 1, 0), LENGTH)
        head = shared[self.place] < LENGTH
        if len(head):
            head[0] = True
        self.group = (np.cumsum(head) - 1).astype(np.int32)
        self.heads = self.place[head]
        docs = self.rows[:, 0][owner[self.place]]
        self.smallest = np.minimum.reduceat(docs, np.flatnonzero(head)) if len(head) else docs
        self.docs = docs

    def strings(self) -> np.ndarray:
        """The distinct strings in order; a last byte keeps numpy from dropping trailing zeros."""
        table = np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)[self.heads]
        return np.concatenate([table, np.ones((len(table), 1), np.uint8)], 1).copy().view(f"S{LENGTH + 1}").ravel()

    def gone(self) -> np.ndarray:
        """Ranges (doc, key, start, end) of the bytes that go."""
        covered = self.place[self.docs > self.smallest[self.group]]
        n = len(self.data)
        change = (np.bincount(covered, minlength=n + 1) - np.bincount(covered + LENGTH, minlength=n + 1)).astype(np.int32)
        inside = np.cumsum(change)[:n] > 0
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        begin = np.flatnonzero(inside & (edge[:n] | ~np.concatenate([[False], inside[:-1]])))
        end = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
        own = np.searchsorted(self.bounds, begin, side="right") - 1
        shift = self.rows[own, 2] - self.bounds[own]
        return np.stack([self.rows[own, 0], self.rows[own, 1], begin + shift, end + shift], 1)


def merge_shards(shards: list[Shard]) -> None:
    """Let each shard know the smallest documents of its strings in the other shards, by binary search."""
    strings = [s.strings() for s in shards] if len(shards) > 1 else []
    own = [s.smallest.copy() for s in shards]
    for a in range(len(strings)):
        for b in range(len(strings)):
            if a != b and len(strings[b]):
                found = np.minimum(np.searchsorted(strings[b], strings[a]), len(strings[b]) - 1)
                same = strings[b][found] == strings[a]
                shards[a].smallest[same] = np.minimum(shards[a].smallest[same], own[b][found[same]])


def _removed_batch(rows: np.ndarray) -> pa.RecordBatch:
    rows = rows.reshape(-1, 4)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(rows[:, k], kind) for k, kind in enumerate(kinds)], ["doc_id", "text_hash", "start", "end"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges that go, from the segments of a task, which come group by group. Equal segments are kept once, with the
    smallest id."""
    unpacked = zstandard.ZstdDecompressor().decompress
    kept = Kept()
    group = None
    for batch in batches:
        for part, places, packed in zip(batch.column(0).to_pylist(), *(texts_of(batch.column(k)) for k in (1, 2)), strict=True):
            if part != group:
                yield from _compared(kept)
                kept, group = Kept(), part
            told, text = _unbundled(unpacked(places)), unpacked(packed)
            if not text:
                yield _removed_batch(told)
                continue
            kept.add(told, text)
            if kept.waiting > WAITING:
                yield _removed_batch(kept.settled())
    yield from _compared(kept)


class Kept:
    """The distinct segments of a group, and of each the rows (doc, key, start, end) with its smallest id."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.rows, self.kind = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, told: np.ndarray, text: bytes) -> None:
        ends = np.cumsum(told[:, 3] - told[:, 2])
        cuts = [0, *ends.tolist()]
        kind, _ = _numbered([text[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], self.numbers)
        self.more.append((told, kind))
        self.waiting += len(kind)

    def settled(self) -> np.ndarray:
        """Rows of larger ids, which go; the others stay here."""
        rows = np.concatenate([self.rows, *(r for r, _ in self.more)])
        kind = np.concatenate([self.kind, *(k for _, k in self.more)])
        least = np.full(len(self.numbers), np.iinfo(np.int64).max)
        np.minimum.at(least, kind, rows[:, 0])
        stays = rows[:, 0] == least[kind]
        self.rows, self.kind, self.more, self.waiting = rows[stays], kind[stays], [], 0
        return rows[~stays]


def candidates(texts: list[bytes], docs: np.ndarray) -> np.ndarray:
    """Places of the segments with a string that may also start in a segment of another document: equal strings have the
    same smallest hash of their long grams."""
    value, of, _, _ = segments_of(texts, LONG_GRAM)
    order = np.argsort(value)
    value, doc = value[order], docs[of[order]]
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    if not len(head):
        return head
    several = np.minimum.reduceat(doc, head) < np.maximum.reduceat(doc, head)
    return np.unique(of[order[np.repeat(several, np.diff(np.append(head, len(value))))]])


def _compared(kept: Kept) -> Iterator[pa.RecordBatch]:
    yield _removed_batch(kept.settled())
    distinct = list(kept.numbers)
    may = candidates([distinct[k] for k in kept.kind.tolist()], kept.rows[:, 0])
    segments = [(distinct[k], row) for k, row in zip(kept.kind[may].tolist(), kept.rows[may].tolist(), strict=True)]
    shards, first, size = [], 0, 0
    for k, (text, _) in enumerate(segments):
        size += len(text)
        if size >= SHARD or k == len(segments) - 1:
            shards.append(Shard(segments[first : k + 1]))
            first, size = k + 1, 0
    merge_shards(shards)
    for shard in shards:
        yield _removed_batch(shard.gone())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, raw, ranges in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            kept, at, spans, removed = [], 0, 0, 0
            end = -1
            for r in sorted((r["start"], r["end"]) for r in ranges or ()):
                if r[0] > end:
                    spans += 1
                    kept.append(raw[at : r[0]])
                    removed += r[1] - r[0]
                    end = r[1]
                elif r[1] > end:
                    removed += r[1] - end
                    end = r[1]
                at = end
            kept.append(raw[at:])
            rows.append((doc, len(raw), removed, spans, b"".join(kept)))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [*[pa.int64()] * 4, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (runs of removed bytes), kept (the other bytes, in order).

    A null text is empty. Rows without an id have no place in the order: nothing is removed from them or because of
    them. Rows with the same id never remove from each other. What is kept may end inside a character, as strings are
    bytes. Other columns are left out; an empty table gives no rows.
    """
    spark: SparkSession = documents.sparkSession
    source = documents.select(quoted(doc_id).cast("long").alias("doc_id"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    known = source.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    total = known.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(4, -(-total // PER_TASK))
    hashes = known.select("text").mapInArrow(lambda b: _hashes(b, parts), HASHES).repartition(parts, "part")
    frequent = written(hashes.mapInArrow(lambda b: _frequent(b, hot), FREQUENT), "hashes")
    loads = frequent.filter("load > 0").toArrow()
    hot_hashes, load = loads.column(0).to_numpy().view(np.uint64), int(loads.column(1).to_numpy().sum())
    groups, hot_groups = max(4, -(-total // GROUP)), max(1, -(-load * STRING_COST // (4 * GROUP)))
    tasks = parts + (max(1, -(-load * STRING_COST // (4 * PER_TASK))) if load else 0)
    shared = spark.sparkContext.broadcast((bit_filter(frequent.select("hash"), filter_bits(frequent.count())), hot_hashes))
    segments = known.select("doc_id", "text", "text_hash").mapInArrow(lambda b: _segments(b, shared, groups, hot_groups), SEGMENTS)
    removed = segments.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_compare, REMOVED)
    ranges = removed.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    return source.join(ranges, ["doc_id", "text_hash"], "left").select("doc_id", "text", "ranges").mapInArrow(_cut, OUTPUT)
