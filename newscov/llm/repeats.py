"""Repeated byte strings: a sampled suffix array, sorted deep-shallow, finds and removes them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscov.llm.common import freeing, stored

#: Bytes of a string that must not start twice, and of the string that anchors it.
LENGTH = 200
ANCHOR = 16
#: Bytes up to which suffixes are sorted by multikey quicksort; what is equal there goes into a blind trie.
SHALLOW = 32
#: Different segments of an anchor that one task compares; anchors with more are split by window.
MOST_SEGMENTS = 4_096
#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK = 2 << 20

ODD_1, ODD_2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes that begin at each place."""
    value = data.astype(np.uint64)
    for width in (1, 2, 4):  # 8 bytes in one number
        value = value[:-width] | (value[width:] << np.uint64(8 * width))
    value = (value[:-8] * np.uint64(ODD_1)) ^ (value[8:] * np.uint64(ODD_2))
    value ^= value >> np.uint64(31)
    value *= np.uint64(ODD_1)
    return value ^ (value >> np.uint64(29))


def segments(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``(text, first, last, anchor, hash)``: runs of windows that share their anchor.

    A window of ``length`` bytes is anchored where its smallest hash is, the leftmost of equal
    ones. That depends on the window's bytes alone, so equal windows have equal anchors at equal
    places in them, and only windows with the same anchor hash need comparing.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    hashes = anchor_hashes(data)
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    reach, width = length - ANCHOR + 1, 1
    while width * 2 <= reach:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < reach:
        key = np.minimum(key[: width - reach], key[reach - width :])
    anchors = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.zeros(len(anchors) + 1, np.int32)
    long = sizes >= length
    np.add.at(change, (ends - sizes)[long], 1)
    np.add.at(change, (ends - length + 1)[long], -1)
    valid = np.cumsum(change[:-1]) > 0
    new = np.empty(len(anchors), bool)
    new[0] = valid[0]
    new[1:] = valid[1:] & ((anchors[1:] != anchors[:-1]) | ~valid[:-1])
    # windows of two texts are never neighbours: a text's last length - 1 places begin none
    first = np.flatnonzero(new)
    stop = np.empty(len(anchors), bool)
    stop[-1] = valid[-1]
    stop[:-1] = valid[:-1] & (new[1:] | ~valid[1:])
    last = np.flatnonzero(stop)
    text = np.searchsorted(ends, first, side="right")
    begin = (ends - sizes)[text]
    at = anchors[first]
    return text, first - begin, last - begin, at - begin, hashes[at]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    """Texts as bytes, with their rows, in runs of about ``CHUNK`` bytes."""
    for batch in batches:
        rest = batch.drop_columns(["text"])
        held: list[bytes] = []
        start = size = 0
        for i, text in enumerate(batch.column("text")):
            raw = text.as_buffer()
            held.append(raw.to_pybytes() if raw else b"")
            size += len(held[-1])
            if size >= CHUNK:
                yield held, rest.slice(start, i + 1 - start)
                held, start, size = [], i + 1, 0
        if held:
            yield held, rest.slice(start)


def _hashed(texts: list[bytes], length: int) -> Iterator[tuple[int, list[tuple[int, int, int, int, int]]]]:
    """Per text its segments ``(anchor hash, segment hash, first, last, anchor)``."""
    of, first, last, at, hashes = segments(texts, length)
    borders = np.searchsorted(of, np.arange(len(texts) + 1))
    hashes = hashes.view(np.int64).tolist()
    first, last, at = first.tolist(), last.tolist(), at.tolist()
    for i, text in enumerate(texts):
        yield i, [
            (hashes[k], xxhash.xxh3_64_intdigest(text[first[k] : last[k] + length]) - (1 << 63), first[k], last[k], at[k])
            for k in range(borders[i], borders[i + 1])
        ]


def _anchored(length: int):
    """Segments of all texts; of those a text holds more than once, the first, marked."""

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        names = ["ah", "sh", "id", "tie", "first", "anchor", "windows", "many"]
        for texts, rest in _chunks(batches):
            ids, ties = rest.column("id").to_pylist(), rest.column("tie").to_pylist()
            rows: list[list] = []
            for i, found in _hashed(texts, length):
                own: dict[tuple[int, int], list] = {}
                for ah, sh, first, last, at in found:
                    if (ah, sh) in own:
                        own[ah, sh][-1] = True
                    else:
                        own[ah, sh] = [ah, sh, ids[i], ties[i], first, at - first, last - first + 1, False]
                rows += own.values()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return anchor


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix, of which ``known`` bytes are known."""
    high = min(len(a), len(b))
    if a[known:high] == b[known:high]:
        return high
    low = known
    while low + 1 < high:  # a and b agree up to low, and do not up to high
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low if a[low : low + 1] != b[low : low + 1] else low + 1


class _Node:
    """A branching of the blind trie: how deep it lies and a child per next byte."""

    __slots__ = ("children", "depth")

    def __init__(self, depth: int) -> None:
        self.depth, self.children = depth, {}


def blind_trie(strings: list[bytes], group: list[int], known: int) -> tuple[list[int], list[int]]:
    """Order of the strings in ``group``, which share ``known`` bytes, and the common prefix with the one before.

    The trie holds branching bytes only. A string descends blindly, by its own bytes at the branchings;
    one comparison with a leaf found there tells its true common prefix and where it branches off.
    """

    def byte(i: int, depth: int) -> int:
        return strings[i][depth] if depth < len(strings[i]) else -1

    root: _Node | list[int] = [group[0]]  # a leaf lists equal strings
    for i in group[1:]:
        node = root
        while isinstance(node, _Node):
            node = node.children.get(byte(i, node.depth)) or next(iter(node.children.values()))
        other = node[0]
        shared = common_prefix(strings[i], strings[other], known)
        if shared == len(strings[i]) == len(strings[other]):
            node.append(i)
            continue
        above, node = None, root
        while isinstance(node, _Node) and node.depth < shared:
            above, node = node, node.children[byte(other, node.depth)]
        if isinstance(node, _Node) and node.depth == shared:
            node.children[byte(i, shared)] = [i]
            continue
        split = _Node(shared)
        split.children = {byte(other, shared): node, byte(i, shared): [i]}
        if above is None:
            root = split
        else:
            above.children[byte(other, above.depth)] = split
    order, common, stack = [], [], [(root, known)]
    while stack:
        node, before = stack.pop()
        if isinstance(node, list):
            order += node
            common += [before] + [len(strings[node[0]])] * (len(node) - 1)
        else:
            children = [c for _, c in sorted(node.children.items(), key=lambda kv: kv[0])]
            stack += [(c, node.depth) for c in reversed(children[1:])] + [(children[0], before)]
    return order, common


def sorted_suffixes(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of ``strings`` and the length of each one's common prefix with the one before it.

    Multikey quicksort by single bytes down to ``shallow`` bytes, and a blind trie for each group
    that is still equal there.
    """
    if len(strings) == 2:  # the most frequent case
        order = [0, 1] if strings[0] <= strings[1] else [1, 0]
        return order, [0, common_prefix(*strings)]
    order, common, stack = [], [], [(list(range(len(strings))), 0, 0)]
    while stack:
        group, depth, before = stack.pop()
        if len(group) == 1:
            order.append(group[0])
            common.append(before)
        elif depth >= shallow:
            part, shared = blind_trie(strings, group, depth)
            order += part
            common += [before, *shared[1:]]
        else:
            middle = strings[group[len(group) // 2]][depth : depth + 1]
            less = [i for i in group if strings[i][depth : depth + 1] < middle]
            same = [i for i in group if strings[i][depth : depth + 1] == middle]
            more = [i for i in group if strings[i][depth : depth + 1] > middle]
            parts = []  # the first part is as close to what came before as the group, the others branch here
            for part, deeper in ((less, False), (same, bool(middle)), (more, False)):
                if part and deeper:
                    parts.append((part, depth + 1, depth if parts else before))
                elif part and part is same:  # all end here
                    parts.append((part, shallow, depth if parts else before))
                elif part:
                    parts.append((part, depth, depth if parts else before))
            stack += reversed(parts)
    return order, common


def _common_with(place: int, order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common prefix of the string at one place of a sorted order with every string, by the strings' own numbers.

    Along the order it is the running minimum of the neighbours' common prefixes; 0 stands for the string itself.
    """
    lengths = np.zeros(len(order), np.int32)
    lengths[order[place + 1 :]] = np.minimum.accumulate(common[place + 1 :])
    lengths[order[:place][::-1]] = np.minimum.accumulate(common[1 : place + 1][::-1])
    return lengths


def repeated_windows(contents: list[bytes], anchors: list[int], length: int = LENGTH, shallow: int = SHALLOW) -> list[np.ndarray]:
    """For each segment, which of its windows another segment of the same anchor holds as well.

    Windows meet if their segments agree far enough to the right and to the left of the anchor:
    two sorted orders, of the suffixes from the anchor and of the reversed prefixes up to it. Memory is linear in the segments.
    """

    def sorted_by(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order, common = sorted_suffixes(strings, shallow)
        order = np.array(order)
        places = np.empty(len(order), np.int64)
        places[order] = np.arange(len(order))
        return places, order, np.array(common, np.int32)

    after = sorted_by([c[a : a + length] for c, a in zip(contents, anchors)])
    before = sorted_by([c[:a][::-1] for c, a in zip(contents, anchors)])
    result = []
    for i, (content, anchor) in enumerate(zip(contents, anchors)):
        right, left = (_common_with(places[i], order, common) for places, order, common in (after, before))
        windows = len(content) - length + 1
        # windows that begin from anchor - left up to anchor + right - length
        low = np.maximum(anchor - left, 0)
        high = np.minimum(anchor + right - length, windows - 1)
        ok = low <= high
        ok[i] = False
        marks = np.zeros(windows + 1, np.int32)
        np.add.at(marks, low[ok], 1)
        np.add.at(marks, high[ok] + 1, -1)
        result.append(np.cumsum(marks[:-1]) > 0)
    return result


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of marks."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def _sliced(length: int):
    """Bytes of the segments that a text stands for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
        names = ["ah", "known", "hot", "id", "tie", "first", "anchor", "content"]
        for texts, rest in _chunks(batches):
            ids, ties, wanted = (rest.column(c).to_pylist() for c in ("id", "tie", "wanted"))
            rows = [
                (w["ah"], w["known"], w["hot"], ident, tie, w["first"], w["anchor"], text[w["first"] : w["first"] + w["windows"] + length - 1])
                for text, ident, tie, some in zip(texts, ids, ties, wanted)
                for w in some
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return cut


def _compared(length: int, shallow: int):
    """Spans of the segments that occur once, from partitions sorted by anchor hash."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(group: list[dict]) -> Iterator[tuple]:
            if len(group) > 1 and not all(r["known"] for r in group):
                found = repeated_windows([r["content"] for r in group], [r["anchor"] for r in group], length, shallow)
                for row, marked in zip(group, found):
                    if not row["known"]:
                        for a, b in _runs(marked):
                            yield row["id"], row["tie"], row["first"] + a, row["first"] + b + length

        group: list[dict] = []
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                if group and group[0]["ah"] != row["ah"]:
                    rows += spans(group)
                    group = []
                group.append(row)
            if rows:
                yield _span_batch(rows)
        if rows := list(spans(group)):
            yield _span_batch(rows)

    return compare


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["id", "tie", "begin", "end"])


def _windowed(length: int):
    """Every window of a segment with a digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                content = row["content"]
                n = len(content) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxhash.xxh3_128_digest(content[k : k + length]) for k in range(n)], pa.binary()),
                        pa.array([row["id"]] * n, pa.int64()), pa.array([row["tie"]] * n, pa.int32()),
                        pa.array(range(row["first"], row["first"] + n), pa.int64()), pa.array([row["known"]] * n),
                    ],
                    ["window", "id", "tie", "begin", "known"],
                )

    return cut


def _cut(length: int):
    """Removes the spans, and those of segments a text holds more than once."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, rest in _chunks(batches):
            spans = rest.column("spans").to_pylist()
            out: list[tuple] = []
            for i, found in _hashed(texts, length):
                own: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for ah, sh, first, last, _ in found:
                    own.setdefault((ah, sh), []).append((first, last + length))
                every = [s for group in own.values() if len(group) > 1 for s in group]
                every += [(s["begin"], s["end"]) for s in spans[i] or []]
                kept, removed, n_spans, at = [], 0, 0, 0
                text = texts[i]
                for begin, end in sorted(every):
                    if begin > at or not n_spans:
                        kept.append(text[at:begin])
                        n_spans += 1
                        removed += end - begin
                    elif end > at:
                        removed += end - at
                    at = max(at, end)
                kept.append(text[at:])
                kept = b"".join(kept)
                out.append((len(text), removed, n_spans, kept, kept.decode("utf-8", "ignore")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays([rest.column("row"), *columns], ["row", "n_bytes", "n_removed", "n_spans", "kept", "text"])

    return remove


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_segments: int = MOST_SEGMENTS,
    shallow: int = SHALLOW,
) -> DataFrame:
    """All columns but the text, and ``repeats(n_bytes, n_removed, n_spans, kept, text)``.

    Removes each byte that lies in a string of ``length`` bytes which also starts at any other
    place of any text. ``kept`` are the remaining bytes, ``text`` the whole characters among them,
    ``n_spans`` the number of maximal removed runs.

    The suffix array is a sampled one: of each window one place, its anchor, which equal windows
    share. Only segments (runs of windows with one anchor) whose anchor comes again go on. Segments
    that are wholly equal are found by a digest. The others of an anchor are brought together and
    sorted; neighbours in the order tell how far each two agree. Anchors with more than
    ``most_segments`` different segments are split by window instead, with the same result.

    Null and empty texts have nothing to remove, nor have texts under ``length`` bytes. Repeated
    rows repeat each other. Rows may share an id. An empty table gives an empty result. Columns
    may have any names; one called ``repeats`` is replaced.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text_column, "repeats")]
    rows = docs.select(
        F.struct(*others).alias("row"), F.col(f"`{text_column}`").alias("text"),
        F.col(f"`{id_column}`").cast("long").alias("id"), F.hash(F.col(f"`{text_column}`")).alias("tie"),
    )
    searched = rows.select("id", "tie", "text").where(F.octet_length("text") >= length)
    schema = "ah LONG, sh LONG, id LONG, tie INT, first LONG, anchor INT, windows INT, many BOOLEAN"
    anchored = searched.mapInArrow(freeing(_anchored(length)), schema)
    again = anchored.groupBy("ah").agg(F.count("*").alias("n"), (F.min("sh") == F.max("sh")).alias("alike"))
    again = stored(again.where("n > 1").drop("n"), "repeat-anchors")
    found = stored(anchored.join(again, "ah"), "repeat-segments")

    def whole(segments: DataFrame) -> DataFrame:
        end = F.col("first") + F.col("windows") - 1 + length
        return segments.select("id", "tie", F.col("first").alias("begin"), end.alias("end"))

    mixed = found.where("NOT alike")
    one = F.min(F.struct("id", "tie", "first", "anchor", "windows")).alias("one")
    distinct = mixed.groupBy("ah", "sh").agg(((F.count("*") > 1) | F.max("many")).alias("known"), one)
    distinct = stored(distinct, "repeat-distinct")
    hot = distinct.groupBy("ah").agg(F.count("*").alias("n")).where(F.col("n") > most_segments)
    hot = stored(hot.select("ah", F.lit(True).alias("hot")), "repeat-hot")
    spans = whole(found.where("alike")).unionByName(whole(mixed.join(distinct.where("known").select("ah", "sh"), ["ah", "sh"])))

    wanted = distinct.join(hot, "ah", "left").select("ah", "known", F.coalesce("hot", F.lit(False)).alias("hot"), "one.*")
    wanted = wanted.groupBy(F.col("id").alias("of"), F.col("tie").alias("of_tie")).agg(
        F.collect_list(F.struct("ah", "known", "hot", "first", "anchor", "windows")).alias("wanted")
    )
    contents = searched.join(wanted, F.col("id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("of_tie"))).mapInArrow(
        freeing(_sliced(length)),
        "ah LONG, known BOOLEAN, hot BOOLEAN, id LONG, tie INT, first LONG, anchor INT, content BINARY",
    )
    if n_hot := hot.count():
        contents = stored(contents, "repeat-contents")
    cold = contents.where("NOT hot").drop("hot").repartition("ah").sortWithinPartitions("ah")
    span = "id LONG, tie INT, begin LONG, end LONG"
    spans = spans.unionByName(stored(cold.mapInArrow(freeing(_compared(length, shallow)), span), "repeat-spans"))
    if n_hot:
        windows = contents.where("hot").mapInArrow(freeing(_windowed(length)), "window BINARY, id LONG, tie INT, begin LONG, known BOOLEAN")
        windows = stored(windows, "repeat-windows")
        twice = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
        single = windows.where("NOT known").join(twice, "window")
        spans = spans.unionByName(single.select("id", "tie", "begin", (F.col("begin") + length).alias("end")))

    spans = spans.groupBy(F.col("id").alias("of"), F.col("tie").alias("of_tie")).agg(
        F.collect_list(F.struct("begin", "end")).alias("spans")
    )
    result = rows.join(spans, F.col("id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("of_tie")), "left").select("row", "text", "spans")
    kind = rows.schema["row"].dataType.simpleString()
    result = result.mapInArrow(freeing(_cut(length)), f"row {kind}, n_bytes LONG, n_removed LONG, n_spans LONG, kept BINARY, text STRING")
    return result.select("row.*", F.struct("n_bytes", "n_removed", "n_spans", "kept", "text").alias("repeats"))
