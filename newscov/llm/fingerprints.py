"""Document fingerprints from improbable byte windows in chained Bloom filters."""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscov.llm.common import working_columns

#: Bytes of a window, windows of a neighbourhood, and of how many neighbourhoods a chosen window is the rarest.
WINDOW = 64
NEIGHBOURHOOD, LEAST_WINS = 64, 16
#: The same for texts under so many bytes, which would have few windows otherwise.
SHORT, SHORT_NEIGHBOURHOOD, SHORT_LEAST_WINS = 2_048, 8, 2
#: Texts under so many bytes are represented by all their small windows, those under half of it by nothing else.
TINY, TINY_WINDOW = 512, 8
#: Bytes up to which a text is only a word or two, whose small windows are these.
WORD, WORD_WINDOW = 16, 2
#: Steps of the entropy of a window, and the step below which a window is a mere run.
LEVELS = 1_000
LEAST_LEVEL = 100
#: Bits of a filter, features it takes, and bits a feature sets.
FILTER_BITS = 2_048
FILTER_FEATURES = 160
FEATURE_BITS = 5
#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK = 2 << 20
#: Bytes of text a task gets, ranges of ids per task, and the most ranges.
TASK_BYTES = 16 << 20
RANGES_PER_TASK = 4
MOST_RANGES = 100_000
MARK = "if1"

#: How much a byte's n-th occurrence adds to sum(c log2 c), in whole steps so that sums do not depend on order.
SCALE = 1 << 24
_SUMS = [round(c * math.log2(c) * SCALE) if c else 0 for c in range(WINDOW + 2)]
ADDS = [0] + [_SUMS[c] - _SUMS[c - 1] for c in range(1, WINDOW + 2)]
MIX = 0x9E3779B97F4A7C15


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy of every window of ``data`` in steps from 0 to ``LEVELS``.

    Sliding by a byte changes the sum over c log2 c by what the leaving byte's last and the
    arriving byte's next occurrence add, so counting equal bytes within a window's reach is enough.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    ahead, behind = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = data[:-d] == data[d:]
        ahead[:-d] += same
        behind[d:] += same
    adds = np.array(ADDS, np.int64)
    first = np.bincount(data[:WINDOW], minlength=256)
    sums = np.empty(n - WINDOW + 1, np.int64)
    sums[0] = np.array(_SUMS, np.int64)[first].sum()
    sums[1:] = adds[behind[WINDOW:].astype(np.int64) + 1] - adds[ahead[: n - WINDOW].astype(np.int64) + 1]
    sums = np.cumsum(sums)
    most = round(WINDOW * math.log2(WINDOW) * SCALE)
    return (most - sums) * LEVELS // most


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(texts), np.uint8), ends - sizes, ends


def _inside(starts: np.ndarray, ends: np.ndarray, total: int, width: int) -> np.ndarray:
    """Which places begin a run of ``width`` bytes that stays within one text."""
    change = np.zeros(total + 1, np.int32)
    long = ends - starts >= width
    np.add.at(change, starts[long], 1)
    np.add.at(change, ends[long] - width + 1, -1)
    return np.cumsum(change[:-1]) > 0


def chosen_windows(texts: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text, place)`` of the windows that represent each text, in order.

    A window wins a neighbourhood if it is the rarest in it, the leftmost of equals. Texts in
    which no window wins often enough are represented by their rarest window; tiny ones by none.
    """
    data, starts, ends = _joined(texts)
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    windows = len(data) - WINDOW + 1
    key = (ranks[entropy_levels(data)].astype(np.uint64) << np.uint64(40)) | np.arange(windows, dtype=np.uint64)
    if windows < 1 << 22:  # fits 32 bits, which is faster
        key = ((key >> np.uint64(40)) << np.uint64(22) | (key & np.uint64((1 << 22) - 1))).astype(np.uint32)
        mask = np.uint32((1 << 22) - 1)
    else:
        mask = np.uint64((1 << 40) - 1)
    sizes = ends - starts
    kinds = (
        (SHORT_NEIGHBOURHOOD, SHORT_LEAST_WINS, (sizes >= TINY // 2) & (sizes < SHORT)),
        (NEIGHBOURHOOD, LEAST_WINS, sizes >= SHORT),
    )
    least, width, picked = key, 1, [np.zeros(0, np.int64)]
    for neighbourhood, least_wins, which in kinds:
        while width < neighbourhood and len(least) > width:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width == neighbourhood and which.any():
            valid = _inside(starts[which], ends[which], len(data), WINDOW + neighbourhood - 1)[: len(least)]
            wins = np.bincount((least[valid] & mask).astype(np.int64), minlength=windows)
            picked.append(np.flatnonzero(wins >= least_wins))
    picked = np.sort(np.concatenate(picked))
    texts_of = np.searchsorted(ends, picked, side="right")
    without = np.setdiff1d(np.flatnonzero(sizes >= TINY), texts_of)
    if len(without):
        extra = np.array([starts[t] + int(np.argmin(key[starts[t] : ends[t] - WINDOW + 1])) for t in without])
        picked, texts_of = np.concatenate([picked, extra]), np.concatenate([texts_of, without])
        order = np.argsort(picked, kind="stable")
        picked, texts_of = picked[order], texts_of[order]
    return texts_of, picked


def _feature_hashes(words: np.ndarray, size: int) -> np.ndarray:
    value = np.full(len(words), size, np.uint64)
    for k in range(words.shape[1]):
        value = (value ^ words[:, k]) * np.uint64(MIX)
        value ^= value >> np.uint64(29)
    return value


def bloom_chains(texts: list[bytes], ranks: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Number of features and filters, as rows of bytes, for each text."""
    data, starts, ends = _joined(texts)
    of, at = chosen_windows(texts, ranks)
    reach = np.arange(WINDOW)
    hashes = [np.zeros(0, np.uint64)]
    for k in range(0, len(at), 65_536):
        part = data[at[k : k + 65_536, None] + reach]
        hashes.append(_feature_hashes(part.view("<u8"), WINDOW))
    hashes = np.concatenate(hashes)
    tiny = np.flatnonzero((ends - starts < TINY) & (ends > starts))
    if len(tiny):
        widths = np.where(ends[tiny] - starts[tiny] <= WORD, WORD_WINDOW, TINY_WINDOW)
        counts = np.maximum(1, ends[tiny] - starts[tiny] - widths + 1)
        small_of = np.repeat(tiny, counts)
        nth = np.arange(len(small_of)) - np.repeat(np.cumsum(counts) - counts, counts)
        padded = np.concatenate([data, np.zeros(TINY_WINDOW, np.uint8)])
        reach = np.arange(TINY_WINDOW)
        places = (starts[small_of] + nth)[:, None] + reach
        within = (places < ends[small_of][:, None]) & (reach < np.repeat(widths, counts)[:, None])
        small = np.where(within, padded[places], 0).astype(np.uint8)
        # before the windows of the same text
        of = np.concatenate([small_of, of])
        hashes = np.concatenate([_feature_hashes(small.view("<u8"), TINY_WINDOW), hashes])
    # the first of equal features of a text counts, in order of appearance
    seen = np.lexsort((np.arange(len(of)), hashes, of))
    first = np.ones(len(of), bool)
    first[seen[1:]] = (of[seen[1:]] != of[seen[:-1]]) | (hashes[seen[1:]] != hashes[seen[:-1]])
    of, hashes = of[first], hashes[first]
    order = np.argsort(of, kind="stable")
    of, hashes = of[order], hashes[order]
    counts = np.bincount(of, minlength=len(texts))
    filters = -(-counts // FILTER_FEATURES)
    begin = np.cumsum(filters) - filters
    nth = np.arange(len(of)) - (np.cumsum(counts) - counts)[of]
    bits = np.zeros((int(filters.sum()), FILTER_BITS), bool)
    row = begin[of] + nth // FILTER_FEATURES
    width = FILTER_BITS.bit_length() - 1
    for k in range(FEATURE_BITS):
        bits[row, ((hashes >> np.uint64(k * width)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [(int(c), packed[b : b + f]) for c, b, f in zip(counts, begin, filters)]


def written(chain: tuple[int, np.ndarray]) -> str:
    return f"{MARK}:{chain[0]}:{base64.b64encode(chain[1].tobytes()).decode()}"


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Overlap of two chains beyond chance, from 0 to 1.

    Each filter of the shorter chain meets its best match in the other; filters weigh by their
    number of features. Two empty chains are alike, an empty and another are not.
    """
    if not a[0] or not b[0]:
        return float(a[0] == b[0])
    if (b[0], b[1].tobytes()) < (a[0], a[1].tobytes()):
        a, b = b, a
    other = np.bitwise_count(b[1]).sum(axis=1).astype(np.float64)
    total = 0.0
    for i, row in enumerate(a[1]):
        own = float(np.bitwise_count(row).sum())
        common = np.bitwise_count(b[1] & row).sum(axis=1)
        chance = own * other / FILTER_BITS
        room = np.minimum(own, other) - chance
        score = np.where(room > 0, (common - chance) / np.where(room > 0, room, 1), 0.0).max()
        total += min(1.0, max(0.0, float(score))) * min(FILTER_FEATURES, a[0] - i * FILTER_FEATURES)
    return total / a[0]


def _levels_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each entropy level occurs."""
    counts = np.zeros(LEVELS + 1, np.int64)

    def count(texts: list[bytes]) -> None:
        data, starts, ends = _joined(texts)
        if len(data) >= WINDOW:
            valid = _inside(starts, ends, len(data), WINDOW)[: len(data) - WINDOW + 1]
            counts[:] += np.bincount(entropy_levels(data)[valid], minlength=LEVELS + 1)

    for batch in batches:
        held, size = [], 0
        for text in batch.column("text"):
            raw = text.as_buffer()
            held.append(raw.to_pybytes() if raw else b"")
            size += len(held[-1])
            if size >= CHUNK:
                count(held)
                held, size = [], 0
        count(held)
    yield pa.RecordBatch.from_pydict({"level": np.arange(LEVELS + 1), "n": counts})


def precedence(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy level by its share of all windows of all texts, the rarest first.

    Levels of mere runs come last, as they say little about a text.
    """
    counted = docs.select("text").mapInArrow(_levels_of, "level LONG, n LONG")
    counts = {r.level: r.n for r in counted.groupBy("level").agg(F.sum("n").alias("n")).collect()}  # LEVELS + 1 rows
    order = sorted(range(LEVELS + 1), key=lambda v: (v < LEAST_LEVEL, counts.get(v, 0), -v))
    ranks = np.empty(LEVELS + 1, np.uint16)
    ranks[order] = np.arange(LEVELS + 1)
    return ranks


def _ranges(edges: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Number of the range each id lies in; nulls lie in the first."""
    found = np.searchsorted(edges, ids.fill_null(0).to_numpy(), side="right")
    found[ids.is_null().to_numpy(zero_copy_only=False)] = 0
    return found


def _ranged(edges: np.ndarray):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            yield pa.RecordBatch.from_arrays([pa.array(_ranges(edges, ids)), ids, batch.column("tie")], ["range", "id", "tie"])

    return place


def _dealt(edges: np.ndarray, heads: dict[int, tuple]):
    """Puts rows into ranges of ids, and the first row of a range at the end of the range before as well."""
    order = sorted(heads)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the first follows the last

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            ranges = _ranges(edges, ids)
            firsts = [
                i
                for i, (r, *row) in enumerate(zip(ranges.tolist(), ids.to_pylist(), batch.column("tie").to_pylist()))
                if tuple(row) == heads[r]
            ]
            yield pa.RecordBatch.from_arrays([pa.array(ranges), pa.array(np.zeros(len(ranges), bool)), *batch.columns], ["range", "copy", *batch.schema.names])
            if firsts:
                again = batch.take(pa.array(firsts))
                places = pa.array([before[int(ranges[i])] for i in firsts], pa.int64())
                yield pa.RecordBatch.from_arrays([places, pa.array([True] * len(firsts)), *again.columns], ["range", "copy", *batch.schema.names])

    return deal


def _fingerprinted(ranks: bytes):
    """For each row of a range and the row after it: both fingerprints and both likenesses."""

    def finish(rows: list[tuple], following: list[str], table: np.ndarray) -> pa.RecordBatch:
        edited = []
        for (_, text), then in zip(rows, following):
            half = len(text) // 2
            edited.append((text[: len(text) - half] + then[:half]).encode())
        plain = [text.encode() for _, text in rows]
        chains = bloom_chains(plain + edited + [following[-1].encode()], table)
        own, changed, last = chains[: len(rows)], chains[len(rows) : -1], chains[-1]
        # of consecutive rows, a row's next text is the row after it
        nexts = [own[i + 1] if i + 1 < len(rows) and following[i] is rows[i + 1][1] else None for i in range(len(rows))]
        nexts = [last if n is None and i + 1 == len(rows) else n for i, n in enumerate(nexts)]
        nexts = [bloom_chains([following[i].encode()], table)[0] if n is None else n for i, n in enumerate(nexts)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                pa.array([written(c) for c in own]), pa.array([written(c) for c in changed]),
                pa.array([likeness(a, b) for a, b in zip(own, changed)]),
                pa.array([likeness(a, b) for a, b in zip(own, nexts)]),
            ],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(ranks, np.uint16)
        rows: list[tuple] = []
        following: list[str] = []
        size, waiting = 0, None  # the last row and its range, until the next comes
        for batch in batches:
            for place, copy, ident, text in zip(
                *[batch.column(c).to_pylist() for c in ("range", "copy", "id", "text")]
            ):
                if waiting is not None and waiting[0] == place:
                    rows.append(waiting[1])
                    following.append(text)
                    size += len(text)
                    if size >= CHUNK // 2:
                        yield finish(rows, following, table)
                        rows, following, size = [], [], 0
                waiting = None if copy else (place, (ident, text))
        if rows:
            yield finish(rows, following, table)

    return fingerprint


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next text are.

    Columns: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. The edited text has its last half replaced by the beginning of
    the next document's, by id, the first following the last. Windows of 64 bytes are ranked by
    how rare their entropy is among all windows of the table; those that are the rarest of 16
    neighbourhoods enter Bloom filters, and a full filter is followed by another. Short texts have
    smaller neighbourhoods and tiny ones smaller windows, all of which count.

    Null texts are empty; an empty text has an empty fingerprint. Null ids come first. Rows that
    share an id are ordered by a hash of their text. A single row is its own next. An empty
    table gives an empty result. Other columns are not read. Rows are dealt out by ranges of
    ids and texts move once; the first row of a range is dealt to the range before as well.
    """
    rows = working_columns(docs, id=id_column, text=text_column)
    rows = rows.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = max(1, math.ceil(size / TASK_BYTES))
    n_ranges = min(MOST_RANGES, tasks * RANGES_PER_TASK)
    cuts = F.percentile_approx("id", [i / n_ranges for i in range(1, n_ranges)] or [0.5], max(10_000, 10 * n_ranges))
    edges = np.unique(np.array(rows.agg(cuts).first()[0] or [], np.int64))
    places = rows.select("id", "tie").mapInArrow(_ranged(edges), "range LONG, id LONG, tie LONG")
    firsts = places.groupBy("range").agg(F.min(F.struct("id", "tie")).alias("head")).collect()  # a row per range
    heads = {r["range"]: tuple(r["head"]) for r in firsts}
    ranks = precedence(rows)
    dealt = rows.mapInArrow(_dealt(edges, heads), "range LONG, copy BOOLEAN, id LONG, text STRING, tie LONG")
    dealt = dealt.repartition(tasks, "range").sortWithinPartitions("range", "copy", "id", "tie")
    schema = (
        "id LONG, n_chars LONG, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, "
        "near_edited DOUBLE, near_next DOUBLE"
    )
    return dealt.select("range", "copy", "id", "text").mapInArrow(_fingerprinted(ranks.tobytes()), schema).withColumnRenamed("id", id_column)
