"""Packing token sequences: best fit over a histogram of lengths, then slots by rank."""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from newscov.llm.common import freeing, stored, working_columns

#: Tokens of a sequence, and the id that ends each document.
CAPACITY = 4_096
END_ID = 1
#: Strings encoded at once, words that are encoded as one line, and pieces of one length ranked together.
ENCODED_AT_ONCE = 10_000
JOINED = 200
RANKED_TOGETHER = 50_000
#: Characters of the texts whose different words are encoded together.
CHARS_AT_ONCE = 8 << 20

# --- fixed values: how a lower-casing word vocabulary prepares texts ----------------
WORDS_NORMALIZER = r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])'
WORDS_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
# --- end of fixed values ------------------------------------------------------------

#: The words of a text that are no run of letters; blanks around them part the runs as well.
NO_LETTERS = WORDS_SPLIT.replace(r"[\p{L}]+|", "")
#: Texts of these characters are composed already, and lower case, letters and digits mean the same to
#: Python and the tokenizer.
PLAIN = re.compile(r"[\t\n\r -~\xa1-\xac\xae-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f\u2010-\u2027\u20ac]*")


class Encoder:
    """Token ids of texts, as bytes of little-endian unsigned 32-bit numbers.

    For a lower-casing word vocabulary texts are cut at blanks, which none of its tokens reaches
    across; what stands between them is encoded once for all texts of a call. What is plain is cut into the words that
    the vocabulary's own pattern finds, so that punctuation makes no new ones. Words go to the tokenizer joined by blanks;
    the last token of each bears the end of a word, which parts the words' ids. Texts with the name of a special token
    and other kinds of vocabularies are encoded as they are. Nothing is kept from one call to the next.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        split, model = str(self.tokenizer.pre_tokenizer), self.tokenizer.model
        self.by_blank = str(self.tokenizer.normalizer) == WORDS_NORMALIZER and f'Regex("{WORDS_SPLIT}")' in split
        self.by_word = None
        end, vocabulary = getattr(model, "end_of_word_suffix", None), self.tokenizer.get_vocab(with_added_tokens=False)
        # every byte has a token within and one at the end of a word: none is left out, and no word lacks its end
        if self.by_blank and end and not model.ignore_merges and all({c, c + end} <= vocabulary.keys() for c in ByteLevel.alphabet()):
            self.by_word = Tokenizer(model)
            self.by_word.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[ident for token, ident in vocabulary.items() if token.endswith(end)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, encode: Callable, strings: list[str]) -> Iterator[bytes]:
        for at in range(0, len(strings), ENCODED_AT_ONCE):
            for found in encode(strings[at : at + ENCODED_AT_ONCE], add_special_tokens=False):
                ids = found.ids
                yield struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if not self.by_blank:
            yield from self._ids(self.tokenizer.encode_batch_fast, texts)
            return
        found: list[bytes] = [b""] * len(texts)
        plain = [i for i, t in enumerate(texts) if self._is_plain(t)]
        rest = sorted(set(range(len(texts))).difference(plain))
        for i, ids in zip(plain, self._plain([texts[i].lower() for i in plain])):
            found[i] = ids
        cut = [[texts[i]] if any(n in texts[i] for n in self.special) else texts[i].replace("\n", " ").split(" ") for i in rest]
        new: dict[bool, list[str]] = {True: [], False: []}
        for s in {s for strings in cut for s in strings}:
            new[self._is_plain(s)].append(s)
        known = dict(zip(new[True], self._plain([s.lower() for s in new[True]])))
        known |= zip(new[False], self._ids(self.tokenizer.encode_batch_fast, new[False]))
        for i, strings in zip(rest, cut):
            found[i] = b"".join(map(known.__getitem__, strings))
        yield from found

    def _is_plain(self, text: str) -> bool:
        return bool(self.by_word and PLAIN.fullmatch(text)) and not any(name in text for name in self.special)

    def _plain(self, texts: list[str]) -> Iterator[bytes]:
        """Looks each different word up once and copies its ids to all places by array operations."""
        if not texts:
            return
        parted = pa.compute.replace_substring_regex(pa.array(texts, pa.large_string()), NO_LETTERS, r" \0 ")
        split = pa.compute.ascii_split_whitespace(parted)
        words = split.flatten().dictionary_encode()
        every = self._joined(words.dictionary).take(words.indices)
        _, ends, data = every.buffers()
        ids = memoryview(data or b"")
        borders = np.frombuffer(ends, np.int64)[np.asarray(split.offsets)].tolist()
        for begin, end in zip(borders, borders[1:]):
            yield ids[begin:end].tobytes()

    def _joined(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of each word; the empty string has none."""
        some = pa.compute.greater(pa.compute.binary_length(words), 0).to_numpy(zero_copy_only=False)
        starts = np.append(np.arange(0, len(words), JOINED, np.int32), np.int32(len(words)))
        lines = pa.compute.binary_join(pa.ListArray.from_arrays(starts, words.cast(pa.string())), " ").to_pylist()
        found = [np.zeros(0, "<u4")]
        for at in range(0, len(lines), JOINED):
            found += [np.array(line.ids, "<u4") for line in self.by_word.encode_batch_fast(lines[at : at + JOINED], add_special_tokens=False)]
        ids = np.concatenate(found)
        sizes = np.zeros(len(words) + 1, np.int64)
        sizes[1:][some] = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(4 * np.cumsum(sizes)), pa.py_buffer(ids)])


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, which keeps it from one task to the next.

    A task has one core: threads of the tokenizer would share it and wait for each other.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = sys.modules.setdefault("_kept_encoders", ModuleType("_kept_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _pieces(path: str, capacity: int, end_id: int, chars_at_once: int = CHARS_AT_ONCE):
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode

        def out(ids: list, texts: list[str]) -> pa.RecordBatch:
            rows = []
            for ident, data in zip(ids, encode(texts)):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((ident, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "piece", "start", "length", "ids_crc32"]
            )

        for batch in batches:
            ids, texts, size = [], [], 0
            for ident, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids.append(ident)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= chars_at_once:
                    yield out(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield out(ids, texts)

    return cut


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over ``{length: pieces}``.

    Rows ``(length, rank, pieces, sequence, offset, each)``: pieces of that length from that rank
    on go, ``each`` to a sequence and one after the other, to consecutive sequences from that
    offset. A piece goes where least room is left, so a sequence takes several pieces of a length
    before the next; sequences with equal room are handled together, whatever their number.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # free places -> (sequence, number)
    rows, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        free = length
        while left:
            while free < capacity and not room[free]:
                free += 1
            each = free // length
            if free < capacity:
                first, n = room[free].pop()
            else:
                first, n = opened, -(-left // each)
            used = min(n, -(-left // each))
            if free == capacity:
                opened += used
            elif used < n:
                room[free].append((first + used, n - used))
            placed = min(left, used * each)
            rows.append((length, rank, placed, first, capacity - free, each))
            full = placed // each
            if full:
                room[free - each * length].append((first, full))
            if placed % each:
                room[free - placed % each * length].append((first + full, 1))
            left -= placed
            rank += placed
    return rows


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` for every piece of every document.

    A document is its ids and then ``end_id``; only those longer than ``capacity`` are cut, into
    pieces of that length. The driver plans over the number of pieces of each length, at most
    ``capacity`` rows. Pieces are then ranked within their length and look up their slot by rank.

    ``tokenizer`` is the path of the vocabulary on the executors. Null texts are empty; an empty
    text is one piece with ``end_id``. Repeated rows are packed as often as they come. An empty
    table gives an empty result. Other columns are not read. Pieces of one length are ranked in
    parts, whose numbers add up, so a frequent length does not fill one task.
    """
    rows = working_columns(docs, id=id_column, text=text_column)
    rows = rows.withColumn("id", F.col("id").cast("long"))
    schema = "id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"
    pieces = stored(rows.mapInArrow(freeing(_pieces(tokenizer, capacity, end_id)), schema), "pack-pieces")
    lengths = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = docs.sparkSession.createDataFrame(
        plan(lengths, capacity), "length LONG, rank LONG, pieces LONG, first LONG, begin LONG, each LONG"
    )
    slots = slots.groupBy("length").agg(F.collect_list(F.struct("rank", "pieces", "first", "begin", "each")).alias("slots"))

    parts = max(1, -(-sum(lengths.values()) // RANKED_TOGETHER))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(parts)))
    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(order) - 1).join(sizes, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).join(slots, "length")
    rank = F.col("rank")
    slot = F.filter("slots", lambda s: (rank >= s["rank"]) & (rank < s["rank"] + s["pieces"]))[0]
    ranked = ranked.withColumn("slot", slot).withColumn("nth", rank - F.col("slot.rank"))
    return ranked.select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32",
        (F.col("slot.first") + F.floor(F.col("nth") / F.col("slot.each"))).alias("sequence_id"),
        (F.col("slot.begin") + F.col("nth") % F.col("slot.each") * F.col("length")).alias("offset"),
    )
