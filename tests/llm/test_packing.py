import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newscov.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = P.Encoder(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def packed(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id LONG, text STRING, length STRING")
    return P.pack(df, PATH, **more).collect()


def check_layout(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_and_layout(spark):
    texts = ["Hello, world's end! <|endoftext|>", None, "", "İstanbul ΑΣ ß ﬁ ①", "a b c\tdd\x1cee\n\nf", "word " * 900, "It's 42 été"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, ""), (2, "")]
    got = packed(spark, rows, capacity=64)
    expected = []
    for i, t in rows:
        ids = np.array(ids_of(t), "<u4")
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            expected.append((i, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
    check_layout(got, 64)


def test_empty_table(spark):
    assert packed(spark, []) == []


def test_other_vocabularies_take_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, "Some  text,\n with words.")], "doc_id LONG, text STRING")
    ids = np.array([*Tokenizer.from_file(path).encode("Some  text,\n with words.", add_special_tokens=False).ids, 7], "<u4")
    (row,) = P.pack(df, path, end_id=7).collect()
    assert (row.length, row.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


@given(st.lists(st.one_of(st.text(max_size=60), st.text("aZé's _-²½9İΣ\u0301\x1c\xa0\xad\n'<|", max_size=30)), max_size=8))
@settings(max_examples=300, deadline=None)
def test_encoder_agrees_with_the_tokenizer(texts):
    expected = [np.array(e.ids, "<u4").tobytes() for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert list(ENCODER.encode(texts)) == expected


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_everything_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 4096])
    counts = {rng.randrange(1, capacity + 1): rng.randrange(1, 5000) for _ in range(rng.randrange(1, 60))}
    used, ranks = {}, {}
    for length, rank, pieces, first, begin, each in P.plan(counts, capacity):
        assert rank == ranks.get(length, 0)
        ranks[length] = rank + pieces
        for k in range(pieces):
            used.setdefault(first + k // each, []).append((begin + k % each * length, length))
    assert ranks == counts
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(a * b for a, b in counts.items())
    longest = sum(n for length, n in counts.items() if length > capacity / 2)
    assert len(used) <= 11 / 9 * max(-(-total // capacity), longest) + 1


def test_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "RANKED_TOGETHER", 10)
    rows = [(i, "same words") for i in range(200)]
    got = packed(spark, rows, capacity=16)
    assert len({(r.sequence_id, r.offset) for r in got}) == 200
    check_layout(got, 16)


@pytest.mark.parametrize("seed", range(40))
def test_plan_needs_no_more_sequences_than_best_fit_by_piece(seed):
    """Best fit, longest first, piece after piece: each goes where least room is left."""
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100, 4096])
    lengths = [min(capacity, max(1, int(rng.lognormvariate(rng.choice([1, 3, 6]), 1)))) for _ in range(rng.randrange(1, 200))]
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [n for n, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda n: rooms[n])] -= length
        else:
            rooms.append(capacity - length)
    rows = P.plan(Counter(lengths), capacity)
    used = {s for _, _, pieces, first, _, each in rows for s in range(first, first - (-pieces // each))}
    assert len(used) <= len(rooms)


def test_encoder_keeps_no_strings():
    encoder = P.Encoder(PATH)
    sizes = {name: len(kept) for name, kept in vars(encoder).items() if hasattr(kept, "__len__")}
    texts = [f"mot{n} l'eau's\tw{n}.%%% 12été\r\n" * 3 for n in range(500)] + ["", " ", "\n", "'s\n't", "ċ Ċ Ċ"]
    assert [list(np.frombuffer(x, "<u4")) for x in encoder.encode(texts)] == [ids_of(t)[:-1] for t in texts]
    assert {name: len(kept) for name, kept in vars(encoder).items() if hasattr(kept, "__len__")} == sizes


def test_workers_encode_without_threads(monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    P.encoder(PATH)
    assert P.os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_words_are_encoded_once_whatever_stands_beside_them(monkeypatch):
    seen, encode = [], P.Encoder._joined
    monkeypatch.setattr(P.Encoder, "_joined", lambda self, words: seen.extend(map(str, words)) or encode(self, words))
    texts = ['Word, word. (word) "WORD" word\'s 1234 !\'s word_word', "word\n\nword\t--- 4321 été,word''s 'tis 'word's'"]
    assert [list(np.frombuffer(x, "<u4")) for x in P.Encoder(PATH).encode(texts)] == [ids_of(t)[:-1] for t in texts]
    seen = [s for s in seen if s]
    assert len(seen) == len(set(seen))
    assert [s for s in seen if "word" in s] == ["word"] and [s for s in seen if "1" in s] == ["1"]


def test_plain_words_of_other_texts_are_encoded_once_as_well(monkeypatch):
    seen, encode = [], P.Encoder._joined
    monkeypatch.setattr(P.Encoder, "_joined", lambda self, words: seen.extend(map(str, words)) or encode(self, words))
    texts = ["Word, word. (word) \u2603 word\u2603", "word's\n\u0130 word!", "word <|endoftext|> word \u2603"]
    assert [list(np.frombuffer(x, "<u4")) for x in P.Encoder(PATH).encode(texts)] == [ids_of(t)[:-1] for t in texts]
    assert [s for s in seen if "word" in s] == ["word"]


@pytest.mark.parametrize("change", [{"ignore_merges": True}, {"end_of_word_suffix": None}, "a</w>"])
def test_word_vocabularies_without_an_end_for_each_word(tmp_path, change):
    vocabulary = json.load(open(PATH))
    if isinstance(change, dict):
        vocabulary["model"] |= change
    else:
        del vocabulary["model"]["vocab"][change]
        vocabulary["model"]["merges"] = [m for m in vocabulary["model"]["merges"] if change not in m and "".join(m) != change]
    path = tmp_path / "words.json"
    path.write_text(json.dumps(vocabulary))
    texts = ["It's a word, 12 words!", "thea a", ""]
    expected = [e.ids for e in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]
    assert [list(np.frombuffer(x, "<u4")) for x in P.Encoder(str(path)).encode(texts)] == expected
