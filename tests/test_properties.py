"""Random inputs against plain Python, many values per Spark job."""

import json
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newscov.functions import answers as A
from newscov.functions import text as T
from newscov.operators import topics
from newscov.operators.evaluate import multilabel_metrics

LETTERS = "abcxyzABCéÉàÀçÇœŒæßñ"
TEXTS = st.lists(st.text(alphabet=LETTERS + " '-.,!?0123456789\n😀", max_size=60), min_size=1, max_size=60)
few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, x STRING")


def collected(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@few
@given(TEXTS)
def test_tokens(spark, texts):
    want = [re.findall(r"(?:[^\W_]|[_'’])+", T.normalise_word(t)) for t in texts]
    assert collected(column(spark, texts), T.tokens(F.col("x"))) == want


@few
@given(TEXTS, st.integers(1, 9))
def test_chunks_rebuild_the_text(spark, texts, size):
    for text, chunks in zip(texts, collected(column(spark, texts), T.chunks(F.col("x"), size))):
        assert "".join(chunks) == text
        assert len(chunks) == (len(text) // size + 1 if len(text) >= size else 1)
        assert all(len(c) == size for c in chunks[:-1])


@few
@given(TEXTS)
def test_word_counts(spark, texts):
    stops = set(T.stop_words("french"))
    got = {(r.i, w.word): w.tf for r in topics.word_lists(column(spark, texts), "i", "x").collect() for w in r.words}
    want = {}
    for i, text in enumerate(texts):
        for word, n in Counter(re.findall(r"(?:[^\W_]|[_'’])+", T.normalise_word(text))).items():
            if word not in stops and word.isalpha():
                want[i, word] = n
    assert got == want


def python_block(answer):
    match = re.search(r"\{[^{}]*\}", answer.split("Réponse :\n")[-1], re.DOTALL)
    return match.group(0) if match else None


def python_first_block(answer):
    return "{" + answer.partition("{")[2].partition("}")[0] + "}"


PIECES = st.sampled_from(["{", "}", "Réponse :\n", '"Classe_1"', ": ", '"a"', ", ", "\n", "x", "'", '"Classe_2": null', "{}"])


@few
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=1, max_size=80))
def test_answer_blocks(spark, answers):
    df = column(spark, answers)
    assert collected(df, A.marked_block(F.col("x"))) == [python_block(a) for a in answers]
    blocks = [python_first_block(a) for a in answers]
    assert collected(df, A.first_block(F.col("x"))) == blocks
    for block, parsed in zip(blocks, collected(column(spark, blocks), A.parse_json(F.col("x")))):
        try:
            want = json.loads(block)
        except json.JSONDecodeError:
            want = None
        assert parsed == want


LABELS = st.lists(st.sampled_from("abcdef"), max_size=4)


@few
@given(st.lists(st.tuples(LABELS, LABELS), min_size=1, max_size=40))
def test_perfect_and_repeated_predictions(spark, rows):
    codes = list("abcde")
    schema = "truth ARRAY<STRING>, predicted ARRAY<STRING>"
    perfect = multilabel_metrics(spark.createDataFrame([(t, t) for t, _ in rows], schema), codes).first()
    full = 100.0 if any(set(t) & set(codes) for t, _ in rows) else 0.0
    assert (perfect.precision, perfect.recall, perfect.f1) == (full, full, full)
    once = multilabel_metrics(spark.createDataFrame(rows, schema), codes).first()
    twice = multilabel_metrics(spark.createDataFrame([(t + t, p + p) for t, p in rows], schema), codes).first()
    assert (once.precision, once.recall, once.f1, once.top1) == (twice.precision, twice.recall, twice.f1, twice.top1)
