"""Keyword topics and salient words of texts."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import newscov
from newscov.functions.text import clean_tokens, normalise_word, words
from newscov.scale import attach_totals, key_totals, written

cloudpickle.register_pickle_by_value(newscov)

Lexicon = list[tuple[str, str, str]]  # theme, subtheme, term


def _term_key(term: str) -> str:
    """A term as its normalised words, space-separated, the form texts are matched in."""
    return " ".join(re.findall(r"[^\W_]+", normalise_word(term)))


#: Most bytes of terms that travel to every task; larger lexicons are joined.
LEXICON_BYTES = 64 << 20

_TAGS = "array<struct<theme:string,subtheme:string,terms:int>>"
_COUNTS = "array<struct<word:string,tf:int>>"
_LEADING = "array<struct<word:string,tf:int,known:bigint>>"

#: Most words whose document counts travel to every task.
FREQUENT_WORDS = 100_000
#: Weights are ranked to six decimals; what differs by no more than this may be equal there.
ROUNDING = 2e-6


class TermAutomaton:
    """Finds every term of a lexicon in one walk over a text's words, however many terms there are.

    A trie over the terms' words with failure links (Aho and Corasick 1975): where a word does not continue what has been
    matched, the walk falls back to the longest suffix that begins another term.
    """

    def __init__(self, terms: dict[str, list[int]]):
        """``terms``: normalised term to the numbers of its topics."""
        self.next: list[dict[str, int]] = [{}]
        self.topics: list[list[tuple[int, int]]] = [[]]  # per state: (term, topic) of terms that end there
        for number, (term, topics) in enumerate(terms.items()):
            state = 0
            for word in term.split():
                if word not in self.next[state]:
                    self.next[state][word] = len(self.next)
                    self.next.append({})
                    self.topics.append([])
                state = self.next[state][word]
            self.topics[state] += [(number, topic) for topic in topics]
        self.fail = [0] * len(self.next)
        queue = list(self.next[0].values())
        for state in queue:  # grows while it is walked: states by depth
            for word, child in self.next[state].items():
                back = self.fail[state]
                while back and word not in self.next[back]:
                    back = self.fail[back]
                self.fail[child] = self.next[back].get(word, 0)
                self.topics[child] += self.topics[self.fail[child]]
                queue.append(child)

    def hits(self, words: list[str | None]) -> dict[int, int]:
        """Number of different terms of each topic among the words."""
        state, found = 0, set()
        for word in words:
            while state and word not in self.next[state]:
                state = self.fail[state]
            state = self.next[state].get(word, 0)
            if self.topics[state]:
                found.update(self.topics[state])
        return Counter(topic for _, topic in found)


class _SharedLexicon:
    """Topics and terms as they are broadcast; a worker builds the automaton once."""

    def __init__(self, topics: list[tuple[str, str]], terms: dict[str, list[int]]):
        self.topics, self.terms, self.automaton = topics, terms, None

    def tags(self, lists: pa.ListArray, top: int) -> Iterator[list[dict]]:
        """The best topics of every list of words. Words of no term end every match, so of a run of them one is walked."""
        if self.automaton is None:
            self.automaton = TermAutomaton(self.terms)
            self.listed = sorted({word for term in self.terms for word in term.split()})
            self.named = np.array([None, *self.listed], object)
        flat, offsets = lists.flatten(), lists.offsets.to_numpy()
        code = pc.index_in(flat, pa.array(self.listed, pa.string())).fill_null(-1).to_numpy() + 1
        walked = np.flatnonzero((code > 0) | np.r_[False, code[:-1] > 0])
        ends = np.searchsorted(walked, offsets - offsets[0])
        for start, stop in zip(ends[:-1], ends[1:]):
            hits = self.automaton.hits(self.named[code[walked[start:stop]]].tolist())
            best = sorted(hits, key=lambda t: (-hits[t], self.topics[t][1], self.topics[t][0]))[:top]
            yield [{"theme": self.topics[t][0], "subtheme": self.topics[t][1], "terms": hits[t]} for t in best]


def _topics_and_terms(lexicon: Lexicon) -> tuple[list[tuple[str, str]], dict[str, list[int]]]:
    """Topics, and for every normalised term the numbers of its topics. Terms without a word find nothing."""
    topics = sorted({(theme, subtheme) for theme, subtheme, _ in lexicon})
    number = {topic: n for n, topic in enumerate(topics)}
    terms: dict[str, set[int]] = {}
    for theme, subtheme, term in lexicon:
        if key := _term_key(term):
            terms.setdefault(key, set()).add(number[theme, subtheme])
    return topics, {term: sorted(of_term) for term, of_term in terms.items()}


def topic_tags(texts: DataFrame, lexicon: Lexicon, *keep: str, text: str = "text", top: int = 3) -> DataFrame:
    """The ``top`` subthemes of each text by number of distinct lexicon terms it contains.

    The lexicon is broadcast once and matched by ``TermAutomaton`` in one walk over each text, so no text is
    shuffled and the plan does not grow with the terms; one of more than ``LEXICON_BYTES`` is joined to the texts' phrases.
    Ties go by subtheme and theme name.
    """
    topics, terms = _topics_and_terms(lexicon)
    if sum(len(t.encode()) for t in terms) > LEXICON_BYTES:
        return _tags_by_join(texts, topics, terms, *keep, text=text, top=top)
    shared = texts.sparkSession.sparkContext.broadcast(_SharedLexicon(topics, terms))

    @F.arrow_udf(_TAGS)
    def tag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("theme", pa.string()), ("subtheme", pa.string()), ("terms", pa.int32())]))
        for batch in batches:
            yield pa.array(shared.value.tags(batch, top), kind)

    tagged = texts.select(*keep, tag(words(F.col(text))).alias("_tags"))
    return tagged.select(*keep, F.posexplode("_tags").alias("_rank", "_tag")).select(
        *keep, (F.col("_rank") + 1).alias("rank"), "_tag.theme", "_tag.subtheme", "_tag.terms"
    )


def _tags_by_join(
    texts: DataFrame, topics: list[tuple[str, str]], terms: dict[str, list[int]], *keep: str, text: str, top: int
) -> DataFrame:
    """``topic_tags`` for lexicons too large to broadcast: the texts' phrases meet the terms in a join."""
    spark = texts.sparkSession
    found = texts.select(*keep, F.monotonically_increasing_id().alias("_row"), words(F.col(text)).alias("_words"))

    def phrases(length: int) -> Column:
        n = F.greatest(F.size("_words"), F.lit(0))
        shifted = [F.slice("_words", 1 + i, n).alias(f"w{i}") for i in range(length)]
        # runs past the last word are shorter: phrases of the text as well
        return F.transform(F.arrays_zip(*shifted), lambda run: F.concat_ws(" ", *[run[f"w{i}"] for i in range(length)]))

    every = F.array_distinct(F.concat(*[phrases(n) for n in sorted({len(t.split()) for t in terms})]))
    spoken = found.select("_row", F.explode(every).alias("phrase"))
    listed = spark.createDataFrame(
        [(term, *topics[t]) for term, of_term in terms.items() for t in of_term], "phrase STRING, theme STRING, subtheme STRING"
    )
    hits = spoken.join(listed, "phrase").groupBy("_row", "theme", "subtheme").agg(F.count("*").cast("int").alias("terms"))
    best = Window.partitionBy("_row").orderBy(F.desc("terms"), "subtheme", "theme")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return found.drop("_words").join(ranked, "_row").select(*keep, "rank", "theme", "subtheme", "terms")


def with_word_counts(
    texts: DataFrame, name: str, text: str = "text", language: str = "french"
) -> DataFrame:
    """Add ``name``, the different clean words of each text and how often it has them (``word``, ``tf``).

    Counted within the row, Arrow batch by Arrow batch, so that the words need no shuffle. A null text has no list.
    """

    @F.arrow_udf(_COUNTS)
    def counted(lists: pa.Array) -> pa.Array:
        return counted_words(lists)

    # nondeterministic: no filter that moves below it makes Spark evaluate it once more
    return texts.withColumn(name, counted.asNondeterministic()(clean_tokens(F.col(text), language)))


def counted_words(lists: pa.ListArray) -> pa.ListArray:
    """The different words of every list in order, with their counts; null lists stay null."""
    sizes = np.diff(lists.offsets.to_numpy())
    sizes[lists.is_null().to_numpy(zero_copy_only=False)] = 0
    encoded = lists.flatten().dictionary_encode()
    listed = encoded.dictionary
    order = pc.sort_indices(listed).to_numpy()
    place = np.empty(len(listed), np.int64)
    place[order] = np.arange(len(listed))
    row = np.repeat(np.arange(len(lists)), sizes)
    key, tf = np.unique(row * max(len(listed), 1) + place[encoded.indices.to_numpy()], return_counts=True)
    row, at = np.divmod(key, max(len(listed), 1))
    words = pa.StructArray.from_arrays([listed.take(pa.array(order[at])), pa.array(tf, pa.int32())], ["word", "tf"])
    ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(lists)))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), words, mask=lists.is_null())


def word_lists(texts: DataFrame, row_id: str, text: str = "text", language: str = "french") -> DataFrame:
    """``words`` of each text and how often it has them (``tf``), as one list per text."""
    return with_word_counts(texts.select(row_id, text), "words", text, language).select(row_id, "words")


def salient_words(
    texts: DataFrame, row_id: str, text: str = "text", language: str = "french", top: int = 3
) -> DataFrame:
    """The ``top`` words of each text by term frequency times inverse document frequency.

    Weights are rounded to six decimals before ranking; ties go alphabetically. Texts are cut
    into words once; the lists are held in the checkpoint folder, without the texts.
    """
    return salient_of_lists(written(word_lists(texts, row_id, text, language), "word-lists"), row_id, top)


def salient_of_lists(lists: DataFrame, row_id: str, top: int = 3) -> DataFrame:
    """``salient_words`` from stored ``word_lists``, which are read more than once.

    The most frequent words travel to every task with their document counts. Of a text's frequent words only those that
    may be among its ``top`` go on; the others meet their counts in a join.
    """
    every = lists.select(row_id, F.inline("words"))
    spread = key_totals(every, "word", {"df": F.count("*")})
    # Words of a single text, most of any vocabulary, need no entry: absent means 1.
    repeated = spread.where("df > 1")
    n_texts = lists.agg(F.count("*")).first()[0]
    frequent = repeated.select("word", "df").orderBy(F.desc("df"), "word").limit(FREQUENT_WORDS).toArrow()
    weighted = attach_totals(lists.select(row_id, F.inline(_leading(lists.sparkSession, frequent, n_texts, top))), "word", repeated)
    weight = F.round(F.col("tf") * F.log((F.lit(n_texts).cast("long") + 1) / (F.coalesce("known", "df", F.lit(1)) + 1)), 6)
    best_first = Window.partitionBy(row_id).orderBy(F.desc("weight"), "word")
    return (
        weighted.select(row_id, "word", weight.alias("weight"))
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= top)
    )


def _leading(spark: SparkSession, frequent: pa.Table, n_texts: int, top: int) -> Column:
    """Of each text's ``words`` those that may be among its ``top``, with the ``known`` document counts of frequent ones.

    Words that are not frequent all stay.
    """
    shared = spark.sparkContext.broadcast((frequent.column("word").combine_chunks(), frequent.column("df").to_numpy()))

    @F.arrow_udf(_LEADING)
    def leading(lists: pa.Array) -> pa.Array:
        return leading_words(lists, *shared.value, n_texts, top)

    return leading("words")


def leading_words(lists: pa.ListArray, frequent: pa.StringArray, df: np.ndarray, n_texts: int, top: int) -> pa.ListArray:
    """``_leading`` for a batch of lists. Weights closer than rounding could tell apart count as equal, and all of them stay."""
    sizes = np.diff(lists.offsets.to_numpy())
    sizes[lists.is_null().to_numpy(zero_copy_only=False)] = 0
    row, entries = np.repeat(np.arange(len(lists)), sizes), lists.flatten()
    word, tf = entries.field("word"), entries.field("tf")
    encoded = word.dictionary_encode()
    place = pc.index_in(encoded.dictionary, frequent).fill_null(-1).to_numpy()[encoded.indices.to_numpy()]
    known = np.flatnonzero(place >= 0)
    weight = tf.to_numpy()[known] * np.log((n_texts + 1) / (df[place[known]] + 1))
    order = np.lexsort((-weight, row[known]))
    found = np.bincount(row[known], minlength=len(lists))
    last = np.cumsum(found) - found + np.minimum(found, top) - 1  # the place in the order of each text's top-th best
    least = np.full(len(lists), -np.inf)
    least[found > 0] = weight[order][last[found > 0]]
    keep = place < 0
    keep[known] = weight >= least[row[known]] - ROUNDING
    at = np.flatnonzero(keep)
    counts = pa.array(df[place[at]] if len(df) else np.zeros(len(at), np.int64), pa.int64(), mask=place[at] < 0)
    kept = pa.StructArray.from_arrays([word.take(pa.array(at)), tf.take(pa.array(at)), counts], ["word", "tf", "known"])
    ends = np.r_[0, np.cumsum(np.bincount(row[at], minlength=len(lists)))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), kept)


def top_words(salient: DataFrame, row_id: str) -> DataFrame:
    """Salient words as one ranked list per text."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "word")))
    return salient.groupBy(row_id).agg(F.transform(ranked, lambda w: w["word"]).alias("top_words"))
