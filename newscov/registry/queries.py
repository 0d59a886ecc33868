"""Every registered query: (session, data folder) -> DataFrame.

Dates leave as text and measured values with six decimals, so that results
compare equal across engines.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.functions import answers as A
from newscov.functions import dates as D
from newscov.functions.text import chunks, clean_tokens, words
from newscov.operators import batches, categories, compare, coverage, detect, evaluate, explore, guided, prompts, splits, topics
from newscov.operators.parse import with_classes
from newscov.registry import views as V
from newscov.scale import PageIndex, use_checkpoint_dir, with_position, written
from newscov.schemas import PREDICTION_COLUMNS
from newscov.sources import increments
from newscov.sources.readers import read_any, read_lexicon
from newscov.sources.sinks import append_metrics, store_articles, write_result, write_splits
from newscov.taxonomy import DISPLAY_NAMES, MACRO_CODES, METRIC_CODES, THEMES

# Words that occur in the test documents.
LEXICON = [
    ("solution", "fr", "pour"),
    ("solution", "fr", "Eau"),
    ("conséquence", "fr", "une"),
    ("conséquence", "fr", "que"),
    ("conséquence", "fr", "de la"),
    ("cause", "en", "that"),
    ("cause", "en", "with"),
    ("cause", "en", "of the"),
]

# Words by which topics are told to start: one topic per language of the test documents.
SEED_LEXICON = [
    ("langue", "fr", "eau"), ("langue", "fr", "eaux"), ("langue", "fr", "ment"),
    ("langue", "en", "that"), ("langue", "en", "with"),
    ("langue", "de", "nicht"), ("langue", "de", "auf"),
    ("langue", "es", "para"), ("langue", "es", "los"),
]

COLOURS = {f"media{i}": f"#{i}{i}{i}{i}{i}{i}" for i in range(6)}

SELECTION = ["pollution", "secheresse", "deforestation", "couche_ozone"]

EXAMPLES = {"raw": ["Exemple brut"], "COT": ["Exemple raisonné"], "CARP": ["Exemple avec indices"]}

REFINE_MESSAGE = "Donne la classe."


# What this application has built and stored: (kind, application, data folder) -> folder.
_STORED: dict[tuple[str, str, str], str] = {}


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def _text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def _coverage(period: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _text(_rounded(coverage.coverage(V.articles(spark, sf_dir), period), "ratio"), "period")

    return run


def _new_folder(spark, name: str) -> str:
    """A name for a new folder in the shared folder."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def coverage_incremental(spark, sf_dir):
    """Coverage per day from counts that two loads have stored, the second of which finds the first one's files counted."""
    rows, folder = V.articles(spark, sf_dir).select("article_id", "date", "media", "label"), _new_folder(spark, "increments")

    def read(spark, files):
        return spark.read.schema(rows.schema).parquet(*files)

    for part in (0, 1):
        rows.where(F.col("article_id") % 2 == part).write.parquet(f"{folder}/in/drop{part}")
        increments.load(spark, f"{folder}/in", f"{folder}/store", read, "*.parquet")
    return _text(_rounded(increments.coverage_of(increments.stored_counts(spark, f"{folder}/store"), "day"), "ratio"), "period")


def stored_texts(spark, sf_dir):
    """Documents written as delimited text and as Parquet, read back by file type and compared, by outlet."""
    folder = _new_folder(spark, "texts")
    rows = V.documents(spark, sf_dir)
    write_result(rows, f"{folder}/texts", "csv")
    write_result(rows, f"{folder}/texts.parquet")
    kinds = {"delimited": read_any(spark, f"{folder}/texts"), "parquet": read_any(spark, f"{folder}/texts.parquet")}
    digest = F.sum(F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).alias("checksum")
    tables = [
        table.groupBy("media").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), digest).withColumn("kind", F.lit(kind))
        for kind, table in kinds.items()
    ]
    met = tables[0].unionByName(tables[1]).groupBy("media", "n", "chars", "checksum").agg(F.count("*").alias("kinds"))
    return met.select("media", "n", "chars", "kinds")


def stored_articles(spark, sf_dir):
    """Articles stored by month and read back for some days, per outlet."""
    folder = _new_folder(spark, "articles")
    store_articles(V.articles(spark, sf_dir).select("article_id", "date", "media", "label"), folder)
    weeks = coverage.in_dates(spark.read.parquet(folder), date(2024, 1, 10), date(2024, 1, 20))
    return weeks.groupBy("media").agg(F.count("*").alias("n"), F.sum("label").alias("on_topic"))


def stored_splits(spark, sf_dir):
    """Sizes of the three parts as they are stored."""
    folder = _new_folder(spark, "splits")
    write_splits(stratified_split(spark, sf_dir), folder)
    return splits.split_sizes(spark.read.parquet(folder))


def stored_metrics(spark, sf_dir):
    """Metrics of every run, appended twice under one name: one copy stays."""
    folder = _new_folder(spark, "metrics")
    for run in ("first", "first", "second"):
        append_metrics(metrics_by_run(spark, sf_dir), folder, run)
    return spark.read.parquet(folder).groupBy("source").agg(F.count("*").alias("copies"), F.max("f1").alias("f1"))


def detector_invariants(spark, sf_dir):
    """What the tables of a fitted detector owe each other and the held-out texts."""
    detector, test = _fitted(spark, sf_dir)
    scored = written(detect.predict(detector, test).drop("text"), "detector-test")
    tables = detect.evaluate(scored, weights=detector.weights)
    by_class = scored.groupBy(F.col("label").alias("actual")).agg(
        F.count("*").alias("n"), F.count_if(F.col("climate_related") == F.col("label")).alias("hits")
    )
    matrix = tables["confusion"].select("actual", (F.col("predicted_0") + F.col("predicted_1")).alias("of_row"), F.when(
        F.col("actual") == 1, F.col("predicted_1")).otherwise(F.col("predicted_0")).alias("diagonal"))
    report = tables["report"].select(F.col("class").cast("string"), "recall", F.col("support").alias("supported"))
    met = by_class.join(matrix, "actual").join(report, F.col("class") == F.col("actual").cast("string"))
    right = F.avg((F.col("climate_related") == F.col("label")).cast("int"))
    loss = tables["loss"].withColumn("share", scored.agg(right).scalar())
    return met.select(
        "actual", (F.col("of_row") == F.col("n")).alias("row_sums"), (F.col("diagonal") == F.col("hits")).alias("diagonals"),
        (F.abs(F.col("recall") - F.col("hits") / F.col("n")) < 1e-9).alias("recalls"), (F.col("supported") == F.col("n")).alias("supports"),
    ).unionByName(loss.select(
        F.lit(None).cast(met.schema["actual"].dataType).alias("actual"),
        F.lit(True).alias("row_sums"), F.lit(True).alias("diagonals"), (F.abs(F.col("accuracy") - F.col("share")) < 1e-9).alias("recalls"),
        (F.col("logloss") > 0).alias("supports"),
    ))


def kpi_summary(spark, sf_dir):
    kpis = coverage.kpi_summary(V.articles(spark, sf_dir))
    return _text(_rounded(kpis, "share", "evolution"), "first_date", "last_date")


def selection_share(spark, sf_dir):
    share = coverage.selection_share(V.articles(spark, sf_dir), date(2024, 1, 5), date(2024, 1, 20), "media1")
    return _rounded(share, "share")


def filter_values(spark, sf_dir):
    return coverage.filter_values(V.predictions(spark, sf_dir))


def parse_mixed_dates(spark, sf_dir):
    rows = V.articles(spark, sf_dir).select("article_id", F.col("raw_date").alias("date"), "label")
    return _text(coverage.dated_articles(rows), "date")


def date_parts(spark, sf_dir):
    when = F.col("date")
    rows = coverage.with_date_parts(V.articles(spark, sf_dir))
    return rows.select(
        "article_id", "year", "month", "day",
        D.parse_date_part(F.col("raw_date")).cast("string").alias("date_part"),
        D.period_start(when, "month").cast("string").alias("month_start"),
        F.date_format(when, "MMM yyyy").alias("month_label"),
        F.date_format(when, "yyyy-MM").alias("month_key"),
        D.month_name(when).alias("month_name"),
    )


def null_text_report(spark, sf_dir):
    return coverage.null_text_count(V.rated_documents(spark, sf_dir), "quality")


def drop_empty_text(spark, sf_dir):
    return coverage.drop_empty_text(V.rated_documents(spark, sf_dir), "quality").select("doc_id", "text", "quality")


def per_date_counts(spark, sf_dir):
    daily = V.articles(spark, sf_dir).withColumn("date", F.col("date").cast("date"))
    counted = coverage.per_date_counts(daily.select("article_id", "date", "label"))
    return _text(counted, "date")


def outlet_daily_share(spark, sf_dir):
    return _text(_rounded(coverage.outlet_date_share(V.articles(spark, sf_dir)), "label", "selected"), "date")


def _rolling_share(legacy: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rolled = coverage.rolling_share(V.articles(spark, sf_dir), legacy=legacy)
        means = ("proportion", "proportion_selected")
        return _text(_rounded(rolled, *means), "date").select("media", "date", *means)

    return run


def outlet_colours(spark, sf_dir):
    return coverage.with_outlet_colour(V.articles(spark, sf_dir).select("article_id", "media"), COLOURS)


def confidence_stats(spark, sf_dir):
    return _rounded(coverage.confidence_stats(V.articles(spark, sf_dir)), "avg_confidence", "std_confidence")


def rolling_confidence(spark, sf_dir):
    rolled = coverage.rolling_confidence(V.articles(spark, sf_dir), ["date", "article_id"])
    return _rounded(rolled, "avg_proba", "std_proba").select("article_id", "avg_proba", "std_proba")


def _explorer(spark, sf_dir, **filters) -> DataFrame:
    coded = explore.coded_predictions(V.predictions(spark, sf_dir))
    return explore.explorer_rows(coded.drop("description"), **filters)


def explorer_filtered(spark, sf_dir):
    return _text(_explorer(spark, sf_dir, month="Mars", selection=SELECTION), "date")


def _pages(spark, sf_dir):
    """The explorer's page index, built once per application."""
    order, rows = ["date", "doc_id"], _explorer(spark, sf_dir)
    index = _model(
        "pages", spark, sf_dir, lambda: rows, lambda found, _, folder: explore.page_index(found, order, folder), PageIndex
    )
    return index, rows, order


def explorer_page(spark, sf_dir):
    index, rows, order = _pages(spark, sf_dir)
    return _text(explore.page_of(index, rows, 2, order), "date")


def explorer_page_sorted(spark, sf_dir):
    """The same page without an index."""
    return _text(explore.page(_explorer(spark, sf_dir), 2, ["date", "doc_id"]), "date")


def explorer_index_info(spark, sf_dir):
    return _pages(spark, sf_dir)[0].info()


def explorer_page_info(spark, sf_dir):
    return explore.page_info(_explorer(spark, sf_dir))


def _macro_rows(spark, sf_dir) -> DataFrame:
    return explore.explorer_rows(V.macro_predictions(spark, sf_dir).drop("description"), macro=True)


def macro_explorer(spark, sf_dir):
    return _text(_macro_rows(spark, sf_dir), "date")


def category_counts_macro(spark, sf_dir):
    return explore.category_counts(_macro_rows(spark, sf_dir), macro=True)


def macro_metrics(spark, sf_dir):
    lists = evaluate.label_lists(V.macro_predictions(spark, sf_dir), macro=True)
    return evaluate.multilabel_metrics(lists, MACRO_CODES).drop("unsure")


def explorer_columns(spark, sf_dir):
    """Rows without columns that must have been there."""
    return explore.drop_required(V.predictions(spark, sf_dir), "description", "label_3", "date")


def _category_counts(**options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return explore.category_counts(_explorer(spark, sf_dir), **options)

    return run


def _category_share(legacy: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return explore.category_share(explore.category_counts(_explorer(spark, sf_dir), legacy=legacy))

    return run


def category_by_month(spark, sf_dir):
    return explore.category_by_month(_explorer(spark, sf_dir))


def _themes_by_month(legacy: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _explorer(spark, sf_dir).withColumn("date", F.when(F.col("doc_id") % 19 != 0, F.col("date")))
        return explore.themes_by_month(rows, legacy=legacy)

    return run


def category_by_month_selected(spark, sf_dir):
    return explore.category_by_month(_explorer(spark, sf_dir), SELECTION)


def parse_answers(spark, sf_dir):
    block = A.marked_block(F.col("response"))
    parsed = A.parse_json(block)
    return V.responses(spark, sf_dir).select(
        "conv_id", "turn", block.alias("block"), parsed.isNotNull().alias("readable"),
        F.array_join(F.array_sort(F.map_keys(parsed)), ",").alias("keys"),
    )


def answer_classes(spark, sf_dir):
    parsed = A.parse_json(A.marked_block(F.col("response")))
    return with_classes(V.responses(spark, sf_dir), parsed, A.MISSING_KEY_MICRO, keep="complete").select(
        "conv_id", "turn", *PREDICTION_COLUMNS
    )


def api_answers(spark, sf_dir):
    rows = V.responses(spark, sf_dir).select("conv_id", "turn", A.first_block(F.col("bare")).alias("block"))
    return rows.withColumn("readable", A.parse_json(F.col("block")).isNotNull())


def repr_answers(spark, sf_dir):
    parsed = A.parse_repr(F.col("dictionary"))
    return with_classes(V.responses(spark, sf_dir), parsed, keep="parsed").select(
        "conv_id", "turn", *PREDICTION_COLUMNS
    )


def _label_lists(macro: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        kept = evaluate.evaluation_columns(V.predictions(spark, sf_dir), "doc_id")
        lists = evaluate.label_lists(kept, macro)
        return lists.select("doc_id", *[F.array_join(c, "|").alias(c) for c in ("truth", "predicted")])

    return run


def _lists(spark, sf_dir) -> DataFrame:
    return evaluate.label_lists(V.predictions(spark, sf_dir))


def label_indicator(spark, sf_dir):
    return evaluate.label_indicator(_lists(spark, sf_dir), "doc_id")


def label_counts(spark, sf_dir):
    return evaluate.label_counts(_lists(spark, sf_dir))


def multilabel_metrics(spark, sf_dir):
    return evaluate.multilabel_metrics(_lists(spark, sf_dir))


def multilabel_metrics_any_rank(spark, sf_dir):
    return evaluate.multilabel_metrics(_lists(spark, sf_dir), top=None)


def hallucinations(spark, sf_dir):
    return evaluate.hallucinations(V.predictions(spark, sf_dir))


def hallucinations_legacy(spark, sf_dir):
    return evaluate.hallucinations(V.predictions(spark, sf_dir), legacy=True)


def _run_predictions(spark, sf_dir) -> DataFrame:
    method = F.element_at(F.array(*map(F.lit, ("COT_0shots", "CARP_0shots", "COT_1shots"))), F.expr("CAST(doc_id % 3 + 1 AS INT)"))
    path = F.concat(F.lit("./runs/articles_modela_"), method, F.lit(".csv"))
    return V.predictions(spark, sf_dir).withColumn("path", path)


def metrics_by_run(spark, sf_dir):
    return evaluate.metrics_by_run(_run_predictions(spark, sf_dir))


def run_manifest(spark, sf_dir):
    return evaluate.runs(_run_predictions(spark, sf_dir))


def confusion(spark, sf_dir):
    return evaluate.confusion(V.scored_articles(spark, sf_dir))


def class_report(spark, sf_dir):
    return _rounded(evaluate.class_report(V.scored_articles(spark, sf_dir)), "precision", "recall", "f1")


def class_weights(spark, sf_dir):
    return _rounded(evaluate.class_weights(V.articles(spark, sf_dir)), "weight")


def accuracy_logloss(spark, sf_dir):
    weight = F.when(F.col("label") == 1, 2.5).otherwise(0.625)
    losses = evaluate.accuracy_logloss(V.scored_articles(spark, sf_dir), weight=weight)
    return _rounded(losses, "accuracy", "logloss")


def stratified_split(spark, sf_dir):
    texts = V.labelled_texts(spark, sf_dir).select("doc_id", "label")
    return splits.stratified_split(texts, "doc_id")


def split_sizes(spark, sf_dir):
    return splits.split_sizes(stratified_split(spark, sf_dir))


def split_total(spark, sf_dir):
    return evaluate.split_total(split_sizes(spark, sf_dir))


def head_rows(spark, sf_dir):
    return splits.head_rows(V.predictions(spark, sf_dir).select("doc_id", "media"), ["doc_id"], 400)


def head_share(spark, sf_dir):
    return splits.head_share(V.predictions(spark, sf_dir).select("doc_id", "media"), ["doc_id"])


def tail_share(spark, sf_dir):
    return splits.tail_share(V.predictions(spark, sf_dir).select("doc_id", "media"), ["doc_id"])


def clean_tokens_query(spark, sf_dir):
    rows = V.spread_documents(spark, sf_dir).select("doc_id", clean_tokens(F.col("text")).alias("words"))
    return rows.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), F.array_join("words", " ").alias("words")
    )


def chunk_text(spark, sf_dir):
    return V.documents(spark, sf_dir).select("doc_id", F.posexplode(chunks(F.col("text"))).alias("chunk_no", "chunk"))


def topic_tags(spark, sf_dir):
    return topics.topic_tags(V.spread_documents(spark, sf_dir), LEXICON, "doc_id")


# Terms of the lexicon that is drawn from the documents: frequent words of four letters or more, and word pairs.
LEXICON_WORDS, LEXICON_PAIRS, LEXICON_TOPICS = 300, 60, 24


def frequent_lexicon(spark, sf_dir) -> str:
    """A keyword file of the documents' most frequent words and word pairs, and the folder it lies in.

    Term ``n`` by count belongs to subtheme ``n`` modulo the number of topics.
    """
    spoken = written(V.spread_documents(spark, sf_dir).select(words(F.col("text")).alias("w")), "lexicon-words")  # read twice
    pairs = F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    kinds = {
        LEXICON_WORDS: spoken.select(F.explode("w").alias("term")).where(F.length("term") > 3),
        LEXICON_PAIRS: spoken.select(F.explode(pairs).alias("term")).where(F.contains("term", F.lit(" "))),
    }
    tree: dict[str, dict[str, list[str]]] = {}
    for n_terms, terms in kinds.items():
        for n, row in enumerate(terms.groupBy("term").count().orderBy(F.desc("count"), "term").limit(n_terms).collect()):
            topic = n % LEXICON_TOPICS
            tree.setdefault(THEMES[topic % len(THEMES)], {}).setdefault(f"topic_{topic}", []).append(row["term"])
    lines = []
    for theme, subs in tree.items():
        lines += [f'["{theme}"]', *[f"{sub} = {json.dumps(terms, ensure_ascii=False)}" for sub, terms in subs.items()]]
    folder = _new_folder(spark, "lexicon")
    spark.createDataFrame([("\n".join(lines),)], "value STRING").coalesce(1).write.text(folder)
    return folder


def lexicon_topics(spark, sf_dir):
    """Subthemes of every document by a whole keyword file."""
    lexicon = read_lexicon(spark, frequent_lexicon(spark, sf_dir))
    return topics.topic_tags(V.spread_documents(spark, sf_dir), lexicon, "doc_id")


def _seeded(spark, sf_dir):
    counts = guided.topic_counts(V.spread_documents(spark, sf_dir), "doc_id")
    return guided.tags_of_counts(guided.fit_counts(counts, SEED_LEXICON), counts, "doc_id")


def seeded_topics(spark, sf_dir):
    """Topics of every document, learnt from two or three seed words a topic."""
    return _seeded(spark, sf_dir)


def seeded_topic_checks(spark, sf_dir):
    """By language: whether four of five documents with a seed word, and some without any, get its topic first."""
    first = _seeded(spark, sf_dir).where("rank = 1").select("doc_id", "subtheme")
    seeds = [term for _, _, term in SEED_LEXICON]
    spoken = V.table(spark, sf_dir, "documents").where("n_chars >= 200").select(
        "doc_id", "lang", F.arrays_overlap(words(F.col("text")), F.lit(seeds)).alias("seeded")
    )
    right = F.coalesce(F.col("lang") == F.col("subtheme"), F.lit(False))
    return spoken.join(first, "doc_id", "left").groupBy("lang").agg(
        (F.avg(F.when(F.col("seeded"), right.cast("int"))) >= 0.8).alias("recognised"),
        (F.count_if(~F.col("seeded") & right) > 0).alias("beyond_seeds"),
    )


def salient_words(spark, sf_dir):
    return topics.salient_words(V.spread_documents(spark, sf_dir), "doc_id")


def _model(kind: str, spark, sf_dir, fit, save, load):
    """A model fitted and stored once per application; queries that score load it. One whose folder has gone is fitted anew."""
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key in _STORED:
        try:
            return load(spark, _STORED[key])
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    folder = _new_folder(spark, kind)
    save(fit(), spark, folder)
    _STORED[key] = folder
    return load(spark, folder)


def _parts(texts: DataFrame, label: str = "label") -> dict[str, DataFrame]:
    texts = splits.stratified_split(texts, "doc_id", label)
    return {name: texts.where(F.col("split") == name) for name in splits.SPLITS}


def _fitted(spark, sf_dir):
    parts = _parts(V.labelled_texts(spark, sf_dir))
    detector = _model(
        "detector", spark, sf_dir, lambda: detect.fit_detector(parts["train"], parts["val"]), detect.save_detector, detect.load_detector
    )
    return detector, parts["test"]


def _categories(spark, sf_dir):
    parts = _parts(V.annotated_texts(spark, sf_dir), "lang")
    model = _model(
        "categories", spark, sf_dir, lambda: categories.fit_categories(parts["train"], parts["val"]),
        categories.save_categories, categories.load_categories,
    )
    return model, parts["test"]


def category_scores(spark, sf_dir):
    """Up to three of the 25 categories for every document, from a classifier fitted on the rated ones."""
    model, _ = _categories(spark, sf_dir)
    return categories.predict_categories(model, V.spread_documents(spark, sf_dir)).select("doc_id", *PREDICTION_COLUMNS)


def category_checks(spark, sf_dir):
    """What must hold for the categories of every document."""
    first, second, third = (F.col(c) for c in PREDICTION_COLUMNS)
    names = F.array_compact(F.array(first, second, third))
    worded = V.spread_documents(spark, sf_dir).select("doc_id", (F.size(clean_tokens(F.col("text"))) > 0).alias("worded"))
    return category_scores(spark, sf_dir).join(worded, "doc_id").select(
        "doc_id",
        (first.isNotNull() == F.coalesce("worded", F.lit(False))).alias("named"),
        (F.size(F.array_distinct(names)) == F.size(names)).alias("distinct"),
        F.forall(names, lambda n: n.isin(list(METRIC_CODES))).alias("known"),
        (third.isNull() | second.isNotNull()).alias("ranked"),
    )


def category_metrics(spark, sf_dir):
    """Metrics of the classifier on texts it was not fitted on."""
    model, test = _categories(spark, sf_dir)
    return evaluate.multilabel_metrics(evaluate.label_lists(categories.predict_categories(model, test)))


def detector_reasons(spark, sf_dir):
    """For every document whether the words' shares add up to the margin that decides it, and to which side."""
    detector, _ = _fitted(spark, sf_dir)
    # summed before the join, so that no word is moved
    total = F.aggregate("contributions", F.col("intercept"), lambda a, c: a + c["share"])
    found = detect.reasons(detector, V.spread_documents(spark, sf_dir), "doc_id").select(
        "doc_id", total.alias("total"), F.size("top_words").alias("n_top")
    )
    scored = detect.predict(detector, V.spread_documents(spark, sf_dir)).select(
        "doc_id", F.col("climate_related").alias("decision"), F.col("confidence").alias("sure")
    )
    total = F.col("total")
    likely = 1 / (1 + F.exp(-F.abs(total)))
    return found.join(scored, "doc_id").select(
        "doc_id", (F.abs(likely - F.col("sure")) < 1e-6).alias("adds_up"),
        ((total > 0).cast("int") == F.col("decision")).alias("decides"),
        (F.col("n_top") <= 3).alias("short"),
    )


def detector_scores(spark, sf_dir):
    detector, _ = _fitted(spark, sf_dir)
    scored = detect.predict(detector, V.spread_documents(spark, sf_dir), row_id="doc_id")
    return scored.select("doc_id", "climate_related", "confidence", F.array_join("top_words", " ").alias("top_words"))


def detector_checks(spark, sf_dir):
    """What must hold for every score, with the salient words it comes with."""
    confidence = F.col("confidence")
    return detector_scores(spark, sf_dir).select(
        "doc_id", F.col("climate_related").isin(0, 1).alias("decided"), confidence.between(0.5, 1.0).alias("bounded"), "top_words"
    )


def _detector_table(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        detector, test = _fitted(spark, sf_dir)
        return detect.evaluate(detect.predict(detector, test), weights=detector.weights)[name]

    return run


def prompt_table(spark, sf_dir):
    return prompts.prompt_table(V.documents(spark, sf_dir), "doc_id", examples=EXAMPLES)


def task_prompts(spark, sf_dir):
    text = F.col("text")
    return V.documents(spark, sf_dir).select(
        "doc_id",
        prompts.micro_prompt(text).alias("micro"),
        prompts.macro_prompt(text).alias("macro"),
        prompts.single_label_prompt(text).alias("single"),
    )


def training_table(spark, sf_dir):
    return prompts.training_table(V.predictions(spark, sf_dir), "doc_id")


def name_by_length(texts: list[str]) -> list[str]:
    """A stand-in classifier: the text's length picks the class."""
    names = [DISPLAY_NAMES[len(text) % len(DISPLAY_NAMES)] for text in texts]
    return [json.dumps({"Classe_1": name}, ensure_ascii=False) for name in names]


def batch_scores(spark, sf_dir):
    scored = batches.score_batches(V.documents(spark, sf_dir), name_by_length, F.col("text"))
    classes = with_classes(scored, A.parse_json(A.first_block(F.col("answer"))))
    return classes.select("doc_id", "prediction_label_1")


def refined_scores(spark, sf_dir):
    rows = V.documents(spark, sf_dir)
    refined = batches.refined_scores(rows, name_by_length, F.lit(REFINE_MESSAGE), F.col("text"), passes=1)
    return with_classes(refined, F.col("prediction_label")).select("doc_id", "prediction_label_1")


def metric_comparison(spark, sf_dir):
    """Metrics per outlet with all three predictions next to those with the first alone."""
    lists = _lists(spark, sf_dir)

    def table(predicted: Column) -> DataFrame:
        metrics = evaluate.multilabel_metrics(lists.withColumn("predicted", predicted), by=["media"])
        return with_position(metrics.withColumnRenamed("media", "source"), "source", name="row_no")

    tables = {"three": table(F.col("predicted")), "first": table(F.slice("predicted", 1, 1))}
    return compare.metric_comparison(tables)


def size_energy(spark, sf_dir):
    """Energy each model would need for the on-topic articles of each outlet and month."""
    models = compare.size_energy(compare.model_energy(spark))
    return _rounded(compare.energy_by_outlet(V.articles(spark, sf_dir), models), "log_size", "log_energy", "corpus_wh")


def dedupe_columns(spark, sf_dir):
    rows = V.articles(spark, sf_dir).select("article_id", "media", "label", "raw_date")
    doubled = rows.withColumns({"media_copy": F.col("media"), "label_copy": F.col("label")})
    return compare.drop_duplicate_columns(doubled)


QUERIES = {
    "coverage_by_day": _coverage("day"),
    "coverage_by_week": _coverage("week"),
    "coverage_by_month": _coverage("month"),
    "coverage_incremental": coverage_incremental,
    "stored_texts": stored_texts,
    "stored_articles": stored_articles,
    "stored_splits": stored_splits,
    "stored_metrics": stored_metrics,
    "kpi_summary": kpi_summary,
    "selection_share": selection_share,
    "filter_values": filter_values,
    "parse_mixed_dates": parse_mixed_dates,
    "date_parts": date_parts,
    "null_text_report": null_text_report,
    "drop_empty_text": drop_empty_text,
    "per_date_counts": per_date_counts,
    "outlet_daily_share": outlet_daily_share,
    "rolling_share": _rolling_share(legacy=False),
    "rolling_share_legacy": _rolling_share(legacy=True),
    "outlet_colours": outlet_colours,
    "confidence_stats": confidence_stats,
    "rolling_confidence": rolling_confidence,
    "explorer_filtered": explorer_filtered,
    "explorer_page": explorer_page,
    "explorer_page_sorted": explorer_page_sorted,
    "explorer_index_info": explorer_index_info,
    "explorer_page_info": explorer_page_info,
    "category_counts": _category_counts(),
    "category_counts_legacy": _category_counts(legacy=True),
    "category_counts_macro": category_counts_macro,
    "macro_explorer": macro_explorer,
    "macro_metrics": macro_metrics,
    "explorer_columns": explorer_columns,
    "category_share": _category_share(legacy=False),
    "category_share_legacy": _category_share(legacy=True),
    "category_by_month": category_by_month,
    "category_by_month_selected": category_by_month_selected,
    "themes_by_month": _themes_by_month(legacy=False),
    "themes_by_month_legacy": _themes_by_month(legacy=True),
    "parse_answers": parse_answers,
    "answer_classes": answer_classes,
    "api_answers": api_answers,
    "repr_answers": repr_answers,
    "normalised_labels": _label_lists(macro=False),
    "compacted_labels": _label_lists(macro=True),
    "label_indicator": label_indicator,
    "label_counts": label_counts,
    "multilabel_metrics": multilabel_metrics,
    "multilabel_metrics_any_rank": multilabel_metrics_any_rank,
    "hallucinations": hallucinations,
    "hallucinations_legacy": hallucinations_legacy,
    "metrics_by_run": metrics_by_run,
    "run_manifest": run_manifest,
    "confusion": confusion,
    "class_report": class_report,
    "class_weights": class_weights,
    "accuracy_logloss": accuracy_logloss,
    "stratified_split": stratified_split,
    "split_sizes": split_sizes,
    "split_total": split_total,
    "head_rows": head_rows,
    "head_share": head_share,
    "tail_share": tail_share,
    "clean_tokens": clean_tokens_query,
    "chunk_text": chunk_text,
    "topic_tags": topic_tags,
    "lexicon_topics": lexicon_topics,
    "seeded_topics": seeded_topics,
    "seeded_topic_checks": seeded_topic_checks,
    "salient_words": salient_words,
    "detector_scores": detector_scores,
    "detector_checks": detector_checks,
    "detector_report": _detector_table("report"),
    "detector_confusion": _detector_table("confusion"),
    "detector_loss": _detector_table("loss"),
    "detector_invariants": detector_invariants,
    "detector_reasons": detector_reasons,
    "category_scores": category_scores,
    "category_checks": category_checks,
    "category_metrics": category_metrics,
    "prompt_table": prompt_table,
    "task_prompts": task_prompts,
    "training_table": training_table,
    "batch_scores": batch_scores,
    "refined_scores": refined_scores,
    "metric_comparison": metric_comparison,
    "size_energy": size_energy,
    "dedupe_columns": dedupe_columns,
}
