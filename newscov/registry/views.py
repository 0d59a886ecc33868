"""Article, prediction, answer and text views over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.functions.answers import ANSWER_MARKER, MISSING_KEY_MICRO
from newscov.scale import spread_scan
from newscov.taxonomy import CATEGORIES, DISPLAY_NAMES, MACRO_CODES

CODES = tuple(code for _, code, _ in CATEGORIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index: str) -> Column:
    """Element ``index`` modulo the number of values, of a fixed list."""
    return F.element_at(F.array(*map(F.lit, values)), F.expr(f"CAST(({index}) % {len(values)} + 1 AS INT)"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS article_id",
        "ts AS date",
        """CASE event_id % 8
             WHEN 0 THEN substr(CAST(ts AS STRING), 1, 10)
             WHEN 1 THEN substr(CAST(ts AS STRING), 1, 19)
             WHEN 2 THEN concat(substr(CAST(ts AS STRING), 6, 2), '/', substr(CAST(ts AS STRING), 9, 2), '/',
                                substr(CAST(ts AS STRING), 1, 4))
             WHEN 3 THEN 'juil-24'
             WHEN 4 THEN date_format(ts, 'MM-dd-yyyy')
             WHEN 5 THEN date_format(ts, 'd MMM yyyy')
             WHEN 6 THEN date_format(ts, 'yyyyMMdd')
             ELSE date_format(ts, 'MMMM d, yyyy') END AS raw_date""",
        "concat('media', CAST(user_id % 6 AS STRING)) AS media",
        "CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS label",
        "0.5D + value / 1000D AS confidence",
    )


def scored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).withColumn("predicted", (F.col("confidence") > 0.55).cast("int"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")

    def unless(condition: Column, value: Column) -> Column:
        return F.when(~condition, value)

    first = F.when(doc % 5 < 3, _pick(DISPLAY_NAMES, "doc_id")).otherwise(_pick(DISPLAY_NAMES, "doc_id * 13 + 1"))
    second = F.when(doc % 4 < 2, _pick(DISPLAY_NAMES, "doc_id * 7 + 5")).otherwise(
        _pick(DISPLAY_NAMES, "doc_id * 3 + 9")
    )
    third = unless(doc % 11 == 0, _pick(DISPLAY_NAMES, "doc_id * 17 + 4"))
    no_key = F.lit(MISSING_KEY_MICRO)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr("DATE'2024-01-01' + CAST(doc_id % 366 AS INT)").alias("date"),
        F.col("source").alias("media"),
        F.col("text").alias("description"),
        F.when(doc % 2 == 0, _pick(CODES, "doc_id")).otherwise(_pick(DISPLAY_NAMES, "doc_id")).alias("label_1"),
        unless(doc % 3 == 0, _pick(CODES, "doc_id * 7 + 5")).alias("label_2"),
        unless(doc % 2 == 0, _pick(DISPLAY_NAMES, "doc_id * 11 + 2")).alias("label_3"),
        F.when(doc % 13 == 0, "Catégorie inventée").otherwise(first).alias("prediction_label_1"),
        F.when(doc % 7 == 0, no_key).otherwise(second).alias("prediction_label_2"),
        F.when(doc % 7 == 0, no_key).otherwise(third).alias("prediction_label_3"),
    )


def macro_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    none = F.lit(None).cast("string")
    guess = F.when(doc % 3 == 0, _pick(MACRO_CODES, "doc_id * 3")).otherwise(_pick(MACRO_CODES, "doc_id * 7 + 1"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr("DATE'2024-01-01' + CAST(doc_id % 366 AS INT)").alias("date"),
        F.col("source").alias("media"),
        F.col("text").alias("description"),
        _pick(MACRO_CODES, "doc_id * 3").alias("label_1"), none.alias("label_2"), none.alias("label_3"),
        F.when(doc % 17 == 0, none).when(doc % 13 == 0, "hors sujet").otherwise(guess).alias("prediction_label_1"),
        none.alias("prediction_label_2"), none.alias("prediction_label_3"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = _pick(DISPLAY_NAMES, "conv_id * 3 + turn"), _pick(DISPLAY_NAMES, "conv_id * 5 + turn * 2")
    kind = (F.col("conv_id") + F.col("turn")) % 5
    body = (
        F.when(kind == 0, F.format_string('{"Classe_1": "%s", "Classe_2": "%s", "Classe_3": "Pollution"}', one, two))
        .when(kind == 1, F.format_string('{"Classe_1": "%s"} {"Classe_1": "Pollution"}', one))
        .when(kind == 2, F.format_string('{"Classe_1": %s}', one))
        .when(kind == 3, F.lit("sans accolades"))
        .otherwise(F.format_string('{"Classe_1": "%s", "Classe_2": null}', one))
    )
    lead = F.translate("text", "{}", "()")
    bare = F.concat(lead, F.lit(" "), body)
    response = F.concat(F.lit("{x} " + ANSWER_MARKER), bare)

    def printed(name: Column) -> Column:
        return F.when(name.contains("'"), F.concat(F.lit('"'), name, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), name, F.lit("'"))
        )

    third = F.when(kind == 4, F.lit("None")).when(kind == 1, F.lit("'[None, None]'")).when(kind == 2, F.lit("True"))
    third = third.otherwise(F.lit("'Pollution'"))
    dictionary = F.concat(
        F.lit("{'Classe_1': "), printed(one), F.lit(", 'Classe_2': "), printed(two),
        F.lit(", 'Classe_3': "), third, F.lit("}"),
    )
    dictionary = F.when(kind == 3, "sans accolades").otherwise(dictionary)
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", response.alias("response"), bare.alias("bare"), dictionary.alias("dictionary")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("media"))


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_scan(documents(spark, sf_dir), "doc_id")


def rated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality, which is missing for those nobody rated."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id", "left")


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return spread_documents(spark, sf_dir).join(labels, "doc_id")


# Stand-ins for annotations: categories by what the texts really differ in, language and rated quality.
LANGUAGE_CODES = {
    "fr": "rechauffement_climatique_canicule",
    "en": "energies_renouvelables_et_nucleaires",
    "de": "transport_decarbone",
    "es": "secheresse",
}
POOR_CODE, TOXIC_CODE = "pollution", "feu_foret"


def annotated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated documents with up to three categories each."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    language = F.element_at(F.create_map(*[F.lit(x) for pair in LANGUAGE_CODES.items() for x in pair]), F.col("lang"))
    rated = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id").join(labels, "doc_id")
    return rated.select(
        "doc_id", "lang", "text", language.alias("label_1"),
        F.when(F.col("quality") == 0, POOR_CODE).alias("label_2"), F.when(F.col("toxic") == 1, TOXIC_CODE).alias("label_3"),
    )
