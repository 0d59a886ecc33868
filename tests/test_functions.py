from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newscov import taxonomy
from newscov.functions import answers as A
from newscov.functions import dates as D
from newscov.functions import labels as L
from newscov.functions import text as T
from newscov.operators.parse import KEEP, with_classes


def values(spark, expression, rows, kind="STRING"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i INT, x {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_mixed_dates(spark):
    raw = ["2024-01-02", "2024-01-02 20:00:00", "03/04/2024", "13/04/2024", "03/04/2024 08:30:00", "juil-24", None, ""]
    assert values(spark, D.parse_mixed, raw) == [
        datetime(2024, 1, 2), datetime(2024, 1, 2, 20), datetime(2024, 3, 4), datetime(2024, 4, 13),
        datetime(2024, 3, 4, 8, 30), None, None, None,
    ]


def test_more_date_formats(spark):
    raw = ["2024/05/06 07:00", "2024-05-06T07:00:00.5", "06.05.2024", "x"]
    assert values(spark, lambda x: D.parse_mixed(x, ("dd.MM.yyyy",)), raw) == [
        datetime(2024, 5, 6, 7), datetime(2024, 5, 6, 7, 0, 0, 500000), datetime(2024, 5, 6), None,
    ]


def test_date_part(spark):
    raw = ["2024-05-06 10:00:00", "2024-05-06", "juil-24", None]
    assert values(spark, D.parse_date_part, raw) == [date(2024, 5, 6), date(2024, 5, 6), None, None]


def test_week_starts_on_monday(spark):
    raw = [datetime(2024, 1, 7, 23), datetime(2024, 1, 8)]
    got = values(spark, lambda x: D.period_start(x, "week"), raw, "TIMESTAMP_NTZ")
    assert got == [date(2024, 1, 1), date(2024, 1, 8)]


def test_unknown_period():
    with pytest.raises(ValueError):
        D.period_start(F.lit(None), "year")


def test_month_names(spark):
    assert values(spark, D.month_name, [date(2024, 2, 1), date(2024, 8, 31), None], "DATE") == ["Février", "Août", None]
    assert D.month_number("Décembre") == 12


def test_normalise(spark):
    raw = ["Été À L'ŒUVRE", "école", "straße", None]
    assert values(spark, T.normalise, raw) == ["ete a l'oeuvre", "ecole", "strasse", None]
    assert [T.normalise_word(r) for r in raw[:3]] == ["ete a l'oeuvre", "ecole", "strasse"]


def test_tokens_and_words(spark):
    assert values(spark, T.tokens, ["L'eau, CO2 et 3 îles!", "", None]) == [["l'eau", "co2", "et", "3", "iles"], [], None]
    assert values(spark, T.words, ["CO2 et 3 îles"]) == [["co2", "et", "3", "iles"]]


def test_mixed_tokens_go_as_a_whole(spark):
    assert values(spark, T.clean_tokens, ["Le CO2 de l'usine: gaz_rare et chaleur"]) == [["chaleur"]]


@pytest.mark.parametrize(
    "text, day",
    [
        ("5 Jan 2024", "2024-01-05"), ("January 5, 2024", "2024-01-05"), ("Sept. 7 2023", "2023-09-07"), ("05-01-2024", "2024-05-01"),
        ("25-01-2024", "2024-01-25"), ("20240105", "2024-01-05"), ("03/04/24", "2024-03-04"), ("13/04/99", "1999-04-13"),
        ("5 janvier 2024", None), ("99999999", None), ("5 J 2024", None), ("Jan 2024", None), ("31 Feb 2024", None),
    ],
)
def test_dates_by_name_dash_and_short_year(spark, text, day):
    (got,) = values(spark, D.parse_mixed, [text])
    assert (got and str(got.date())) == day


def test_repr_with_quoted_constants(spark):
    raw = ["{'Classe_1': '[None, None]', 'Classe_2': True, 'Classe_3': None}", '{"a": "it\'s None", \'b\': False}', "{'a': 'x\\'None'}"]
    got = values(spark, A.parse_repr, raw)
    assert got[0] == {"Classe_1": "[None, None]", "Classe_2": "true", "Classe_3": None}
    assert got[1] == {"a": "it's None", "b": "false"}
    assert got[2] == {"a": "x'None"}


def test_scripts_are_spelled_in_latin_letters(spark):
    texts = ["Климат меняется, объект ещё ждёт щуку", "Η Αθήνα και ο ψυχρός χειμώνας, Θεσσαλονίκη", "Łódź, Děčín, Şırnak, Iași", "気候 変動"]
    plain = ["klimat meniaetsia, obekt eshchio zhdiot shchuku", "e athena kai o psukhros kheimonas, thessalonike", "lodz, decin, sirnak, iasi", "気候 変動"]
    assert values(spark, T.normalise, texts) == plain
    words = [w for text in texts for w in text.replace(",", "").split()]
    assert [T.normalise_word(w) for w in words] == [w for text in plain for w in text.replace(",", "").split()]
    assert values(spark, T.clean_tokens, texts[:1]) == [["klimat", "meniaetsia", "obekt", "eshchio", "zhdiot", "shchuku"]]


def test_contractions_are_parted_and_elisions_are_not(spark):
    texts = ["I don't think they’re late; it's raining", "l'eau qu'il boit aujourd'hui", "he'd've we'll rock'n'roll cats' 'quoted'"]
    assert values(spark, T.tokens, texts) == [
        ["i", "do", "n't", "think", "they", "’re", "late", "it", "'s", "raining"],
        ["l'eau", "qu'il", "boit", "aujourd'hui"],
        ["he", "'d've", "we", "'ll", "rock'n'roll", "cats'", "'quoted'"],
    ]
    english = values(spark, lambda x: T.clean_tokens(x, "english"), texts[:1])
    assert english == [["think", "late", "raining"]]


def test_clean_tokens(spark):
    assert values(spark, T.clean_tokens, ["Comme le climat change APRÈS la pluie"]) == [["climat", "change", "pluie"]]
    english = values(spark, lambda x: T.clean_tokens(x, "english"), ["Never the weather of television"])
    assert english == [["weather"]]


def test_other_language(spark):
    with pytest.raises(ValueError):
        T.stop_words("german")


def test_letters_only(spark):
    got = values(spark, T.letters_only, [["eau", "l'eau", "co2", "été"]], "ARRAY<STRING>")
    assert got == [["eau", "été"]]


@pytest.mark.parametrize("size", [4, 4999])
def test_chunks(spark, size):
    def expected(text):
        n = len(text) // size + 1 if len(text) >= size else 1
        return [text[i * size : (i + 1) * size] for i in range(n)]

    texts = ["", "abc", "abcd", "ab\ncdefg", "é😀" * size, "x" * (3 * size), "y" * (size - 1), "a😀b" * 20_000]
    assert values(spark, lambda x: T.chunks(x, size), texts) == [expected(t) for t in texts]


def test_code_of(spark):
    raw = ["Couche d'ozone", "couche_ozone", "Pollution plastique", "Pollution", "N/A", "[None, None]", None]
    assert values(spark, L.code_of, raw) == ["couche_ozone", "couche_ozone", "pollution", "pollution", None, None, None]
    # a code without a display name stays unknown, as in the metrics it is only reachable as written
    assert values(spark, L.code_of, [taxonomy.CODE_WITHOUT_NAME[0]]) == [None]


def test_explorer_spellings(spark):
    assert values(spark, L.explorer_code_of, ["couches_ozone", "Sécheresse"]) == ["couche_ozone", "secheresse"]


def test_label_lists(spark):
    df = spark.createDataFrame([("Pollution", "pollution", None), ("x", None, "Biodiversité")], "a STRING, b STRING, c STRING")
    row = df.select(L.coded_labels("a", "b", "c").alias("coded"), L.present_labels("a", "b", "c").alias("raw")).collect()
    assert [r["coded"] for r in row] == [["pollution", "pollution"], ["perte_biodiversite"]]
    assert [r["raw"] for r in row] == [["Pollution", "pollution"], ["x", "Biodiversité"]]


def test_themes(spark):
    df = spark.createDataFrame([("secheresse", "pollution", "deforestation"), ("x", None, "x")], "a STRING, b STRING, c STRING")
    assert [r[0] for r in df.select(L.themes("a", "b", "c")).collect()] == [["cause", "conséquence"], []]


def test_filters_on_any_and_all(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "c", "b"), (3, None, None), (4, "z", "a")], "i INT, x STRING, y STRING"
    )
    assert [r.i for r in df.where(L.any_in(["x", "y"], ["a"])).collect()] == [1, 4]
    assert [r.i for r in df.where(L.all_in(["x", "y"], ["a", "b", "c"])).collect()] == [1, 2, 3]


def test_taxonomy_sizes():
    assert len(taxonomy.CATEGORIES) == 25
    assert len(taxonomy.REACHABLE_CODES) == 24
    assert {t: len(c) for t, c in taxonomy.THEME_CODES.items()} == {"cause": 6, "conséquence": 12, "solution": 7}
    assert len(taxonomy.explorer_codes(legacy=True)) == 25


def test_marked_block(spark):
    raw = [
        '{x} Réponse :\n mot {"Classe_1": "Pollution"} {"Classe_1": "b"}',
        "Réponse :\n{a} Réponse :\n{\n b}",
        "Réponse :\n{ {inner} }",
        "Réponse :\nrien",
        None,
    ]
    assert values(spark, A.marked_block, raw) == ['{"Classe_1": "Pollution"}', "{\n b}", "{inner}", None, None]


def test_first_block(spark):
    raw = ['ok {"a": 1} {"b": 2}', "{open", "none", "a { b { c } d }", None]
    assert values(spark, A.first_block, raw) == ['{"a": 1}', "{open}", "{}", "{ b { c }", None]


def test_parse_json(spark):
    raw = ['{"Classe_1": "a", "Classe_2": null}', "{'Classe_1': 'a'}", "{Classe_1: a}", "{}", '{"Classe_1": ["a", "b"]}', None]
    assert values(spark, A.parse_json, raw) == [
        {"Classe_1": "a", "Classe_2": None}, None, None, {}, {"Classe_1": '["a","b"]'}, None,
    ]


def test_parse_repr(spark):
    raw = ["{'Classe_1': \"Couche d'ozone\", 'Classe_2': None}"]
    assert values(spark, A.parse_repr, raw) == [{"Classe_1": "Couche d'ozone", "Classe_2": None}]


def test_class_names_keep_placeholder(spark, plan):
    df = spark.createDataFrame([("{\"Classe_1\": \"a\"}",), ('{"Classe_1": "a", "Classe_2": null, "Classe_3": "c"}',), ("{bad}",)], "x STRING")
    tables = {k: with_classes(df, A.parse_json(F.col("x")), A.MISSING_KEY_MICRO, k).drop("x") for k in KEEP}
    rows = {k: [tuple(r) for r in table.collect()] for k, table in tables.items()}
    assert rows["all"] == [("a", "[None, None]", "[None, None]"), ("a", None, "c"), (None, None, None)]
    assert rows["parsed"] == rows["all"][:2]
    assert rows["complete"] == rows["all"][:1]
    assert tables["all"].columns == ["prediction_label_1", "prediction_label_2", "prediction_label_3"]
    assert plan(tables["complete"]).count("from_json(") == 1


def test_last_of_a_repeated_key_counts(spark):
    df = spark.createDataFrame([('{"Classe_1": "a", "Classe_2": "b", "Classe_2": "c"}',)], "x STRING")
    row = with_classes(df, A.parse_json(F.col("x"))).first()
    assert tuple(row)[1:] == ("a", "c", None)


def test_run_name(spark):
    raw = ["a/b/predictions_2024_Model-8B.csv", "x.csv"]
    assert values(spark, A.run_name, raw) == ["Model-8B", "x"]
    assert values(spark, lambda x: A.run_name(x, 3), ["p/predictions_modela_COT_1shots.csv", "a_b.csv"]) == [
        "modela_COT_1shots", "a_b",
    ]
