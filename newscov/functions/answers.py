"""Reading class names out of free-text model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: answer formats ---------------------------------------------
ANSWER_MARKER = "Réponse :\n"
CLASS_KEYS = ("Classe_1", "Classe_2", "Classe_3")
MISSING_KEY_MICRO = "[None, None]"
MISSING_KEY_MACRO = "[None]"
# --- end of fixed values --------------------------------------------------------

_MAP = "map<string,string>"
_QUOTED_OR_NOT = r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|[^'"]++|['"]"""


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def marked_block(answer: Column) -> Column:
    """First ``{…}`` without inner braces after the last answer marker; null if there is none."""
    tail = F.substring_index(answer, ANSWER_MARKER, -1)
    return _or_null(F.regexp_extract(tail, r"(\{[^{}]*\})", 1))


def first_block(answer: Column) -> Column:
    """From the first ``{`` to the next ``}``; a missing brace gives what is there, ``{}`` at least."""
    inner = F.regexp_extract(answer, r"\{([^}]*)", 1)
    return F.when(answer.isNotNull(), F.concat(F.lit("{"), inner, F.lit("}")))


def parse_json(block: Column) -> Column:
    """JSON object as a map of strings; null when it is not valid JSON."""
    return F.from_json(block, _MAP, {"allowSingleQuotes": "false"})


def parse_repr(text: Column) -> Column:
    """Printed Python dictionary as a map of strings; its constants are read outside quotes only."""
    parts = F.regexp_extract_all(text, F.lit(_QUOTED_OR_NOT), F.lit(0))

    def json(part: Column) -> Column:
        for python, plain in (("None", "null"), ("True", "true"), ("False", "false")):
            part = F.regexp_replace(part, rf"\b{python}\b", plain)
        return part

    read = F.transform(parts, lambda part: F.when(part.rlike("^['\"]"), part).otherwise(json(part)))
    return F.from_json(F.array_join(read, ""), _MAP, {"allowSingleQuotes": "true"})


def class_names(answer: Column, placeholder: str | None = None) -> list[Column]:
    """The three class names of a parsed answer.

    Null for an unreadable answer or a null value. A missing key gives null, or
    ``placeholder`` where the caller wants such answers kept. Of a repeated key the
    last value counts; a plain map lookup would take the first.
    """
    out = []
    for key in CLASS_KEYS:
        entries = F.filter(F.map_entries(answer), lambda entry: entry["key"] == key)
        value = F.try_element_at(entries, F.lit(-1))["value"]
        if placeholder is not None:
            value = F.when(F.size(entries) == 0, F.lit(placeholder)).otherwise(value)
        out.append(value)
    return out


def run_name(path: Column, parts: int = 1) -> Column:
    """Last ``parts`` underscore-separated pieces of a file name, without the suffix."""
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"\.csv$", "")
    return F.substring_index(name, "_", -parts)
