"""Prompt and fine-tuning texts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscov.schemas import ANNOTATION_COLUMNS, require_columns
from newscov.taxonomy import DISPLAY_NAMES, MACRO_CODES

# --- fixed values: wording of the prompts ------------------------------------------
# {categories}, {k} and {output_format} are filled in before a job starts, {text} per row.
MICRO_PROMPT = """\
Donne au maximum les {k} classes, parmi {categories}, qui correspondent le mieux au texte donné, de la plus probable à la moins probable.

## Règles :
- Les catégories doivent être dans {categories}.
- Les classes sont ordonnées de la plus probable à la moins probable.
- Réponds uniquement avec un JSON strict du format suivant : {output_format}


Texte : "{text}"

Réponse :
"""

MACRO_PROMPT = """\
Donne la classe, parmi {categories}, qui correspond le mieux au texte donné,


## Règles :
- La catégories doivent être dans {categories}.
- Réponds uniquement avec un JSON strict du format suivant : {output_format}


Texte : "{text}"

Réponse :
"""

SINGLE_LABEL_PROMPT = """\
Donne uniquement la classe, parmi {categories}, qui correspond le mieux au texte donné
## Règles :
Ne répondre qu'avec un seul terme dans {categories} .
## Exemple :
Texte : "Les océans absorbent trop de CO₂, ce qui perturbe la vie marine."
Réponse : {"category": "Acidification des océans"}
"""

TRAINING_PROMPT = """\
Donne seulement les 3 classes, parmi {categories}, qui correspondent le mieux au texte donné, de la plus probable à la moins probable.

## Règles :
- Les catégories doivent être dans {categories}.
- Les classes sont ordonnées de la plus probable à la moins probable.
- Réponds uniquement avec un JSON strict du format suivant : {output_format}


Texte : "{text}"

Réponse :
"""

METHOD_PROMPTS = {
    "raw": """\
Donne les classes, parmi {categories}, qui correspondent le mieux au texte donné.
## Règles:
Pour chacune des {k} prédictions, ne répondre qu'avec un seul terme dans {categories}
Réponds pour les classes strictement avec un dictionnaire du format JSON suivant: {output_format} où les valeurs sont des listes de catégories.
Les classes sont ordonnées de la plus probable à la moins probable.
""",
    "COT": """\
Donne les {k} classes, parmi {categories}, qui correspondent le mieux au texte donné, de la plus probable à la moins probable. Avant cela explique ton raisonnement.
## Règles:
Fais un Raisonnement déduire le processus de RAISONNEMENT diagnostique à partir des prémisses (c'est-à-dire les indices, l'entrée) qui soutiennent la détermination des classes du texte (limiter le nombre de mots à 130).
Pour chacune des {k} prédictions, ne répondre qu'avec un seul terme dans {categories}.
Réponds pour les classes strictement avec un dictionnaire du format JSON suivant: {output_format} où les valeurs sont des listes de catégories.
Les classes sont ordonnées de la plus probable à la moins probable.
""",
    "CARP": """\
Donne les {k} classes, parmi {categories}, qui correspondent le mieux au texte donné, de la plus probable à la moins probable. Avant cela explique ton raisonnement.
## Règles:
Commence par Indices une liste d'INDICES pris dans le texte fourni (c'est-à-dire de mots-clés, de phrases, d'informations contextuelles, de relations sémantiques, de sens sémantique, de tonalités, de références) qui soutiennent la détermination des classes.
Puis fais un Raisonnement déduire le processus de RAISONNEMENT diagnostique à partir des prémisses (c'est-à-dire les indices, l'entrée) qui soutiennent la détermination des classes du texte (limiter le nombre de mots à 130).
Pour chacune des {k} prédictions, ne répondre qu'avec un seul terme dans {categories}.
Réponds pour les classes strictement avec un dictionnaire du format JSON suivant: {output_format} où les valeurs sont des listes de catégories.
Les classes sont ordonnées de la plus probable à la moins probable.
""",
}

USER_PROMPT = "Voici le texte à classifier:\n{text}"
# --- end of fixed values --------------------------------------------------------------

METHODS = tuple(METHOD_PROMPTS)


def output_format(k: int = 3, legacy: bool = False) -> str:
    """Answer format for ``k`` classes as JSON.

    ``legacy`` prints a Python dictionary whose values keep their unfilled number.
    """
    if legacy:
        return str({f"Classe_{i}": "categorie_{i}" for i in range(1, k + 1)})
    return json.dumps({f"Classe_{i}": f"categorie_{i}" for i in range(1, k + 1)})


def fill(template: str, categories, k: int = 3, answer: str | None = None) -> str:
    """A template with everything but the text filled in."""
    filled = template.replace("{categories}", str(list(categories))).replace("{k}", str(k))
    return filled.replace("{output_format}", answer or output_format(k))


def around_text(template: str, text: Column) -> Column:
    """A filled template with the row's text in its place."""
    before, _, after = template.partition("{text}")
    return F.concat(F.lit(before), text, F.lit(after))


def _spaced(k: int) -> str:
    return "{ " + output_format(k)[1:-1] + " }"


def micro_prompt(text: Column, categories=DISPLAY_NAMES, k: int = 3) -> Column:
    """Prompt asking for up to ``k`` ranked classes."""
    return around_text(fill(MICRO_PROMPT, categories, k, _spaced(k)), text)


def macro_prompt(text: Column, categories=MACRO_CODES) -> Column:
    """Prompt asking for one class."""
    return around_text(fill(MACRO_PROMPT, categories, answer='{ "Classe_1": "categorie"}'), text)


def single_label_prompt(text: Column, categories=DISPLAY_NAMES) -> Column:
    """Prompt asking for exactly one class, with a worked example."""
    return F.concat(F.lit(fill(SINGLE_LABEL_PROMPT, categories) + "\n"), around_text(USER_PROMPT, text))


def method_message(
    method: str, n_shots: int = 0, examples: dict[str, list[str]] | None = None, categories=DISPLAY_NAMES, k: int = 3,
    legacy: bool = False,
) -> str:
    """Instructions of a prompt method followed by its first ``n_shots`` examples."""
    if method not in METHOD_PROMPTS:
        raise ValueError(f"unknown prompt method: {method}; choose one of {METHODS}")
    shots = (examples or {}).get(method, [])[:n_shots]
    return fill(METHOD_PROMPTS[method], categories, k, output_format(k, legacy)) + "\n".join(shots)


def prompt_table(
    texts: DataFrame,
    *keep: str,
    text: str = "text",
    models=("model",),
    methods=METHODS,
    shots=(0, 1),
    examples: dict[str, list[str]] | None = None,
    categories=DISPLAY_NAMES,
    k: int = 3,
) -> DataFrame:
    """One prompt per text and run, a run being model x method x number of examples.

    The run grid is a literal inside the row, so building prompts moves no data.
    """
    grid = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(method).alias("prompt_method"),
                F.lit(n).alias("n_shots"),
                F.lit(method_message(method, n, examples, categories, k)).alias("system_message"),
            )
            for model in models
            for method in methods
            for n in shots
        ]
    )
    user = around_text(USER_PROMPT, F.col(text)).alias("user_message")
    return texts.select(*keep, user, F.inline(grid))


def with_previous_answer(message: Column, previous: Column) -> Column:
    """A message followed by the last answer, for a refining pass."""
    return F.concat_ws("\n", message, previous)


def training_text(
    text: Column, labels=ANNOTATION_COLUMNS, categories=DISPLAY_NAMES, missing: str = "None"
) -> Column:
    """Prompt and annotated answer as one training text."""
    one, two, three = (F.coalesce(F.col(label), F.lit(missing)) for label in labels)
    answer = F.concat(
        F.lit('{"Classe_1": "'), one, F.lit('",\n"Classe_2": "'), two, F.lit('",\n"Classe_3": "'), three, F.lit('"}\n')
    )
    return F.concat(around_text(fill(TRAINING_PROMPT, categories, answer=_spaced(3)), text), answer)


def training_table(annotations: DataFrame, *keep: str, text: str = "description", categories=DISPLAY_NAMES) -> DataFrame:
    """Fine-tuning texts of annotated articles."""
    require_columns(annotations, text, *ANNOTATION_COLUMNS)
    return annotations.select(*keep, training_text(F.col(text), categories=categories).alias("training_text"))
