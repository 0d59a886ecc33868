"""Category names, codes, themes and other fixed lookup values."""

from __future__ import annotations

# --- fixed values: display name, code, theme of the micro categories ---------
CATEGORIES = (
    ("Gaz à effet de serre", "gaz_effet_de_serre", "cause"),
    ("Elevage et utilisation des terres", "agriculture_et_utilisation_du_sol", "cause"),
    ("Pêche et chasse intensives", "peche_et_chasse", "cause"),
    ("Pollution plastique", "pollution", "conséquence"),
    ("Déforestation", "deforestation", "cause"),
    ("Surconsommation", "surconsommation", "cause"),
    ("Catastrophes naturelles", "catastrophes_naturelles", "conséquence"),
    ("Réchauffement climatique/canicules", "rechauffement_climatique_canicule", "conséquence"),
    ("Sécheresse", "secheresse", "conséquence"),
    ("Couche d'ozone", "couche_ozone", "conséquence"),
    ("Feu de forêt", "feu_foret", "conséquence"),
    ("Tensions alimentaires/famines", "tension_alim_famines", "conséquence"),
    ("Perte eau douce", "eau_potable", "conséquence"),
    ("Hausse des océans et fonte des glaces", "hausse_niveau_mer_fonte_glace", "conséquence"),
    ("Conséquence sociale", "consequence_sociale", "conséquence"),
    ("Acidification des océans", "acidification_ocean", "conséquence"),
    ("Biodiversité", "perte_biodiversite", "conséquence"),
    ("Pollution", "pollution", "conséquence"),
    ("Energie renouvelable et nucléaire", "energies_renouvelables_et_nucleaires", "solution"),
    ("Transports décarbonés", "transport_decarbone", "solution"),
    ("Engagements politiques et entreprises", "engagement_politique_et_entreprises", "solution"),
    ("Activisme écologique", "activisme_eco", "solution"),
    ("Solutions innovantes", "solution_innovante", "solution"),
    ("Comportement de consommation", "comportement_consommateur", "solution"),
    ("Reforestation", "reforestation", "solution"),
)

# A code that annotators may use although no display name leads to it.
CODE_WITHOUT_NAME = ("intrants_chimique_pollution_plastique", "cause")

MACRO_CODES = ("pollution", "ecosystemes", "dereglement_climatique", "energie", "politique")

THEMES = ("cause", "conséquence", "solution")

# Spellings used by the explorer's category list and the taxonomy code each stands for.
EXPLORER_SPELLINGS = {
    "pêche_et_chasse_intensives": "peche_et_chasse",
    "couches_ozone": "couche_ozone",
    "tension_alimentaire_famines": "tension_alim_famines",
}

FRENCH_MONTHS = (
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
)

OUTLET_COLOURS = {
    "arte": "#f08400",
    "fr3-idf": "#8fc7ff",
    "france2": "#ed2f28",
    "france5": "#f4a8a7",
    "itele": "#50ad9a",
    "m6": "#90ee9d",
    "tf1": "#3266c8",
    "France2": "#ed2f28",
    "France3": "#8fc7ff",
    "France5": "#f4a8a7",
    "M6": "#90ee9d",
    "Arte": "#f08400",
    "TF1": "#3266c8",
}

# model, size in billions of parameters, Wh per 1000 inferences, open source
MODEL_ENERGY = (
    ("mistral large", 123.0, 1100.0, False),
    ("Deepseek-Qwen-7B", 7.0, 17.5, True),
    ("small mistral", 24.0, 1100.0, False),
    ("mistral 8x7b", 12.9, 615.39, True),
    ("ministral 8b", 8.0, 20.87, True),
    ("mistral 7b", 7.0, 19.01, True),
    ("llama 3B", 3.0, 7.5, True),
    ("Deepseek-Qwen-1.5B", 1.5, 7.5, True),
    ("falcon-7B", 7.0, 15.88, True),
    ("chatgpt_ancien-3.5", 175.0, 1100.0, False),
)

# source, precision, recall, F1, top 1, top 3, unsure (all in percent)
PUBLISHED_RUN = ("chatgpt_ancien", 51.64, 54.25, 46.51, 63.04, 81.88, 1.45)

# Filter value that means "no filter".
EVERY = "Tous"
# --- end of fixed values -----------------------------------------------------

DISPLAY_NAMES = tuple(name for name, _, _ in CATEGORIES)


def _unique(values):
    return tuple(dict.fromkeys(values))


# The 24 codes a display name can lead to.
REACHABLE_CODES = _unique(code for _, code, _ in CATEGORIES)

# The 25 codes metrics are computed over, grouped by theme.
_CODE_THEMES = _unique([(code, theme) for _, code, theme in CATEGORIES] + [CODE_WITHOUT_NAME])
THEME_CODES = {t: tuple(c for c, theme in _CODE_THEMES if theme == t) for t in THEMES}
METRIC_CODES = tuple(c for t in THEMES for c in THEME_CODES[t])


def explorer_codes(legacy: bool = False) -> tuple[str, ...]:
    """Categories the explorer accepts, sorted.

    ``legacy`` keeps the double entry of the code that two names share.
    """
    codes = [code for _, code, _ in CATEGORIES]
    return tuple(sorted(codes if legacy else set(codes)))
