"""Text normalisation, tokens and chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ" "āăąćčďđēęěğīıłńňōőřśşšťūůűźżžțș"
UNACCENTED = "aaaaaaceeeeiiiinoooooouuuuyy" "aaaccddeeegiilnnoorssstuuuzzzts"
COMBINING_MARKS = "\u0300\u0301\u0302\u0303\u0308\u0327"
LIGATURES = (("œ", "oe"), ("æ", "ae"), ("ß", "ss"))

#: Greek and Cyrillic letters that one Latin letter stands for, and those that need several.
GREEK = "αάβγδεέζηήιίϊΐκλμνξοόπρσςτυύϋΰωώ"
GREEK_LATIN = "aabgdeezeeiiiiklmnxooprsstuuuuoo"
CYRILLIC = "абвгдезийклмнопрстуфыэіґ"
CYRILLIC_LATIN = "abvgdeziiklmnoprstufyeig"
CYRILLIC_SIGNS = "ъь"
DIGRAPHS = (
    ("θ", "th"), ("φ", "ph"), ("χ", "kh"), ("ψ", "ps"),
    ("ё", "io"), ("ж", "zh"), ("х", "kh"), ("ц", "ts"), ("ч", "ch"), ("ш", "sh"), ("щ", "shch"), ("ю", "iu"), ("я", "ia"),
    ("є", "ie"), ("ї", "yi"),
)
#: Endings that are words of their own: don't is do and n't.
CONTRACTION = r"([a-z])(n['’]t|['’](?:s|ll|re|ve|d|m))\b"

#: Spark's own lists, as text so that neither a session nor its jars are needed.
STOP_WORDS = {
    "french": """
        au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais me même mes moi
        mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une
        vos votre vous c d j l à m n s t y été étée étées étés étant étante étants étantes suis es est
        sommes êtes sont serai seras sera serons serez seront serais serait serions seriez seraient étais
        était étions étiez étaient fus fut fûmes fûtes furent sois soit soyons soyez soient fusse fusses fût
        fussions fussiez fussent ayant ayante ayantes ayants eu eue eues eus ai as avons avez ont aurai
        auras aura aurons aurez auront aurais aurait aurions auriez auraient avais avait avions aviez
        avaient eut eûmes eûtes eurent aie aies ait ayons ayez aient eusse eusses eût eussions eussiez
        eussent
    """.split(),
    "english": """
        i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
        hers herself it its itself they them their theirs themselves what which who whom this that these
        those am is are was were be been being have has had having do does did doing a an the and but if or
        because as until while of at by for with about against between into through during before after
        above below to from up down in out on off over under again further then once here there when where
        why how all any both each few more most other some such no nor not only own same so than too very s
        t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
        they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
        weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
        couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
        would
    """.split(),
}

EXTRA_STOP_WORDS = {
    "french": ("apres", "comme", "selon", "nbsp", "jamais", "journal", "sujets", "theme", "televise"),
    "english": (
        "after", "like", "according to", "nbsp", "never", "journal", "subjects", "topic", "television",
    ),
}

TOKEN = r"[\p{L}\p{N}_'’]"
CHUNK_SIZE = 4999
# --- end of fixed values -----------------------------------------------------


#: Letters one to one; translate drops those behind the last counterpart: combining marks, hard and soft signs.
SINGLE = ACCENTED + GREEK + CYRILLIC + CYRILLIC_SIGNS + COMBINING_MARKS
SINGLE_LATIN = UNACCENTED + GREEK_LATIN + CYRILLIC_LATIN


def normalise(text: Column) -> Column:
    """Lower case in plain Latin letters: accents go, Greek and Cyrillic are transliterated.

    Other scripts stay as they are.
    """
    plain = F.lower(text)
    for ligature, letters in LIGATURES:
        plain = F.replace(plain, F.lit(ligature), F.lit(letters))
    spelled = plain
    for letter, letters in DIGRAPHS:
        spelled = F.replace(spelled, F.lit(letter), F.lit(letters))
    # Most texts hold no such letter (the ohm sign is omega in capitals). Conditions look at the text as it came: higher-order
    # functions evaluate an expression as often as it is named, and this way no step is named twice.
    plain = F.when(text.rlike("[\\u0370-\\u04FF\\u2126]"), spelled).otherwise(plain)
    return F.when(is_ascii(text), F.lower(text)).otherwise(F.translate(plain, SINGLE, SINGLE_LATIN))


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def normalise_word(word: str) -> str:
    """``normalise`` for one configuration word on the driver."""
    word = word.lower()
    for ligature, letters in (*LIGATURES, *DIGRAPHS):
        word = word.replace(ligature, letters)
    return word.translate(str.maketrans(ACCENTED + GREEK + CYRILLIC, SINGLE_LATIN, CYRILLIC_SIGNS + COMBINING_MARKS))


def tokens(text: Column) -> Column:
    """Words of normalised text, with the digits and apostrophes inside them.

    English contractions are cut before their ending; elided articles (l'eau) stay with their word.
    """
    return F.regexp_extract_all(_parted(text), F.lit(rf"({TOKEN}+)"), F.lit(1))


def _parted(text: Column) -> Column:
    """Normalised text, contractions cut before their ending; texts without an apostrophe have none."""
    plain = normalise(text)
    return F.when(text.contains("'") | text.contains("’"), F.regexp_replace(plain, CONTRACTION, "$1 $2")).otherwise(plain)


def words(text: Column) -> Column:
    """Runs of letters and digits of normalised text."""
    return F.regexp_extract_all(normalise(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def stop_words(language: str) -> list[str]:
    """The language's stop words without accents, plus the project's own."""
    if language not in EXTRA_STOP_WORDS:
        raise ValueError(f"language not available: {language}; choose french or english")
    plain = {normalise_word(w) for w in STOP_WORDS[language]}
    return sorted(plain | set(EXTRA_STOP_WORDS[language]))


def letters_only(found: Column) -> Column:
    """Keep the words made of letters alone."""
    return F.filter(found, lambda w: w.rlike(r"^\p{L}+$"))


def clean_tokens(text: Column, language: str = "french") -> Column:
    """Normalised tokens of letters alone, without stop words; ``co2`` goes as a whole."""
    stops = stop_words(language)
    # one look at each token: group 1 is empty for those that are not letters alone
    found = F.regexp_extract_all(_parted(text), F.lit(rf"(\p{{L}}++)(?!{TOKEN})|{TOKEN}++"), F.lit(1))
    return F.filter(found, lambda w: ~w.isin(["", *stops]))


def chunks(text: Column, size: int = CHUNK_SIZE) -> Column:
    """Consecutive slices of ``size`` characters.

    A text whose length is a multiple of ``size`` ends with an empty slice, as
    does the empty text. One regular-expression pass, linear in the text.
    """
    slices = F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{size}}})"), F.lit(1))
    empty = F.array(F.lit(""))
    return F.when(F.length(text) % size == 0, F.concat(slices, empty)).otherwise(slices)
