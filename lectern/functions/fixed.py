"""Lists, thresholds and patterns on which the results of the text functions depend."""

from __future__ import annotations

# Grammatical words that are not counted as terms.
STOPWORDS = """
the a an and or of in on to at by for with
that this these those is are was were be been being
have has had do does did will would shall should
may might can could not no nor so yet but both
either neither as if then there here when where which
who whom whose what how it its he she they we you
i me him her them us my your his our their
from into up out about after before between through
now also only just even than more very each all any
some such other same own new first last long great
little good well back over still though however thus
upon per own one two three four five six seven eight
""".split()

# Letters of transliteration that belong to a word.
TRANSLITERATION = "āīūṛṝḷḹṃṁḥṅñṭḍṇśṣēōĀĪŪṚṜḶḸṂṀḤṄÑṬḌṆŚṢĒŌ"

# Inverse document frequency of a word that a table lacks, and the scale of TF-IDF scores.
UNKNOWN_IDF = 9.59
TFIDF_SCALE = 1_000_000

# Least score of each band.
BANDS = ((50_000, "dominant"), (10_000, "very high"), (3_000, "high"), (500, "medium"), (50, "low"), (0, "very low"))

# Code-point ranges of scripts.
SCRIPTS = (("deva", 0x0900, 0x097F), ("tibt", 0x0F00, 0x0FFF), ("hani", 0x4E00, 0x9FFF), ("sinh", 0x0D80, 0x0DFF), ("mymr", 0x1000, 0x109F), ("thai", 0x0E00, 0x0E7F))

# Marks that separate Tibetan syllables and clauses, and the letters' range.
TSHEG, TSHEG_NB, SHAD = "་", "༌", "།"
TIBETAN_RUN = "[ཀ-ྼ]+"
DELIMITERS = "[།༎་༅༄༈\\s]"

# Gap in seconds up to which messages of an author are one unit, and lengths under which a message is vague.
STITCH_SECONDS = 600
VAGUE_SHORT, VAGUE_LONG = 60, 160
VAGUE = r"\b(this|that|it|here|these|those|same|above|below)\b"

# Thresholds of contested renderings, phrases, pairs and claims.
MIN_TOTAL, MIN_SECOND, MIN_VARIATION = 5, 2, 0.15
PHRASE_MIN_DF, PHRASE_MAX_WORDS = 3, 4
PAIR_MIN_COUNT, PAIR_MIN_SCORE, PAIRS_PER_KEYWORD = 2, 0.25, 5
SIGNATURE_FACTOR, SIGNATURE_TOP = 3, 25
