"""Defaults shared by the operators."""

from __future__ import annotations

# --- Fixed values: they must equal the published defaults for results to agree ---
MIN_SAMPLE_CHARS = 20
TRAIN_RATIO = 0.64
VAL_RATIO = 0.16
TEST_RATIO = 0.20
HOLDOUT_FRACTION = 0.1
OOV_HOLDOUT_FRACTION = 0.15
SEED = 42
MAX_TRAIN_ROWS = 24000
CV_FOLDS = 5

FOREST_TREES = 250
BOOSTING_ROUNDS = 300
BOOSTING_DEPTH = 6
BOOSTING_STEP = 0.05
BOOSTING_SHARE = 0.9
OOV_BOOSTING_ROUNDS = 200
OOV_BOOSTING_DEPTH = 5
GRID_STEPS = (0.02, 0.03, 0.04, 0.05, 0.06, 0.07)
MIN_MERGED_ROWS = 20

TFIDF_MAX_TERMS = 6000
TFIDF_NGRAMS = (1, 2)
TFIDF_MIN_DF = 3
TFIDF_MAX_DF = 0.9

POSITIVE_LABELS = ("Depression",)
TWO_CLASS_LABELS = ("Depression", "Normal")
TEXT_COLUMNS = ("text", "statement", "content", "clean_text", "tweet", "post")
LABEL_COLUMNS = ("status", "label", "class", "target", "mental_health", "is_depression")

TIER_LOW = 0.35
TIER_HIGH = 0.70

GATE_MIN_CHARS = 12
SOFT_CHARS = 40
MEDIUM_CHARS = 80
MIN_WORDS = 8
LATIN_RATIO = 0.82
EVIDENCE_LIMIT = 5
EXPANSIONS_PER_LINE = 80

OVERRIDE_MAX_SCORE = 0.45
OVERRIDE_MIN_SENTIMENT = 0.50
STRONG_POSITIVE_MIN_SENTIMENT = 0.75
STRONG_POSITIVE_MAX_SCORE = 0.90
SHORT_MAX_SCORE_FOR_HIGH = 0.88
HIGH_NEEDS_LEXICON = True
HIGH_MIN_SCORE_WITHOUT_LEXICON = 0.92
DISTRESS_MAX_SENTIMENT = -0.25
DISTRESS_MIN_CUES = 2

LABEL_DISCLAIMER = (
    "Labels reflect dataset authors / heuristics (e.g. Reddit self-report or Kaggle crowdsourcing), "
    "not clinical diagnosis. Do not use outputs for medical decisions or crisis triage."
)
SCORE_DISCLAIMER = "Model-positive score, not a clinical probability or diagnosis."
# --- end of fixed values ---

# Limits of what may travel through the driver or be broadcast. Every use has a
# distributed path for inputs beyond the limit, or refuses with an error.
LOCAL_TABLE_ROWS = 50_000
LOOKUP_BYTES = 32 << 20
FREQUENT_WORDS = 4_096
ROW_ENTRIES = 24
BATCH_TEXTS = 1_024
TEXTS_PER_BATCH = 500
AUTOMATON_BYTES = 32 << 20
AUTOMATA_AT_ONCE = 4
LEXICON_PART_CHARS = 1 << 22
EXACT_DIGEST_ROWS = 1_000_000
DIGEST_LEAF = 1_024
# Rows of ready features to a task of a linear fit: up to five tasks need one stage per step.
FIT_ROWS = 8_000
