"""Fixed values that must equal the reference's for right results."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Topic label dictionary (alphabetical, contiguous from 0).
LABEL2ID = {
    "business": 0,
    "entertainment": 1,
    "politics": 2,
    "sport": 3,
    "tech": 4,
}
ID2LABEL = {v: k for k, v in LABEL2ID.items()}
TOPIC_CLASSES = ["business", "entertainment", "politics", "sport", "tech"]

# Split percentages and sizes used by the jobs.
TEST_PCT = 10
VAL_PCT = 10
DAY_BUCKETS = 30
SAMPLE_INFERENCE_ROWS = 100
BASELINE_SAMPLE_ROWS = 1000
PREVIEW_CHARS = 300
SHORT_BODY_CHARS = 100
SCORING_BATCH_SIZE = 32
DAILY_CHUNK_ROWS = 64
MAX_LENGTH = 512
HEAD_TOKENS = 340
TAIL_TOKENS = 170
HIST_BINS = 20
SEED = 42
# Patterns applied by the cleaning step, in this order.
TAG_PATTERN = r"<[^>]+>"
ENTITY_PATTERN = r"&(?:amp|lt|gt|quot|apos|nbsp);|&#\d+;"
WS_PATTERN = r"\s+"
# Run directory stamp (UTC).
STAMP_FORMAT = "yyyy-MM-dd'T'HH-mm-ss"
# Reserved vocabulary entries for the encoder, ids 0..3.
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]
# Report configuration rows: (display name, run parameter key, default).
REPORT_CONFIG_ROWS = [
    ("Base model", "bert_base_model", "bert-base-uncased"),
    ("Max sequence length", "max_seq_length", "512"),
    ("Epochs", "epochs", "5"),
    ("Batch size", "batch_size", "8"),
    ("Learning rate", "lr", "2e-05"),
    ("Warmup steps", "warmup_steps", "100"),
    ("Weight decay", "weight_decay", "0.01"),
    ("Early stopping patience", "early_stopping_patience", "3"),
    ("Num labels", "num_labels", "5"),
]
# ---------------------------------------------------------------------------

# Classes of the driver's test tables when `documents.lang` is the category.
LANG_CLASSES = ["de", "en", "es", "fr"]
LANG2ID = {c: i for i, c in enumerate(LANG_CLASSES)}
