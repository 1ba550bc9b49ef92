"""Defaults for every operator. Each is also an argument where it is used."""

# Corpus filters, transcript bounds, shard and context sizes.
LANGUAGE = "Gujarati"
STATE = "Gujarat"
MIN_DURATION_S = 1.0
MAX_DURATION_S = 20.0
MIN_CHARS = 2
MAX_CHARS = 400
ROWS_PER_SHARD = 500
MAX_SEQ_LEN = 1024
EVAL_RATIO = 0.05
SEED = 42
BATCH_ROWS = 2

# Speech tokens and the processed rows' constant.
TOKEN_TEMPLATE = "<|s_{}|>"
TOKEN_PATTERN = r"<\|s_(\d+)\|>"
TOKEN_RATE_HZ = 25
TOKEN_RANGE = 12800
TRANSCRIPT_SOURCE = "asr_indicconformer"

# Pause detection and its tag.
PAUSE_TAG = "<pause>"
TOP_DB = 30.0
MIN_SILENCE_MS = 350
FRAME_LENGTH = 2048
HOP_LENGTH = 512
POWER_FLOOR = 1e-10

# ChatML markers and the label that is not scored.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
IGNORED_LABEL = -100

# Character classes, as regular expressions write them inside brackets. The script is one range and
# ASCII characters are listed singly: Java tests listed Latin-1 characters in one table, but ranges one by one, which
# was five times slower. SPACES are the characters Python calls whitespace, and SPACE_CLASS the same.
SCRIPT_CLASS = r"\x{0A80}-\x{0AFF}"
ASCII_KEPT = r"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz.,!?<>\[\]"
KEPT_CLASS = ASCII_KEPT + SCRIPT_CLASS + r"\x{0ABD}\x{0964}\x{0965}\x{0903}"
SPACE_CLASS = r"\t\n\x{0B}\f\r\x{1C}\x{1D}\x{1E}\x{1F} \x{85}\x{A0}\p{Z}"
SPACES = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Rows of one ordered bucket: what a single task sorts at most (operators.ranking).
BUCKET_ROWS = 65536
AUDIO_BUCKET_ROWS = 1024
# Rows and bytes of one Arrow batch that crosses into Python, and of one that models are given.
ARROW_ROWS = 4096
ARROW_BYTES = 8 << 20
MODEL_ROWS = 256
MODEL_BYTES = 16 << 20
# Rows that are read at once from a table of arrays.
SCAN_ROWS = 256
# Source rows of the first slice that goes through the models when only some are wanted (plans.curation).
FIRST_SLICE = 64
# Files of each folder that enter a corpus' manifest first (sources.manifest).
FIRST_FILES = 4
# Consecutive shards that share a folder (sources.shards).
SHARDS_PER_FOLDER = 256
# Micro-batches after which running sums are folded together (streaming.flows).
COMPACT_BATCHES = 16
# Files of one micro-batch (sources.corpus).
FILES_PER_BATCH = 64
# Largest lookup table, in bytes, that is broadcast (operators.lookup).
BROADCAST_BYTES = 64 << 20
# Words looked up in a broadcast table before the rest of a large vocabulary is joined, and their length in bytes.
FREQUENT_WORDS = 10_000
FREQUENT_WORD_BYTES = 64
