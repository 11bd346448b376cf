"""Fixed values that define the results of the translation-preparation jobs."""

# Sizes and limits.
SHARD_SIZE = 64_000
TOKENIZE_BATCH = 64
BATCH_SIZE = 256
MAX_TOKENS = 256
MAX_PAD = 260
SHARDS_PER_FILE = 2_500

# Special token ids. Ordinary vocabulary ids follow the unknown id.
BOS_ID = 0
PAD_ID = 1
EOS_ID = 2
START_ID = 2
UNK_ID = 3
MASK_PAD = 0
IGNORED_LABEL = -100
FIRST_TOKEN_ID = 4

# Characters stripped from both ends of a sentence.
SYMBOLS = "@#$^&*-_+=[]{}|\\<>/\n"
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = r"[\s\x1c-\x1f\x85\p{Z}]"

# Patterns, in Java regex syntax.
DELIMITERS = r"(?<!\p{Nd})\.(?!\p{Nd})|[?!।|॥؟۔\n]\n*"
BULLET = rf"\A{WHITESPACE_CLASS}*+(?:•|○|\*|-|[0-9]++\.){WHITESPACE_CLASS}*+"
PLACEHOLDER = r"<ID[0-9]+>"
# Spans kept out of translation. Runs are matched possessively and not begun inside, so matching stays
# linear and never recurses deeply, whatever the sentence holds.
ENTITY = (
    r"<ID[0-9]+>"
    r"|https?://[^ \t\n\r<>]+"
    r"|www\.[^ \t\n\r<>]+"
    r"|(?:(?<![A-Za-z0-9_.+-])|\G)[A-Za-z0-9_.+-]++@[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++)++"
    r"|\p{Nd}++(?:[.,]\p{Nd}++)*+"
)
# Every entity holds one of these.
ENTITY_HINT = r"[\p{Nd}@]|://|www\."

# Documents summed in one in-order bucket by the ordinal computation. Small enough for a window to
# hold a bucket in memory, large enough to leave few buckets per file.
BUCKET_ROWS = 512

# A lookup table is shipped to the tasks only up to these sizes; beyond them it is joined.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Two numbers of 8 bytes per file.
BROADCAST_FILES = BROADCAST_BYTES // 16
# Default bound of a vocabulary that a job builds itself.
VOCAB_SIZE = 250_000
# Most frequent entries shipped when the whole table is too large, and the longest key among them. Within the bound of a table that
# is shipped whole; each row with an element beyond them moves.
HOT_ROWS = 400_000
HOT_KEY_BYTES = 64
