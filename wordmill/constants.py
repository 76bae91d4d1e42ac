"""Parameters and fixed values shared by the operators."""

# ---------------------------------------------------------------------------
# FIXED VALUES: these must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------

# Custom stop words shipped with the original configuration (one per line).
CONFIG_STOPWORDS = ("i", "oraz", "także", "dlatego", "wszystko", "mieć", "mówić")

# Retry policy for transcript downloads: after `attempts` failures the next
# try waits WAIT_SECONDS[min(attempts, 5)] seconds; MAX_ATTEMPTS stops it.
MAX_ATTEMPTS = 6
WAIT_SECONDS = (0, 60, 3600, 86400, 86400, 86400)

# Transcript file size bins in bytes: label and [low, high) bounds.
SIZE_BINS = (
    ("< 1 KB", 0, 1024),
    ("1 KB - 10 KB", 1024, 10240),
    ("10 KB - 20 KB", 10240, 20480),
    ("20 KB - 50 KB", 20480, 51200),
    ("50 KB - 100 KB", 51200, 102400),
    ("> 100 KB", 102400, None),
)

# Characters removed from a path part, and its maximum length.
PATH_FORBIDDEN_CHARS = '<>:"/\\|?*'
PATH_PART_MAX_LEN = 50

# Video list columns, in file order.
VIDEO_COLUMNS = ("video_id", "title", "description", "published_at", "channel_id", "channel_name")

# Identifier prefix that marks a channel id (anything else is a name).
CHANNEL_ID_PREFIX = "UC"

# Defaults of the analyses.
DEFAULT_TOP_N = 50
DEFAULT_TREND_TOP_N = 15
DEFAULT_MIN_LENGTH = 3
DEFAULT_CHUNK_SIZE = 5000

# ---------------------------------------------------------------------------
# Engine parameters (ours).
# ---------------------------------------------------------------------------

# Largest row count we allow to be broadcast after a size check.
BROADCAST_MAX_ROWS = 200_000
# ... and the largest estimated size in bytes (conf: wordmill.broadcast.maxBytes).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

# Rows (segments) per text block when segment lines are assembled into text.
# Bounds the size of every aggregation group, whatever the video length.
SEGMENT_BLOCK_ROWS = 256

# Width up to which the word x day matrix uses one conditional sum per day.
CONDITIONAL_PIVOT_MAX_DAYS = 64

# Skew handling: a join key holding at least HOT_KEY_ROWS rows on the large
# side is split over SALT_BUCKETS tasks (session conf overrides:
# wordmill.skew.hotKeyRows, wordmill.skew.saltBuckets).
HOT_KEY_ROWS = 1_000_000
# Length of the broadcast hot-key list.
HOT_KEYS_MAX = 10_000
SALT_BUCKETS = 64
