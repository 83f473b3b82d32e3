"""Row schemas, option dataclasses and fixed constants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Word tokenisers: split on runs of non-letters; alternative ASCII form.
TOKENIZER_PATTERN = "[^\\p{L}]+"
ASCII_TOKENIZER_PATTERN = "[^a-zA-Z']+"
# Default full-match filter of the filtered word count.
DEBUG_FILTER_PATTERN = "it|PGM"
# Display zone and format of window starts and processing times.
DISPLAY_ZONE = "America/Los_Angeles"
DISPLAY_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
# Option format of the hourly team score start/stop bounds.
RANGE_OPTION_FORMAT = "yyyy-MM-dd-HH-mm"
DEFAULT_START = "1970-01-01-00-00"
DEFAULT_STOP = "2100-01-01-00-00"
# Game defaults (minutes unless named otherwise).
TEAM_WINDOW_MINUTES = 60
ALLOWED_LATENESS_MINUTES = 120
EARLY_FIRING_MINUTES = 5
LATE_FIRING_MINUTES = 10
SESSION_GAP_MINUTES = 5
SESSION_MEAN_WINDOW_MINUTES = 30
SCORE_WEIGHT = 2.5
LEVEL_THRESHOLD = 5000
WORD_WINDOW_MINUTES = 10
# Person records.
PERSON_FIELDS = ("name", "sex", "age", "weight", "height")
AGE_OF_MINOR = 18
NAME_PATTERN = "[A-Za-z0-9 ]*"
SEX_PATTERN = "[M|F]"
INT_FIELD_PATTERN = "[0-9]{1,3}"
# Output column order of the text renderings (declared, not hash order).
USER_SCORE_TEXT_FIELDS = ("total_score", "user")
HOURLY_TEAM_TEXT_FIELDS = ("window_start", "total_score", "team")
# Pane timing labels.
EARLY, ON_TIME, LATE = "EARLY", "ON_TIME", "LATE"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])

GAME_EVENT_SCHEMA = T.StructType([
    T.StructField("user", T.StringType(), True),
    T.StructField("team", T.StringType(), True),
    T.StructField("score", T.IntegerType(), True),
    T.StructField("timestamp_ms", T.LongType(), True),
    T.StructField("event_time", T.TimestampType(), True),
])

PERSON_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("sex", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("weight", T.IntegerType(), True),
    T.StructField("height", T.IntegerType(), True),
    T.StructField("minor", T.BooleanType(), True),
])

KV_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])


# ---------------------------------------------------------------------------
# Job options (typed, with defaults; required ones have no default)
# ---------------------------------------------------------------------------
def _need(source: str, target: str) -> None:
    if not source:
        raise ValueError("a job needs an input or an input topic")
    if not target:
        raise ValueError("a job needs an output")


@dataclass(frozen=True)
class WordCountOptions:
    input: str
    output: str
    pattern: str = TOKENIZER_PATTERN


@dataclass(frozen=True)
class DebuggingWordCountOptions:
    input: str
    filter_pattern: str = DEBUG_FILTER_PATTERN
    expected: tuple = ()          # (word, count) pairs the job must produce


@dataclass(frozen=True)
class WindowedWordCountOptions:
    input: str
    output: str
    window_minutes: int = WORD_WINDOW_MINUTES
    min_timestamp_ms: int | None = None     # default: now
    max_timestamp_ms: int | None = None     # default: min + 1 hour
    num_shards: int | None = None           # stream: 3 if not given
    seed: int = 0
    watermark_delay_seconds: int = 0        # stream: lines this late still count
    input_topic: str = ""                   # stream: a topic of messages with their event time as an attribute
    timestamp_attribute: str = ""
    max_files_per_trigger: int | None = None
    checkpoint: str = ""


@dataclass(frozen=True)
class UserScoreOptions:
    input: str
    output: str


@dataclass(frozen=True)
class HourlyTeamScoreOptions:
    input: str
    output: str
    window_minutes: int = TEAM_WINDOW_MINUTES
    start_min: str = DEFAULT_START
    stop_min: str = DEFAULT_STOP


@dataclass(frozen=True)
class LeaderBoardOptions:
    input: str = ""
    output: str = ""
    team_window_minutes: int = TEAM_WINDOW_MINUTES
    allowed_lateness_minutes: int = ALLOWED_LATENESS_MINUTES
    early_minutes: int = EARLY_FIRING_MINUTES
    late_minutes: int = LATE_FIRING_MINUTES
    user_minutes: int = LATE_FIRING_MINUTES       # how often the users' totals fire
    watermark_delay_seconds: int = 0
    timestamp_attribute: str = ""                 # input is JSON messages; event time is this attribute
    max_files_per_trigger: int | None = None
    checkpoint: str = ""                          # folder; default: next to the output
    input_topic: str = ""                         # a topic of messages (sources.topics) instead of `input`

    def __post_init__(self):
        _need(self.input or self.input_topic, self.output)


@dataclass(frozen=True)
class GameStatsOptions:
    input: str = ""
    output: str = ""
    fixed_window_minutes: int = TEAM_WINDOW_MINUTES
    session_gap_minutes: int = SESSION_GAP_MINUTES
    user_activity_window_minutes: int = SESSION_MEAN_WINDOW_MINUTES
    score_weight: float = SCORE_WEIGHT
    watermark_delay_seconds: int = 0              # rows this late still count
    timestamp_attribute: str = ""                 # input is JSON messages; event time is this attribute
    max_files_per_trigger: int | None = None
    checkpoint: str = ""                          # folder; default: next to the output
    input_topic: str = ""                         # a topic of messages (sources.topics) instead of `input`

    def __post_init__(self):
        _need(self.input or self.input_topic, self.output)


@dataclass(frozen=True)
class StatefulTeamScoreOptions:
    input: str = ""
    output: str = ""
    threshold: int = LEVEL_THRESHOLD
    timestamp_attribute: str = ""                 # input is JSON messages; event time is this attribute
    max_files_per_trigger: int | None = None
    checkpoint: str = ""                          # folder; default: next to the output
    input_topic: str = ""                         # a topic of messages (sources.topics) instead of `input`

    def __post_init__(self):
        _need(self.input or self.input_topic, self.output)


@dataclass(frozen=True)
class PersonOptions:
    input: str = ""
    output: str = ""
    mode: str = "batch"       # batch | stream_topics | stream_table
    max_files_per_trigger: int | None = None
    checkpoint: str = ""      # folder; default: next to the output
    input_topic: str = ""                         # a topic of messages (sources.topics) instead of `input`
    output_topic: str = ""                        # topic of the valid people instead of `output` (stream_topics)
    invalid_topic: str = ""                       # default: the output topic with _invalid

    def __post_init__(self):
        _need(self.input or self.input_topic, self.output or self.output_topic)


@dataclass(frozen=True)
class ExternalProgramOptions:
    output: str
    input: str = ""              # text lines become the values; empty: rows 0..n_rows-1
    n_rows: int = 10_000
    command: tuple = ("cat",)
    passes: int = 2              # the program is applied this many times in a row
    timeout_sec: float = 3600.0
    per_row: bool = False
    framed: bool = False         # the program speaks frames: 0..n values per row from one run per partition
