"""Options of the source."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from changefeed.schema import DEFAULT_CAP, DEFAULT_PAGE, LATEST, TRIM_HORIZON

# Option names, matched without regard to case.
STREAM_NAME = "streamname"
STARTING_POSITION = "startingposition"
PATH = "path"
INCLUDE_SHARD_ID = "includeshardid"
INCLUDE_SEQUENCE_KEY = "includesequencekey"
MAX_RECORDS_PER_SHARD = "executor.maxfetchrecordspershard"
MAX_RECORDS_PER_READ = "executor.maxrecordperread"
LOG_KIND = "executor.metadata.committer"
LOG_PATH = "executor.metadata.path"


# Blanks and control characters, code points 0 to 32.
_BLANKS = "".join(chr(code) for code in range(33))

# Fixed value: how a missing stream name is reported.
_NO_STREAM = "Stream name is a required field"


def log_settings(options: dict[str, str]) -> tuple[str, str | None]:
    """Type and place of the position log, as the options of a stream name them."""
    lowered = {k.lower(): v for k, v in options.items()}
    return find_option(lowered, LOG_KIND) or "hdfs", find_option(lowered, LOG_PATH)


# Option names of batch reads, and the fields that hold them.
_WANTED = {
    "fromsequence": "from_sequence",
    "tosequence": "to_sequence",
    "fromtime": "from_time",
    "totime": "to_time",
}
SHARD_IDS = "shardids"


@dataclass(frozen=True)
class Wanted:
    """What a batch read is to give; ``None`` is no bound. The end of the time is not in it."""

    shards: tuple[str, ...] | None = None
    from_sequence: str | None = None
    to_sequence: str | None = None
    from_time: str | None = None
    to_time: str | None = None


def _wanted(options: dict[str, str]) -> Wanted:
    shards = options.get(SHARD_IDS)
    named = {field: options[name].strip(_BLANKS) for name, field in _WANTED.items() if name in options}
    for field in ("from_sequence", "to_sequence"):
        if field in named and not (named[field].isascii() and named[field].isdecimal()):
            raise ValueError(f"{field.replace('_', ' ')} is no sequence number: {named[field]!r}")
    for field in ("from_time", "to_time"):
        if field in named:
            datetime.fromisoformat(named[field])
    return Wanted(None if shards is None else tuple(s.strip(_BLANKS) for s in shards.split(",")), **named)


@dataclass(frozen=True)
class FeedOptions:
    """Validated options; the limits hold whether or not they were asked for."""

    stream_name: str
    path: str
    start: str
    include_shard_id: bool
    page: int
    cap: int
    include_sequence_key: bool = False
    wanted: Wanted = Wanted()


def starting_position(text: str | None) -> str:
    """``LATEST`` if absent; blanks around it and its case do not matter."""
    if text is None:
        return LATEST
    wanted = text.strip(_BLANKS).lower()
    if wanted == "latest":
        return LATEST
    if wanted == "trim_horizon":
        return TRIM_HORIZON
    raise ValueError(f"startingPosition must be one of latest, trim_horizon; got: {text}")


def find_option(options: dict[str, str], name: str) -> str | None:
    """An option by its name, alone or behind a prefix such as ``feed.``."""
    for key, value in options.items():
        lowered = key.lower()
        if lowered == name or lowered.endswith("." + name):
            return value
    return None


def _count(options: dict[str, str], name: str, least: int, default: int) -> int:
    text = find_option(options, name)
    if text is None:
        return default
    value = int(text)
    if value < least:
        raise ValueError(f"{name} must be at least {least}, not {value}")
    return value


def parse_options(options: dict[str, str]) -> FeedOptions:
    lowered = {k.lower(): v for k, v in options.items()}
    stream = lowered.get(STREAM_NAME)
    if not stream:
        raise ValueError(_NO_STREAM)
    path = lowered.get(PATH)
    if not path:
        raise ValueError("path of the stored feed is a required field")
    return FeedOptions(
        stream_name=stream,
        path=path.rstrip("/"),
        start=starting_position(lowered.get(STARTING_POSITION)),
        include_shard_id=lowered.get(INCLUDE_SHARD_ID, "false").lower() == "true",
        page=_count(lowered, MAX_RECORDS_PER_READ, 1, DEFAULT_PAGE),
        cap=_count(lowered, MAX_RECORDS_PER_SHARD, 0, DEFAULT_CAP),
        include_sequence_key=lowered.get(INCLUDE_SEQUENCE_KEY, "false").lower() == "true",
        wanted=_wanted(lowered),
    )
