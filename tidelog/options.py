"""Options of a capture run: enumerated modes, defaults and their validation."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from enum import StrEnum


class CaptureMode(StrEnum):
    ONLINE = "online"
    ARCHIVE_ONLY = "archive_only"


class AgeAction(StrEnum):
    FAIL = "fail"
    DISCARD = "discard"


class OrphanAction(StrEnum):
    RELEASE = "release"
    FAIL = "fail"


class SnapshotMode(StrEnum):
    INITIAL = "initial"
    NONE = "none"
    SNAPSHOT_ONLY = "snapshot_only"
    ON_SIGNAL = "on_signal"


class LargeMode(StrEnum):
    SKIP = "skip"
    INLINE = "inline"
    RESELECT = "reselect"
    TOPIC = "topic"


class DecodeErrorAction(StrEnum):
    FAIL = "fail"
    DLQ = "dlq"


class OutputFormat(StrEnum):
    ENVELOPE = "envelope"
    FLAT = "flat"


class KeyPolicy(StrEnum):
    FAIL = "fail"
    ROWID = "rowid"
    NONE = "none"


@dataclass(frozen=True)
class Options:
    """What a run captures and how it renders it; database sessions and their tuning are no part of it."""

    include: list[str] = field(default_factory=list)
    exclude: list[str] = field(default_factory=list)
    containers: list[str] = field(default_factory=list)
    exclude_columns: list[str] = field(default_factory=list)
    exclude_users: list[str] = field(default_factory=list)
    capture: CaptureMode = CaptureMode.ONLINE
    snapshot: SnapshotMode = SnapshotMode.INITIAL
    snapshot_chunk_rows: int = 100_000
    large_values: LargeMode = LargeMode.INLINE
    format: OutputFormat = OutputFormat.ENVELOPE
    topic_template: str = "${server}.${schema}.${table}"
    tombstones: bool = True
    truncates: bool = False
    keyless: KeyPolicy = KeyPolicy.FAIL
    decode_error: DecodeErrorAction = DecodeErrorAction.FAIL
    max_age_ms: int | None = None
    max_age_action: AgeAction = AgeAction.FAIL
    orphan_ms: int | None = None
    orphan_action: OrphanAction = OrphanAction.FAIL
    decimals: str = "PRECISE"
    temporals: str = "ADAPTIVE"
    field_names: str = "NONE"

    def problems(self) -> list[str]:
        """What is wrong with the options, each with the option's name first."""
        found = []
        if self.snapshot_chunk_rows < 1000:
            found.append("snapshot_chunk_rows: at least 1000")
        if self.max_age_ms is not None and self.max_age_ms < 1:
            found.append("max_age_ms: positive or none")
        if self.orphan_ms is not None and self.orphan_ms < 1:
            found.append("orphan_ms: positive or none")
        if self.decimals not in ("PRECISE", "STRING", "DOUBLE"):
            found.append("decimals: PRECISE, STRING or DOUBLE")
        if self.temporals not in ("ADAPTIVE", "ISO_STRING"):
            found.append("temporals: ADAPTIVE or ISO_STRING")
        if self.field_names not in ("NONE", "AVRO", "AVRO_UNICODE"):
            found.append("field_names: NONE, AVRO or AVRO_UNICODE")
        if self.large_values == LargeMode.TOPIC and self.format != OutputFormat.FLAT:
            found.append("large_values: topics of their own belong to the flat format")
        return found

    @classmethod
    def of(cls, settings: dict[str, str]) -> Options:
        """Options of texts; lists are comma-separated, an unknown name is an error."""
        kinds = {f.name: f for f in fields(cls)}
        given = {}
        for name, text in settings.items():
            if name not in kinds:
                raise ValueError(f"unknown option {name}")
            default = kinds[name].default
            if isinstance(default, StrEnum):
                given[name] = type(default)(text.lower())
            elif isinstance(default, bool):
                given[name] = text.lower() == "true"
            elif isinstance(default, int) or name in ("max_age_ms", "orphan_ms"):
                given[name] = int(text)
            elif isinstance(default, str):
                given[name] = text
            else:
                given[name] = [p.strip() for p in text.split(",") if p.strip()]
        made = cls(**given)
        if wrong := made.problems():
            raise ValueError("; ".join(wrong))
        return made


def backoff_seconds(attempt: int, share: float) -> float:
    """Wait before a retry: 1 s doubling to 30 s, half of it fixed and half by ``share`` of 0 to 1."""
    wait = min(30.0, 2.0**attempt)
    return wait / 2 + wait / 2 * share


def split_chunk(rows: int, least: int = 1000) -> int | None:
    """Rows of a chunk after a read that came too late: half, down to a least; None gives up."""
    return None if rows <= least else max(least, rows // 2)
