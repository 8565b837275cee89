from __future__ import annotations

import pytest

from tidelog.functions.types import RAW_ROW, SOURCE_BLOCK
from tidelog.options import KeyPolicy, LargeMode, Options, backoff_seconds, split_chunk


def test_options_of_texts():
    got = Options.of({"include": "A\\.B, C", "keyless": "ROWID", "tombstones": "false", "max_age_ms": "5", "large_values": "skip"})
    assert got.include == ["A\\.B", "C"] and got.keyless is KeyPolicy.ROWID and not got.tombstones and got.max_age_ms == 5 and got.large_values is LargeMode.SKIP
    for bad in ({"nothing": "1"}, {"keyless": "maybe"}, {"snapshot_chunk_rows": "5"}, {"large_values": "topic"}, {"decimals": "x"}):
        with pytest.raises(ValueError):
            Options.of(bad)


def test_waits_and_chunks():
    assert [backoff_seconds(k, 0) for k in range(7)] == [0.5, 1, 2, 4, 8, 15, 15]
    assert split_chunk(5000) == 2500 and split_chunk(1500) == 1000 and split_chunk(1000) is None


def test_fixed_shapes():
    assert len(RAW_ROW) == 34 and len(SOURCE_BLOCK) == 19


def test_command_line(capsys, spark, sf_dir):
    from tidelog.__main__ import main

    assert main(["list"]) == 0 and "j6_materialise" in capsys.readouterr().out
    assert main(["options", "keyless=none"]) == 0
