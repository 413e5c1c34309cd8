"""Settings of the pipeline, from values or environment variables, and their small parsers."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

POST = "app.bsky.feed.post"
FLOOR_YEAR, FLOOR_KEY = 2023, 202200  # records before this year share one partition


def parse_shard(text: str) -> tuple[int, int]:
    """'n/K' with 0 <= n < K; empty means all repositories."""
    if not text:
        return 0, 1
    n, slash, k = text.partition("/")
    try:
        shard, of = int(n.strip()), int(k.strip())
    except ValueError:
        raise ValueError(f"a shard is n/K, not {text!r}") from None
    if not slash or not 0 <= shard < of:
        raise ValueError(f"a shard needs 0 <= n < K, not {text!r}")
    return shard, of


@dataclass
class Settings:
    warehouse: str = "warehouse"
    checkpoint: str = "checkpoint"
    shard: str = ""
    disable_stream: bool = False
    disable_backfill: bool = False
    gate_backfilling: bool = False
    max_files_per_trigger: int = 64
    trigger_seconds: int = 5
    rows_per_file: int = 5_000_000
    compact_after_files: int = 3000
    compact_seconds: int = 1200
    retry_seconds: int = 2
    from_cursor: bool = False
    shutdown_seconds: int = 30
    post_collection: str = POST

    @classmethod
    def from_env(cls, env=os.environ, prefix: str = "FIRELARK_") -> Settings:
        got = {}
        for f in fields(cls):
            if (raw := env.get(prefix + f.name.upper())) is not None:
                got[f.name] = raw.lower() in ("1", "true", "yes") if f.type == "bool" else int(raw) if f.type == "int" else raw
        return cls(**got)
