"""Settings of a run: limits and budgets from the environment, each with a default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import PurePosixPath


def env_int(env: Mapping[str, str], name: str, default: int) -> int:
    """The whole part of a positive number; anything else gives the default."""
    try:
        value = float(env.get(name) or "")
    except ValueError:
        return default
    return int(value) if 1 <= value < float("inf") else default


@dataclass(frozen=True)
class Settings:
    """``output`` is where files go: named, or a folder of that name below the root."""

    root: str
    output: str
    candidate_domains: int
    discovery_budget_ms: int
    fallback_budget_ms: int
    rendered: bool
    rendered_off_hosts: tuple[str, ...]

    @classmethod
    def read(cls, root: str, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        root = (env.get("APP_ROOT") or "").strip() or root
        hosts = (h.strip().lower().removeprefix("www.") for h in env.get("PLAYWRIGHT_DISABLED_HOSTS", "").split(","))
        return cls(
            root=root,
            output=(env.get("OUTPUT_DIR") or "").strip() or str(PurePosixPath(root) / "output"),
            candidate_domains=env_int(env, "MAX_CANDIDATE_DOMAINS", 8),
            discovery_budget_ms=env_int(env, "STAGE_DISCOVERY_BUDGET_MS", 90_000),
            fallback_budget_ms=env_int(env, "STAGE_FALLBACK_BUDGET_MS", 35_000),
            rendered=env.get("PLAYWRIGHT_ENABLED") != "false",
            rendered_off_hosts=tuple(h for h in hosts if h),
        )
