"""Settings, resolved once on the driver; plans get them as literals."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Defaults are the production values; ``from_env`` reads ``LINKFLOW_<NAME>``."""

    feed_max_items: int = 100
    page_candidates: int = 80
    heuristic_picks: int = 40
    seen_cap: int = 500
    candidate_cap: int = 1000
    feed_fail_streak: int = 3
    content_max_chars: int = 60_000
    content_min_chars: int = 200
    content_rss_min_chars: int = 800
    block_limit: int = 12
    block_min_chars: int = 120
    block_max_link_ratio: float = 0.65
    summary_chars: int = 500
    content_html_chars: int = 2_000_000
    probe_new_urls: bool = True
    allow_heuristic: bool = False
    strict: bool = False
    http_timeout_s: float = 45.0
    probe_timeout_s: float = 8.0
    ssl_insecure_hosts: str = ""
    http_max_mb: int = 32
    browser_enabled: bool = True
    browser_auto: bool = True
    browser_timeout_s: float = 60.0
    browser_wait_until: str = "domcontentloaded"
    browser_wait_ms: int = 2000
    browser_challenge_ms: int = 8_000
    browser_scroll_ms: int = 500
    browser_proxy: str = ""
    llm_base_url: str = ""
    llm_key: str = ""
    llm_model: str = ""
    llm_timeout_s: float = 60.0
    llm_excerpt_chars: int = 2000
    commit: str = ""

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        got = {}
        for f in fields(cls):
            raw = (env.get(f"LINKFLOW_{f.name.upper()}") or "").strip()
            if not raw:
                continue
            kind = type(f.default)
            try:
                got[f.name] = raw.lower() in ("1", "true", "yes", "on") if kind is bool else kind(raw)
            except ValueError:
                continue
        return cls(**got)
