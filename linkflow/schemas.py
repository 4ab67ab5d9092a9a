"""Schemas of the engine's tables. The empty string is the usual "absent"; optional columns are nullable."""

from __future__ import annotations

SOURCE = (
    "id string, name string, home_url string, rss_url string, collect_mode string, tags array<string>, enabled boolean, "
    "browser_fallback boolean, ssl_verify boolean, notes string, allowed_hosts array<string>, strip_query_keys array<string>, "
    "access_status string, access_issue string, access_tested_at string, access_tested_via string"
)
FEED_ENTRY = "pos int, url string, title string, summary string, content_html string, published_at string, author string"
CANDIDATE = "source_id string, pos int, url string, title string, context string"
PAGE_LINK = "pos int, href string, title string, parent_text string"
BLOCK = "pos int, kind string, text string, chars int, link_chars int"
SOURCE_STATE = "source_id string, baseline_initialized boolean, candidates_initialized boolean, resolved_feed_url string, feed_fail_streak int, method string, last_ok_at string"
SEEN = "source_id string, url string, title string, first_seen string, published_at string, content_status string, content_sha256 string, content_fetched_at string"
CANDIDATE_STATE = "source_id string, url string, title string, first_seen string, last_seen string, baseline boolean, selected boolean, last_selected string, selector string"
VALIDATORS = "url string, etag string, last_modified string"
FETCHED = "url string, transport string, final_url string, status int, body string, error string, etag string, last_modified string"
ATTEMPT = "source_id string, level int, method string, transport string, feed_url string, error string"
ITEM = "source_id string, base string, url string, title string, summary string, content_html string, published_at string, author string, via string, pos long"
