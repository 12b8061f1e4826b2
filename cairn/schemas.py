"""Row types of the data model, as DDL."""

from __future__ import annotations

CITATION = "struct<source_kind: string, resource_id: string, line_start: int, line_end: int, url: string, page_class: string, snippet: string>"
FETCH_REQUEST = "struct<url: string, reason: string, expected_evidence: array<string>, source_hint: string, in_corpus_index: boolean>"


def answer(kind: str = "string") -> str:
    return f"struct<value: {kind}, confidence: string, status: string, evidence: array<{CITATION}>, notes: string>"


def list_answer(item: str) -> str:
    return f"struct<items: array<{item}>, confidence: string, status: string, notes: string>"


CRAWL_ENTRY = "url string, discovered_from array<string>, depth int, in_scope boolean, status string, final_url string, kind string, page_class string, skip_reason string, resource_id string"
RESOURCE = "resource_id string, url string, final_url string, kind string, status string, content_type string, response_status_code int, text_path string, sha256 string, text_chars bigint"
LINK = "source_url string, target_url string, target_in_scope boolean"


def _struct(ddl: str) -> str:
    return "struct<" + ", ".join(f"{c.split(' ', 1)[0]}: {c.split(' ', 1)[1]}" for c in ddl.split(", ")) + ">"


CORPUS = f"target_id string, display_name string, homepage_url string, run_id string, created_at string, crawl_index array<{_struct(CRAWL_ENTRY)}>, resources array<{_struct(RESOURCE)}>, links array<{_struct(LINK)}>"
PRODUCT = f"struct<name: string, category: string, descriptor: string, granularity: string, readiness: string, ndaa: string, blue_uas: string, evidence: array<{CITATION}>, notes: string>"
META = "struct<model: string, num_turns: int, total_cost_usd: double, created_at: string, extract_version: string>"
PROFILE = (
    "target_id string, run_id string, display_name string, homepage_url string, corpus_root string, "
    f"headquarters {answer('struct<city: string, state_or_province: string, country: string, address: string>')}, "
    f"drone_supply_chain_role {answer()}, ndaa {answer()}, blue_uas {answer()}, readiness {answer()}, "
    f"products_categories {list_answer(f'struct<category: string, is_primary: boolean, confidence: string, evidence: array<{CITATION}>, notes: string>')}, "
    f"products {list_answer(f'struct<name: string, product_type: string, confidence: string, evidence: array<{CITATION}>, notes: string>')}, "
    f"unresolved_questions array<string>, fetch_requests array<{FETCH_REQUEST}>, status string, tagline string, meta {META}"
)
CATALOG = f"target_id string, run_id string, display_name string, homepage_url string, products array<{PRODUCT}>, unresolved_questions array<string>, fetch_requests array<{FETCH_REQUEST}>, status string, meta {META}"
TARGET = "name string, homepage_url string, aliases array<string>, seed_urls array<string>, categories array<string>, follow_ups array<struct<url: string, reason: string>>"
JOURNAL = "ts string, event string, target_id string, cost double, turns int, cumulative_cost double, partial boolean, error string"
REGISTRY = (
    "target_id string, display_name string, homepage_url string, normalized_homepage_url string, profile string, policy_hash string, quality_status string, run_id string, "
    "corpus_manifest_path string, quality_report_path string, resource_count int, created_at timestamp, updated_at timestamp"
)
NEWS_STATE = "slug string, seen_urls array<string>, polls_completed int, last_polled_at timestamp"
