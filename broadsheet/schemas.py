"""Schemas of the site configs, the page extraction and the stored tables."""

from __future__ import annotations

SITE = """
name string, domain string, enabled boolean, render boolean, start_urls array<string>, hosts array<string>,
list_page struct<item_selector: string, item_is_article: boolean, link_selector: string,
                 link_attr: string, wait_for_selector: string>,
pagination struct<enabled: boolean, next_selector: string, next_attr: string, max_pages: int>,
article struct<title_selector: string, body_selector: string, published_at_selector: string,
               published_at_attr: string, category_selector: string, author_selector: string,
               featured_image_selector: string, featured_image_attr: string,
               remove_selectors: array<string>, metadata_selectors: map<string, string>>,
request struct<delay_seconds: double, jitter_seconds: double, headers: map<string, string>>
"""

FIELDS = """title: string, body: string, published_at: string, category: string, author: string,
featured_image: string, metadata: map<string, array<string>>"""

# What the extraction UDF returns for a page read as a detail page, and as a listing page.
DETAIL = f"struct<{FIELDS}, error: string>"
LISTING = f"""struct<next_href: string,
items: array<struct<idx: int, href: string, article: struct<{FIELDS}>>>, error: string>"""
# A page read as both at once; each reading has an error of its own.
BOTH = f"""struct<next_href: string,
items: array<struct<idx: int, href: string, article: struct<{FIELDS}>>>, listing_error: string, fields: struct<{FIELDS}>, error: string>"""

# What the extraction UDF returns of a page as elements.
ELEMENTS = """struct<elements: array<struct<node: int, last: int, parent: int, tag: string, attrs: map<string, string>,
classes: array<string>, text_kind: string, text_from: int, text_to: int,
strings: array<struct<seq: int, kind: string, text: string>>>>, error: string>"""

SEQ = "struct<site_order: bigint, page_number: bigint, item_idx: bigint>"

ARTICLES = """domain string, article_id string, title string, slug string, body string,
published_at string, category_id bigint, author_id bigint, featured_image_id bigint,
metadata map<string, array<string>>, url string, content_hash string, scraped_at timestamp,
updated_at timestamp"""
CATEGORIES = "id bigint, domain string, name string"
AUTHORS = CATEGORIES
IMAGES = "id bigint, domain string, url string"
STATE = "domain string, last_url string, last_page int, updated_at timestamp"

# A parsed page without its items and fields, and an item that waits for its page.
HEADS = """domain string, site string, url string, html_key string, config_key string, next_url string,
listing_error string, fetch string"""
WAITING = f"site string, domain string, article_id string, seq {SEQ}, mode string, item_url string"
