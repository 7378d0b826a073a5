"""The fixed schemas of items, channels, pages and layout boxes, as DDL."""

from __future__ import annotations

ITEM = (
    "feed STRING, pos INT, title STRING, link STRING, guid STRING, is_permalink BOOLEAN, pub_ts TIMESTAMP, pub_date_raw STRING, author STRING, "
    "description STRING, content_html STRING, slug STRING, source_url STRING, render_version INT, run_ts TIMESTAMP"
)
CHANNEL = "feed STRING, title STRING, link STRING, description STRING, language STRING, last_build TIMESTAMP, generator STRING"
PAGE = "url STRING, html STRING"
BOX = "page INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, text STRING, size DOUBLE, bold BOOLEAN"
SPAN = "array<struct<groups:array<string>,start:int,end:int,full:string>>"
