"""Boolean expressions over text: blocked pages, boilerplate, noise, versions, tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse

# Marks of pages that a bot check has replaced, and where to look for them.
BLOCKED_ANYWHERE = ("Just a moment",)
BLOCKED_EARLY = (("Cloudflare", 500), ("Performing security verification", 2000), ("Target URL returned error 403", 3000))

# Wording by which a proxy's answer is the site's shell instead of an article.
SHELL_WORDING = (
    "title: deutsche bank research institute", "bringing the world to europe and europe to the world", "über diesen link verlassen sie die informationsseiten der deutsche bank gruppe",
    "don't show this message anymore", "ihre sitzung wird in 180 sekunden beendet", "mit neuer sitzung fortfahren", "1. [null](https://www.dbresearch.com/prod/ie-prod/navigation.alias)",
)

# Wording of site navigation.
NAVIGATION = (
    "about blackrock", "principles", "leadership", "history", "contacts and locations", "global insights", "investment stewardship", "our approach to sustainability", "public policy",
    "investor relations", "annual reports", "sec filings", "stock information", "dividend history", "corporate governance", "corporate sustainability", "human capital",
    "environmental sustainability", "ethics and integrity", "health and safety", "social impact", "search jobs", "life at blackrock", "benefits", "career development", "students & graduates",
    "supporting our veterans", "local websites", "search results", "no search results found", "please double-check your spelling", "welcome to blackrock corporate site", "before we proceed",
    "please read this page before proceeding", "by entering this site", "no offer", "no warranty", "no liability", "intellectual property rights", "you are now leaving",
)

# Wording that ends an article, that paragraphs to be skipped begin with or hold, and their publisher's name.
ARTICLE_ENDS = (
    "important research disclosures", "the above information has been obtained", "all opinions and claims are based upon data",
    "this material has been prepared by the deutsche bank research institute", "copyright ©",
)
SKIPPED_STARTS = (
    "title:", "url source:", "markdown content:", "don't show this message anymore", "ihre sitzung", "mit neuer sitzung fortfahren", "bringing the world to europe",
    "über diesen link verlassen sie", "die seite xxxx wird geöffnet", "1. [null]", "source:", "figure ",
)
COLOUR_WORDING = ("deep blue", "dark blue", "bright blue", "vibrant cyan", "autumn green", "lucent yellow", "first level, 14 pt", "standard text formats")
SKIPPED_WORDING = (*COLOUR_WORDING, "second level, 14 pt", "sixth level, footnote", "seventh level, footnote", "http://", "https://")
PUBLISHER = "deutsche bank research institute"

# Fixed values: (shape, length): paragraphs of that shape and below that length (None: of any length) are no text.
SKIPPED_SHAPES = (
    (r"^(## \[|# )", None),
    (r"(?i)research analyst$", 80),
    (r"(?i)^analysts", 120),
    (r"^[0-9]{1,2}\s+[A-Z][a-z]{2,8}\s+[0-9]{4}\s", 80),
    (r"^[A-Z][a-z]{2,8}\s+[0-9]{1,2},\s+[0-9]{4}", 60),
    (r"(?i)^(deutsche bank [^.]{0,60} )?page\s+[0-9]+$", None),
    (r"(?i)^sources?$", None),
    (r"(?i)^[0-9]+\s+review of ", None),
)

# Wording of player, sharing and disclaimer lines.
NOISE = (
    "capital at risk", "for public distribution", "video player is loading", "current time 0:00", "loaded: 0%", "share", "facebook", "twitter", "linkedin", "transcript",
    "download full commentary", "change location", "header:",
)

# Lines of a PDF that stand by themselves, and how others begin.
JUNK_LINES = ("deutsche bank research institute", "deutsche bank ag", "sensitivity: public", "source: deutsche bank research")
JUNK_STARTS = ("page ", "important research disclosures", "appendix ")

ITEM_MARK = "item-render-version"


def count_hits(text: Column, patterns: Sequence[str]) -> Column:
    """How many of the patterns a text holds."""
    return sum((F.contains(text, F.lit(p)).cast("int") for p in patterns), F.lit(0))


def looks_blocked(page: Column, anywhere: Sequence[str] = BLOCKED_ANYWHERE, early: Sequence[tuple[str, int]] = BLOCKED_EARLY) -> Column:
    """A bot check instead of a page: marks anywhere, or within the first characters."""
    page = F.coalesce(page, F.lit(""))
    found = page == ""
    for mark in anywhere:
        found = found | F.contains(page, F.lit(mark))
    for mark, n in early:
        found = found | F.contains(F.substring(page, 1, n), F.lit(mark))
    return found


def too_many_headings(markdown: Column, mark: str = "## [", most: int = 3) -> Column:
    """A listing instead of an article: so many linked headings or more."""
    return (F.length(markdown) - F.length(F.replace(markdown, F.lit(mark), F.lit("")))) >= most * len(mark)


def is_shell(markdown: Column, wording: Sequence[str] = SHELL_WORDING, mark: str = "## [", most: int = 3) -> Column:
    """The site's shell or a listing instead of an article."""
    page = F.coalesce(markdown, F.lit(""))
    return (count_hits(F.lower(page), wording) > 0) | too_many_headings(page, mark, most)


def is_navigation(text: Column, patterns: Sequence[str] = NAVIGATION) -> Column:
    """Three hits in over 200 characters, or two in over 100."""
    low = F.lower(text)
    hits = count_hits(low, patterns)
    return ((hits >= 3) & (F.length(low) > 200)) | ((hits >= 2) & (F.length(low) > 100))


def is_noise_line(line: Column, patterns: Sequence[str] = NOISE, least: int = 40) -> Column:
    """Shorter than ``least``, or with one of the patterns."""
    return (F.length(line) < least) | (count_hits(F.lower(line), patterns) > 0)


def is_junk_line(line: Column) -> Column:
    """Lines of a PDF that are no text: digits, page numbers, notices, addresses, dates, names and triplets of colours, next to nothing."""
    low = F.lower(F.trim(line))
    return (
        (F.length(low) <= 2)
        | low.rlike(r"^[0-9]{1,4}$")
        | low.isin(*JUNK_LINES)
        | F.exists(F.array(*[F.lit(x) for x in JUNK_STARTS]), lambda x: F.startswith(low, x))
        | (F.startswith(low, F.lit("authors")) & (F.length(low) < 80))
        | F.exists(F.array(*[F.lit(x) for x in COLOUR_WORDING]), lambda x: F.contains(low, x))
        | low.rlike(r"^[0-9]+\|[0-9]+\|[0-9]+$")
        | low.rlike(r"^[^ @]+@[^ @]+\.[a-z]+$")
        | low.rlike(r"^https?://[^ ]+$")
        | low.rlike(r"^[0-9]{1,2} [a-z]+ [0-9]{4}$")
    )


def is_junk_paragraph(p: Column, title: Column, description: Column | None = None, publisher: str = PUBLISHER) -> Column:
    """Paragraphs that are no article text: skipped wording and shapes, the title or description again, tables of colours, name lists, short ones."""
    low, t = F.lower(p), F.coalesce(title, F.lit(""))
    wording = F.exists(F.array(*[F.lit(w) for w in SKIPPED_WORDING]), lambda w: F.contains(low, w)) | F.exists(F.array(*[F.lit(w) for w in SKIPPED_STARTS]), lambda w: F.startswith(low, w))
    shapes = F.lit(False)
    for shape, below in SKIPPED_SHAPES:
        shapes = shapes | (p.rlike(shape) & (F.length(p) < below if below else F.lit(True)))
    again = (t != "") & ((p == t) | (F.contains(low, F.lower(t)) & (F.length(p) < F.greatest(F.lit(120), F.length(t) + 40))))
    if description is not None:
        again = again | ((p == description) & (description != ""))
    own = (low == publisher) | (F.startswith(low, F.lit(publisher + " ")) & F.contains(p, F.lit(" – ")))
    colours = F.contains(p, F.lit(" | ")) & (F.regexp_count(p, F.lit(r"[0-9]+\|[0-9]+\|[0-9]+")) >= 3)
    names = (F.regexp_count(p, F.lit(r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\b")) >= 5) & (F.length(p) < 600)
    return (F.length(p) < 20) | wording | shapes | again | own | colours | names


def is_marked(text: Column, markers: Sequence[str], least: int = 2) -> Column:
    """At least so many of the markers occur."""
    return count_hits(F.lower(text), markers) >= least


def render_version(page: Column, mark: str = ITEM_MARK) -> Column:
    """Version in the page's meta tag; 0 where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(page, rf'name="{mark}" content="([0-9]+)"', 1), F.lit("")).try_cast("int"), F.lit(0))


def needs_rebuild(page: Column) -> Column:
    """Broken encoding or site-relative assets in a stored page."""
    return page.rlike(r"Ã.|â€") | page.rlike(r'(?i)\s(?:src|srcset)="/')


def unchanged(title: Column, description: Column, old_title: Column, old_description: Column) -> Column:
    """Title and description are as before after collapsing white space; false where there is no before."""
    return F.coalesce((collapse(title) == collapse(old_title)) & (collapse(description) == collapse(old_description)), F.lit(False))


def is_real_table(rows: Column) -> Column:
    """At least two rows and columns, no cell over 80 characters, none of eight numeric tokens."""
    full = F.filter(rows, lambda r: F.exists(r, lambda c: F.coalesce(c, F.lit("")) != ""))
    fine = lambda c: (F.length(F.coalesce(c, F.lit(""))) <= 80) & (F.size(F.filter(F.split(F.coalesce(c, F.lit("")), " +"), lambda t: t.rlike("[0-9]"))) < 8)
    return (F.size(full) >= 2) & (F.coalesce(F.array_max(F.transform(full, lambda r: F.size(r))), F.lit(0)) >= 2) & F.forall(full, lambda r: F.forall(r, fine))


def is_valid_binary(content: Column, magic: bytes, least: int) -> Column:
    """Long enough and with the right first bytes."""
    return (F.length(content) > least) & (F.substring(content, 1, len(magic)) == F.lit(magic))


def is_empty_shell(text: Column, title: Column, least: int = 50) -> Column:
    """A page of which little is left besides its title."""
    return F.length(F.trim(F.replace(text, title, F.lit("")))) < least


def excluded_slug(slug: Column, exclude: Sequence[str]) -> Column:
    """Slugs of a site's own sections."""
    return slug.isin(list(exclude))
