"""Column functions over strings: white space, tags, slugs, truncation, hashes, markdown.

All are built-in expressions unless their docstring says that they need an Arrow UDF.
White space is the explicit class ``WS`` (Java, Python and RE2 differ on ``\\s``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import html_unescape

WS = r"[ \t\r\n\f]+"
NBSP = " "


def lit_or_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def none_if_empty(c: Column) -> Column:
    """``x or y`` treats an empty string as missing; so does coalesce over this."""
    return F.nullif(c, F.lit(""))


def first_of(*cs: Column) -> Column:
    """First of the columns that is neither null nor empty."""
    return F.coalesce(*[none_if_empty(c) for c in cs])


def trim_ws(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"^{WS}", ""), rf"{WS}$", "")


def collapse(c: Column) -> Column:
    """White space runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(c, WS, " "))


# --- tags


def drop_tags(c: Column, by: str = " ") -> Column:
    return F.regexp_replace(c, r"<[^>]+>", by)


def drop_invisible(c: Column, by: str = " ") -> Column:
    """Scripts and styles with what they hold."""
    return F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", by)


def drop_comments(c: Column, by: str = " ") -> Column:
    return F.regexp_replace(c, r"(?s)<!--.*?-->", by)


def html_to_text(c: Column) -> Column:
    """Tags first, references after: ``&lt;b&gt;`` stays visible. Arrow UDF for the references."""
    return collapse(html_unescape(drop_tags(or_empty(c))))


def strip_html(c: Column) -> Column:
    """References first, tags after: ``&lt;b&gt;`` goes as a tag. Arrow UDF for the references."""
    return collapse(drop_tags(html_unescape(or_empty(c))))


def normalize_space(c: Column) -> Column:
    """References decoded, no-break spaces to spaces, white space collapsed. Arrow UDF."""
    return collapse(F.replace(html_unescape(or_empty(c)), F.lit(NBSP), F.lit(" ")))


def strip_tags(c: Column) -> Column:
    """Comments, then tags, then normalize_space."""
    return normalize_space(drop_tags(drop_comments(or_empty(c))))


def clean_text(c: Column) -> Column:
    """Text with the lines of ``<br>`` and ``</p>``; other tags leave nothing. Arrow UDF."""
    broken = F.regexp_replace(F.regexp_replace(or_empty(c), r"(?i)<br\s*/?>", "\n"), r"(?i)</p>", "\n\n")
    return trim_ws(F.regexp_replace(html_unescape(drop_tags(broken, "")), r"\n{3,}", "\n\n"))


def unescaped_line(c: Column) -> Column:
    """References decoded and white space collapsed. Arrow UDF."""
    return collapse(html_unescape(or_empty(c)))


def plain_block(c: Column) -> Column:
    """Carriage returns dropped, no-break spaces to spaces, at most one empty line in a row."""
    return trim_ws(F.regexp_replace(F.replace(F.replace(c, F.lit("\r"), F.lit("")), F.lit(NBSP), F.lit(" ")), r"\n{3,}", "\n\n"))


def fragment(c: Column) -> Column:
    """A fragment of markup without carriage returns, trimmed; null becomes empty."""
    return trim_ws(F.replace(or_empty(c), F.lit("\r"), F.lit("")))


def plain_page_text(html: Column) -> Column:
    """Visible text of a page without decoding references (stays in the JVM)."""
    return collapse(drop_tags(drop_invisible(html)))


def escape_html(c: Column) -> Column:
    """``& < > "`` and the apostrophe as references."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for char, ref in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(ref))
    return out


def keep_paragraphs(c: Column) -> Column:
    """Only the ``<p>`` elements, joined by line ends."""
    return F.array_join(F.regexp_extract_all(c, F.lit(r"(?is)(<p[^>]*>.*?</p>)"), F.lit(1)), "\n")


def drop_syndication_footer(c: Column) -> Column:
    """The paragraph ``... appeared first on ...`` that syndication adds."""
    return F.regexp_replace(c, r"(?is)<p>[^<]*(<a[^>]*>[^<]*</a>)?[^<]*appeared first on.*?</p>", "")


def drop_elements(c: Column, tag: str) -> Column:
    """Elements of a name with their content, from the text of a document."""
    t = re.escape(tag)
    return F.regexp_replace(c, rf"(?is)[ \t]*<{t}[^>]*>.*?</{t}>[ \t]*\n?", "")


def strip_namespaces(c: Column) -> Column:
    """XML text without namespace declarations and prefixes of names."""
    bare = F.regexp_replace(c, r"""\s+xmlns(?::[A-Za-z0-9_.-]+)?=("[^"]*"|'[^']*')""", "")
    return F.regexp_replace(bare, r"(</?)[A-Za-z0-9_.-]+:([A-Za-z0-9_.-]+)", "$1$2")


# --- slugs, hashes, titles


def slugify(c: Column, empty: str = "item") -> Column:
    """Lower-case ASCII letters and digits with single hyphens."""
    return F.coalesce(none_if_empty(F.lower(F.regexp_replace(F.regexp_replace(c, r"[^a-zA-Z0-9]+", "-"), r"^-+|-+$", ""))), F.lit(empty))


def slugify_decoded(c: Column, drop_pdf: bool = False, empty: str = "item") -> Column:
    """slugify after decoding references and percent escapes (a plus sign stays). Arrow UDF."""
    plain = html_unescape(c)
    decoded = F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain)
    return slugify(F.regexp_replace(decoded, r"(?i)\.pdf$", "") if drop_pdf else decoded, empty)


def short_hash(*parts: Column, n: int = 12) -> Column:
    """First hex digits of the md5 of the parts, joined by a bar; null counts as empty."""
    return F.substring(F.md5(F.concat_ws("|", *[or_empty(p) for p in parts])), 1, n)


def guid(title: Column, link: Column) -> Column:
    """Identity of an item."""
    return F.md5(F.concat(or_empty(title), or_empty(link)))


def slug_of(link: Column, title: Column) -> Column:
    """Slug of the last path segment unless that has a dot; else of the title; else a hash."""
    base = F.regexp_replace(F.regexp_replace(or_empty(link), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    last = F.element_at(F.split(F.regexp_replace(base, r"/+$", ""), "/"), -1)
    by_link = F.when((last != "") & ~F.contains(last, F.lit(".")), slugify(last, ""))
    return F.coalesce(none_if_empty(by_link), none_if_empty(slugify(or_empty(title), "")), short_hash(or_empty(link), or_empty(title)))


def slug_with_date(slug: Column, ts: Column) -> Column:
    return F.concat_ws("-", slug, F.date_format(ts, "yyyy-MM-dd"))


def slug_with_hash(slug: Column, *parts: Column, n: int = 10) -> Column:
    return F.concat(slug, F.lit("-"), short_hash(*parts, n=n))


#: Words that a title from a slug writes in capitals.
ACRONYMS = {"Us": "US", "Ai": "AI", "Uk": "UK", "Eu": "EU", "Gdp": "GDP", "Etf": "ETF", "Fx": "FX", "Q1": "Q1"}


def title_from_slug(slug: Column, acronyms: Mapping[str, str] = ACRONYMS) -> Column:
    """Words of a slug with capitals, acronyms repaired."""
    out = F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))
    for word, right in acronyms.items():
        out = F.regexp_replace(out, rf"\b{word}\b", right)
    return out


# --- truncation


def truncate_words(c: Column, n: int = 420, tail: str = "…", strip: str = ".,;:!?") -> Column:
    """At most n characters, cut at a word, punctuation stripped, with a tail."""
    head = F.regexp_replace(F.substring(c, 1, n), r" [^ ]*$", "")
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.rtrim(head, F.lit(strip + " ")), F.lit(tail)))


def truncate_hard(c: Column, n: int = 500, tail: str = "...") -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(tail))).otherwise(c)


# --- markdown


def strip_markdown_links(c: Column) -> Column:
    """Images and links give their label, emphasis marks go, white space collapses. Arrow UDF."""
    label = F.regexp_replace(F.regexp_replace(or_empty(c), r"!\[([^\]]*)\]\([^)]*\)", "$1"), r"\[([^\]]*)\]\([^)]*\)", "$1")
    return collapse(html_unescape(F.regexp_replace(label, r"[*_`#>]+", " ")))


def inline_markdown(c: Column) -> Column:
    """Inline markdown as HTML: images, links, strong, emphasis, code."""
    out = escape_html(c)
    for pattern, html in (
        (r"!\[([^\]]*)\]\(([^)\s]+)\)", '<img src="$2" alt="$1">'),
        (r"\[([^\]]+)\]\(([^)\s]+)\)", '<a href="$2">$1</a>'),
        (r"\*\*([^*]+)\*\*", "<strong>$1</strong>"),
        (r"(^|[^*])\*([^*\n]+)\*", "$1<em>$2</em>"),
        (r"`([^`]+)`", "<code>$1</code>"),
    ):
        out = F.regexp_replace(out, pattern, html)
    return out


def block_markdown(c: Column) -> Column:
    """Block markdown as HTML: headings, lists and paragraphs, blocks apart by empty lines or by their marks."""
    text = F.regexp_replace(F.replace(or_empty(c), F.lit("\r"), F.lit("")), r"(?m)^(#{1,6} .*|[*-] .*)$", "\n$1\n")
    text = F.regexp_replace(text, r"(?m)\n\n+([*-] )", "\n\n$1")
    blocks = F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda b: trim_ws(b)), lambda b: b != "")

    def block(b: Column) -> Column:
        level = F.least(F.length(F.regexp_extract(b, r"^(#+)", 1)) + 1, F.lit(6)).cast("string")
        head = F.concat(F.lit("<h"), level, F.lit(">"), inline_markdown(F.regexp_replace(b, r"^#+ +", "")), F.lit("</h"), level, F.lit(">"))
        item = F.concat(F.lit("<li>"), inline_markdown(F.regexp_replace(b, r"^[*-] +", "")), F.lit("</li>"))
        return F.when(b.rlike(r"^#{1,6} "), head).when(b.rlike(r"^[*-] "), item).otherwise(F.concat(F.lit("<p>"), inline_markdown(F.regexp_replace(b, r"\n", " ")), F.lit("</p>")))

    html = F.array_join(F.transform(blocks, block), "\n")
    return F.regexp_replace(html, r"(?s)(<li>.*?</li>)(?!\n<li>)", "$1</ul>").transform(lambda x: F.regexp_replace(x, r"(?s)(^|(?<!</li>)\n)<li>", "$1<ul><li>"))


# Lines that article markdown loses ({site}: its name), and how its tail begins.
ARTICLE_LINES = (r"(?m)^# .* - {site}\s*$", r"(?m)^[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}$", r"(?m)^Share on\s*$", r"(?im)^\*\s*\[\]\([^)]*(?:linkedin|x\.com|twitter)[^)]*\)\s*$")
ARTICLE_TAILS = (r"(?is)\n## Explore\s.*$", r"(?is)\n### Manage Consent Preferences.*$", r"(?is)\nThis website uses cookies.*$")


def clean_article_markdown(c: Column, title: Column, site: str = "Citadel Securities") -> Column:
    """Article markdown without proxy header lines, title and date lines, share links, images, and tails of links and consent notes."""
    out = F.regexp_replace(or_empty(c), r"(?m)^(Title|URL Source|Published Time|Markdown Content):.*$", "")
    for pattern in ARTICLE_LINES:
        out = F.regexp_replace(out, pattern.replace("{site}", re.escape(site)), "")
    for pattern in ARTICLE_TAILS:
        out = F.regexp_replace(out, pattern, "")
    out = F.regexp_replace(out, r"(?m)^!\[[^\]]*\]\([^)]*\)\s*$", "")
    heading = F.concat(F.lit(r"(?m)^#+ *\Q"), title, F.lit(r"\E *$"))
    out = F.regexp_replace(out, heading, F.lit("")) if isinstance(title, Column) else out
    return trim_ws(F.regexp_replace(out, r"\n{3,}", "\n\n"))


# --- PDF and encoding repairs


def join_hyphens(c: Column) -> Column:
    """Soft hyphens go, words broken over lines are joined."""
    return F.regexp_replace(F.replace(c, F.lit("­"), F.lit("")), r"-\n(?=[a-z])", "")


def repair_mojibake(c: Column) -> Column:
    """UTF-8 read as Latin-1 is read again where that leaves fewer suspicious characters."""
    odd = r"[ÃÂâ€]"
    again = F.when(c.rlike(r"^[\x00-\xFF]*$"), F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string")))
    better = F.regexp_count(again, F.lit(odd)) + F.regexp_count(again, F.lit("�")) < F.regexp_count(c, F.lit(odd))
    return F.when(F.coalesce(better, F.lit(False)), again).otherwise(c)


# --- templates


def template_regex(template: str) -> str:
    """Java regex of a template: ``{%}`` captures, ``{*}`` skips (both lazily); other text is literal.

    A pattern without either mark is a regex of its own.
    """
    flags = "(?ism)"
    if "{%}" not in template and "{*}" not in template:
        return flags + template
    parts = re.split(r"(\{%\}|\{\*\})", template)
    return flags + "".join({"{%}": "(.+?)", "{*}": "(?:.+?)"}.get(p) or (re.escape(p) if p else "") for p in parts)


def fill_template(template: str, groups: Column, fallback: Column) -> Column:
    """``{0}``, ``{1}`` ... by the groups; a template that needs a missing group gives the fallback."""
    parts = re.split(r"\{(\d*)\}", template)
    filled, auto = [], 0
    for k, p in enumerate(parts):
        if k % 2 == 0:
            filled.append(F.lit(p))
        else:
            filled.append(F.get(groups, F.lit(int(p) if p else auto)))
            auto += 1
    return F.coalesce(F.concat(*filled), fallback, F.lit(""))


# --- insertion and assets


def insert_after_h1(page: Column, snippet: Column) -> Column:
    """The snippet after the first ``</h1>``; the page as it is where there is none."""
    at = F.instr(F.lower(page), "</h1>")
    return F.when(at > 0, F.concat(F.substring(page, F.lit(1), at + 4), snippet, F.substring(page, at + 5, F.length(page)))).otherwise(page)


def insert_before_head_end(page: Column, snippet: Column) -> Column:
    at = F.instr(F.lower(page), "</head>")
    return F.when(at > 0, F.concat(F.substring(page, F.lit(1), at - 1), snippet, F.substring(page, at, F.length(page)))).otherwise(page)


def once(page: Column, mark: str, changed: Column) -> Column:
    """``changed`` unless the page holds the mark already (idempotent rewriting)."""
    return F.when(F.contains(page, F.lit(mark)), page).otherwise(changed)


def wrap_lone_images(page: Column) -> Column:
    """A paragraph of one image becomes a figure; a missing alt text is filled."""
    out = F.regexp_replace(page, r"(?is)<p>\s*(<img[^>]*>)\s*</p>", "<figure>$1</figure>")
    return F.regexp_replace(out, r"(?is)<img((?:(?!\balt=)[^>])*?)\s*/?>", '<img$1 alt="">')


def srcset_first(srcset: Column) -> Column:
    """URL of the first candidate of a srcset."""
    return F.split_part(F.trim(F.split_part(srcset, F.lit(","), F.lit(1))), F.lit(" "), F.lit(1))


#: Image types by extension and by media type.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "gif", "webp", "svg", "avif")
IMAGE_TYPES = {"image/jpeg": "jpg", "image/png": "png", "image/gif": "gif", "image/webp": "webp", "image/svg+xml": "svg", "image/avif": "avif"}


def image_extension(url: Column, content_type: Column, default: str = "jpg", extensions: Sequence[str] = IMAGE_EXTENSIONS) -> Column:
    """Extension by the URL's path, else by media type, else the default."""
    ext = F.lower(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"\.([A-Za-z0-9]+)$", 1))
    by_path = F.when(ext.isin(list(extensions)), F.when(ext == "jpeg", F.lit("jpg")).otherwise(ext))
    media = F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))
    by_type = F.coalesce(*[F.when(media == k, F.lit(v)) for k, v in IMAGE_TYPES.items()])
    return F.coalesce(by_path, by_type, F.lit(default))


def apply_map(text: Column, mapping: Column) -> Column:
    """Replace every key of ``mapping`` (array of struct<k,v>) in the text, in order."""
    return F.aggregate(mapping, text, lambda acc, m: F.replace(acc, m["k"], m["v"]))


def clean_svg(c: Column) -> Column:
    """SVG markup without scripts, event handlers, processing instructions and fixed sizes."""
    out = c
    for pattern in (r"(?is)<script.*?</script>", r"(?is)<\?xml.*?\?>", r"(?is)<!DOCTYPE[^>]*>", r"(?i)\son\w+=\"[^\"]*\""):
        out = F.regexp_replace(out, pattern, "")
    return F.regexp_replace(out, r"(?is)(<svg[^>]*?)\s(?:width|height)=\"[^\"]*\"", "$1")
