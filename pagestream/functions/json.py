"""Columns over semi-structured JSON: optional paths, polymorphic fields, embedded objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_of, none_if_empty


def path(doc: Column, p: str) -> Column:
    """Text at a JSON path of a JSON text; null where there is none."""
    return F.get_json_object(doc, p)


def any_path(doc: Column, *paths: str) -> Column:
    """First path that gives a text."""
    return first_of(*[path(doc, p) for p in paths])


def variant_path(doc: Column, p: str, kind: str = "string") -> Column:
    """Typed value at a path of a VARIANT; null where it is missing or of another type."""
    return F.try_variant_get(doc, p, kind)


def one_or_many(doc: Column, p: str) -> Column:
    """Array of JSON texts of a field that is an array, a single value or missing."""
    raw = F.get_json_object(doc, p)
    many = F.from_json(raw, "array<string>")
    return F.when(raw.isNull(), F.array().cast("array<string>")).when(F.startswith(raw, F.lit("[")), many).otherwise(F.array(raw))


def name_of(value: Column, key: str = "name") -> Column:
    """Name of a field that is an object with a name, or the name itself."""
    return F.when(F.startswith(F.ltrim(value), F.lit("{")), F.get_json_object(value, f"$.{key}")).otherwise(value)


def names(doc: Column, p: str, key: str = "name") -> Column:
    """Names of one or many people, joined by commas."""
    return F.array_join(F.filter(F.transform(one_or_many(doc, p), lambda v: name_of(v, key)), lambda x: F.coalesce(x, F.lit("")) != ""), ", ")


def embedded_script(html: Column, script_id: str) -> Column:
    """JSON text of the script element of an id."""
    return none_if_empty(F.regexp_extract(html, rf'(?s)<script[^>]*id="{script_id}"[^>]*>(.*?)</script>', 1))


def property_in_text(text: Column, key: str) -> Column:
    """String property found by its name in any text."""
    return none_if_empty(F.regexp_extract(text, rf'"{key}"\s*:\s*"((?:[^"\\]|\\.)*)"', 1))


def components(items: Column) -> Column:
    """Array of struct<pos, key, kind, body> of a JSON object of typed components, in document order."""
    entries = F.map_entries(F.from_json(items, "map<string,string>"))
    return F.transform(entries, lambda e, i: F.struct(i.alias("pos"), e["key"].alias("key"), F.get_json_object(e["value"], "$.type").alias("kind"), e["value"].alias("body")))


def component_html(kind: Column, body: Column) -> Column:
    """Markup of one component by its type; unknown types give nothing."""
    text = any_path(body, "$.richText", "$.text")
    figure = figure_of(F.get_json_object(body, "$.images[0]"))
    parts = F.transform(F.coalesce(F.from_json(F.get_json_object(body, "$.paragraphList"), "array<string>"), F.array().cast("array<string>")), lambda x: F.concat(F.lit("<p>"), F.coalesce(F.get_json_object(x, "$.text"), x), F.lit("</p>")))
    return (
        F.when(kind == "text", F.concat(F.lit("<p>"), text, F.lit("</p>")))
        .when(kind == "quote", F.concat(F.lit("<blockquote>"), text, F.lit("</blockquote>")))
        .when(kind == "heading", F.concat(F.lit("<h2>"), F.coalesce(path(body, "$.title"), text), F.lit("</h2>")))
        .when(kind == "paragraphlist", F.array_join(parts, ""))
        .when(kind == "image", figure)
    )


def figure_of(image: Column) -> Column:
    """``<figure>`` of an image object with url and optional alt and caption."""
    src = any_path(image, "$.url", "$.src")
    caption = any_path(image, "$.caption", "$.title")
    close = F.when(caption.isNotNull(), F.concat(F.lit("<figcaption>"), caption, F.lit("</figcaption></figure>"))).otherwise(F.lit("</figure>"))
    return F.when(src.isNotNull(), F.concat(F.lit('<figure><img src="'), src, F.lit('" alt="'), F.coalesce(path(image, "$.alt"), F.lit("")), F.lit('">'), close))


def rows_html(rows: Column) -> Column:
    """HTML table of an array of rows of texts; the first is the header, empty rows go."""
    from .text import escape_html

    full = F.filter(rows, lambda r: F.exists(r, lambda c: F.coalesce(c, F.lit("")) != ""))
    cells = lambda r, tag: F.array_join(F.transform(r, lambda c: F.concat(F.lit(f"<{tag}>"), escape_html(F.coalesce(c, F.lit(""))), F.lit(f"</{tag}>"))), "")
    row = lambda r, tag: F.concat(F.lit("<tr>"), cells(r, tag), F.lit("</tr>"))
    body = F.array_join(F.transform(F.slice(full, 2, F.greatest(F.size(full) - 1, F.lit(0))), lambda r: row(r, "td")), "")
    head = F.concat(F.lit("<thead>"), row(F.get(full, F.lit(0)), "th"), F.lit("</thead>"))
    return F.when(F.size(full) > 0, F.concat(F.lit("<table>"), head, F.when(body != "", F.concat(F.lit("<tbody>"), body, F.lit("</tbody>"))).otherwise(F.lit("")), F.lit("</table>")))


def elements_html(elements: Column) -> Column:
    """HTML of an array of struct<kind, text, items, src, caption> of article elements."""
    from .text import escape_html

    def one(e: Column) -> Column:
        wrap = lambda tag: F.concat(F.lit(f"<{tag}>"), escape_html(e["text"]), F.lit(f"</{tag}>"))
        ul = F.concat(F.lit("<ul>"), F.array_join(F.transform(e["items"], lambda x: F.concat(F.lit("<li>"), escape_html(x), F.lit("</li>"))), ""), F.lit("</ul>"))
        figure = F.concat(F.lit('<figure><img src="'), e["src"], F.lit('"><figcaption>'), escape_html(F.coalesce(e["caption"], F.lit(""))), F.lit("</figcaption></figure>"))
        return F.when(e["kind"].isin("h2", "h3"), F.when(e["kind"] == "h2", wrap("h2")).otherwise(wrap("h3"))).when(e["kind"] == "p", wrap("p")).when(e["kind"] == "ul", ul).when(e["kind"] == "figure", figure)

    return F.array_join(F.filter(F.transform(elements, one), lambda x: x.isNotNull()), "\n")


def json_attribute(html: Column, attr: str) -> Column:
    """JSON text of an attribute, character references decoded. Arrow UDF."""
    from .html import html_unescape

    return none_if_empty(html_unescape(F.regexp_extract(html, rf'\s{attr}="([^"]*)"', 1)))
