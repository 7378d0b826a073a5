"""The engine's registered queries over the driver's tables, each beside its DuckDB SQL.

Both sides of a pair state the same result independently: the query with the library's operators, the SQL from
scratch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, html, json, predicates, text, urls
from ..operators import aggregates, dedup, joins, layout, quality, sequence, topk
from . import site_queries  # noqa: F401  (registers its own)
from .registry import query, registered, table, utc  # noqa: F401

# --- pages: projection, links, URLs

H1 = r"(?is)<h1[^>]*>(.*?)</h1>"


@query(
    rf"""
with t as (select page_id, url, trim(regexp_replace(regexp_replace(regexp_extract(html, '{H1}', 1), '<[^>]+>', ' ', 'g'), '[ \t\r\n\f]+', ' ', 'g'), ' ') as title,
  trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[ \t\r\n\f]+', ' ', 'g'), ' ') as body from pages),
s as (select *, coalesce(nullif(lower(regexp_replace(regexp_replace(title, '[^a-zA-Z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')), ''), 'item') as slug, md5(concat(title, url)) as guid from t where length(body) >= 280),
d as (select *, row_number() over (partition by guid order by page_id) as nth from s)
select page_id, title, slug, guid, length(body) as chars from (select *, row_number() over (order by length(body) desc, page_id) as r from d where nth = 1) where r <= 20
"""
)
def page_items(spark, sf_dir):
    """Flagship: title, text, slug and identity of each page, gated by length, deduped, the 20 longest."""
    pages = table(spark, sf_dir, "pages")
    title = text.collapse(text.drop_tags(F.regexp_extract("html", H1, 1)))
    named = pages.select("page_id", "url", title.alias("title"), text.plain_page_text(F.col("html")).alias("body"))
    gated = named.where(F.length("body") >= 280).select("page_id", "title", text.slugify(F.col("title")).alias("slug"), text.guid(F.col("title"), F.col("url")).alias("guid"), F.length("body").alias("chars"))
    return dedup.first_wins(gated, "guid", ["page_id"]).orderBy(F.desc("chars"), "page_id").limit(20)


@query(r"""select page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[ \t\r\n\f]+', ' ', 'g'), ' ') as plain from pages""")
def page_plain_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.plain_page_text(F.col("html")).alias("plain"))


@query(r"""with l as (select page_id, regexp_extract_all(html, '(?i)<a [^>]*href="([^"]*)"', 1) as a from pages)
select page_id, generate_subscripts(a, 1) - 1 as pos, unnest(a) as href from l""")
def page_link_explode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(urls.links(F.col("html"))).alias("pos", "href"))


@query("""with c as (select page_id, url, rtrim(regexp_replace(url, '[?#].*$', ''), '/') as canonical from pages),
r as (select *, row_number() over (partition by canonical order by page_id) as nth from c) select page_id, url, canonical from r where nth = 1""")
def url_canonical_dedup(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", urls.canonical_url(F.col("url")).alias("canonical"))
    return dedup.first_wins(pages, "canonical", ["page_id"])


@query("""select lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) as host, count(*) as pages, min(page_id) as first_page, sum(length(html))::bigint as chars from pages group by 1""")
def url_host_rollup(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(urls.url_host(F.col("url")).alias("host"), "page_id", F.length("html").alias("n"))
    return pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.min("page_id").alias("first_page"), F.sum("n").alias("chars"))


@query(r"""select page_id, url from pages where regexp_matches(url, '/en/[0-9]+') and starts_with(url, 'https://') and not contains(url, 'utm_')""")
def link_filter(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").where(u.rlike(r"/en/[0-9]+") & F.startswith(u, F.lit("https://")) & ~F.contains(u, F.lit("utm_"))).select("page_id", "url")


@query("""select page_id, (html is null or html = '' or contains(html, 'Just a moment') or contains(substr(html, 1, 500), 'Cloudflare') or contains(substr(html, 1, 2000), 'Performing security verification')
 or contains(substr(html, 1, 3000), 'Target URL returned error 403')) as blocked, contains(substr(html, 1, 500), 'the') as early from pages""")
def blocked_page_flags(spark, sf_dir):
    page = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", predicates.looks_blocked(page).alias("blocked"), F.contains(F.substring(page, 1, 500), F.lit("the")).alias("early"))


@query(
    r"""with p as (select page_id, url, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) as title, list_extract(string_split(regexp_replace(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '/+$', ''), '/'), -1) as last from pages),
s as (select *, lower(regexp_replace(regexp_replace(title, '[^a-zA-Z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) as by_title, case when last <> '' and not contains(last, '.') then lower(regexp_replace(regexp_replace(last, '[^a-zA-Z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) end as by_link from p),
n as (select *, coalesce(nullif(by_link, ''), nullif(by_title, ''), substr(md5(concat(url, '|', title)), 1, 12)) as slug from s)
select page_id, slug, concat(slug, '-', substr(md5(concat(url, '|', title)), 1, 10)) as unique_slug from n"""
)
def slug_fallback(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("html", H1, 1).alias("title"))
    slug = text.slug_of(F.col("url"), F.col("title"))
    return pages.select("page_id", slug.alias("slug"), text.slug_with_hash(slug, F.col("url"), F.col("title")).alias("unique_slug"))


# --- documents: lines and paragraphs


@query("""select doc_id, case when length(text) <= 420 then text else concat(rtrim(regexp_replace(substr(text, 1, 420), ' [^ ]*$', ''), '.,;:!? '), '…') end as teaser,
 case when length(text) > 500 then concat(substr(text, 1, 500), '...') else text end as head from documents""")
def truncate_words(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate_words(t).alias("teaser"), text.truncate_hard(t).alias("head"))


def lines_of(spark, sf_dir) -> DataFrame:
    return sequence.explode_pieces(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), F.col("text"), "\n", "pos", "line").drop("text")


LINES = "with lines as (select doc_id, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)"


@query(
    LINES
    + """, j as (select doc_id, pos, line, lower(trim(line, ' ')) as low, lower(line) as l from lines)
select doc_id, pos, line from j where not (length(low) <= 2 or regexp_matches(low, '^[0-9]{1,4}$') or starts_with(low, 'page ') or regexp_matches(low, '^[0-9]+\\|[0-9]+\\|[0-9]+$')
 or regexp_matches(low, '^[^ @]+@[^ @]+\\.[a-z]+$') or regexp_matches(low, '^https?://[^ ]+$') or regexp_matches(low, '^[0-9]{1,2} [a-z]+ [0-9]{4}$'))
 and length(line) >= 40 and not (contains(l, 'license') or contains(l, 'copyright') or contains(l, 'share'))""".replace("\\\\", "\\")
)
def line_noise_filter(spark, sf_dir):
    line = F.col("line")
    return lines_of(spark, sf_dir).where(~predicates.is_junk_line(line) & ~predicates.is_noise_line(line, ("license", "copyright", "share"))).select("doc_id", "pos", "line")


@query(
    LINES
    + """, b as (select *, length(line) < 40 as brk from lines), g as (select *, sum(brk::int) over (partition by doc_id order by pos)::bigint as island from b)
select doc_id, island, string_agg(line, ' ' order by pos) as text, min(pos) as first_pos from g where not brk group by doc_id, island"""
)
def paragraph_assembly(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    return sequence.assemble(lines, F.col("line"), F.length("line") < 40, ["doc_id"], ["pos"])


@query(
    LINES
    + """, m as (select *, row_number() over (partition by doc_id order by pos) as nth, (contains(lower(line), 'license') or length(line) < 20) as stop from lines),
l as (select *, max((stop and nth > 3)::int) over (partition by doc_id order by pos) as latch from m) select doc_id, pos, line from l where latch = 0 and not stop"""
)
def stop_marker_cut(spark, sf_dir):
    line = F.col("line")
    stop = F.contains(F.lower(line), F.lit("license")) | (F.length(line) < 20)
    return sequence.until_stop(lines_of(spark, sf_dir), stop, ["doc_id"], ["pos"], at_least=3).select("doc_id", "pos", "line")


@query("""with c as (select doc_id, text, least(nullif(strpos(text, 'License'), 0), nullif(strpos(text, 'the '), 0)) as p from documents)
select doc_id, case when p is null then text else substr(text, 1, p - 1) end as head from c""")
def marker_position_cut(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sequence.cut_at_first(F.col("text"), ["License", "the "]).alias("head"))


@query("""with l as (select conv_id, turn, role, max((role = 'assistant')::int) over (partition by conv_id order by turn) as seen from conversations) select conv_id, turn, role from l where seen = 1""")
def start_latch(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return sequence.from_start(turns, F.col("role") == "assistant", ["conv_id"], ["turn"])


@query("""with s as (select conv_id, turn, role, last_value(case when role = 'user' then true when role = 'system' then false end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as seen from conversations)
select conv_id, turn, role from s where seen and role not in ('user', 'system')""")
def two_flag_latch(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    role = F.col("role")
    return sequence.while_on(turns, role == "user", role == "system", ["conv_id"], ["turn"])


@query(
    r"""with m as (select page_id, html, regexp_extract_all(html, '(?s)<p>') as f, string_split_regex(html, '(?s)<p>') as g from pages),
e as (select page_id, html, generate_subscripts(f, 1) - 1 as pos, f, g from m),
p as (select page_id, html, pos, 1 + list_sum(list_transform(g[1:pos + 1], lambda x: length(x))) + 3 * pos as s from e),
l as (select page_id, html, pos, s + 3 as e, coalesce(lead(s) over (partition by page_id order by s), length(html) + 1) as n from p)
select page_id, pos, e::int as end, substr(html, e::bigint, (n - e)::bigint) as body from l"""
)
def lead_span_body(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    spans = sequence.match_spans(pages, F.col("html"), "(?s)<p>", 0)
    return sequence.lead_span(spans, F.col("html"), ["page_id"]).select("page_id", "pos", "end", "body")


@query("""select conv_id, turn, role, last_value(case when role = 'user' then text end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as asked from conversations""")
def asof_heading(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return sequence.nearest_preceding(turns, F.when(F.col("role") == "user", F.col("text")), ["conv_id"], ["turn"], "asked").select("conv_id", "turn", "role", "asked")


@query(
    LINES
    + """, g as (select *, sum((length(line) > 200)::int) over (partition by doc_id order by pos)::bigint as island from lines)
select doc_id, island, string_agg(line, ' ' order by pos) as text, min(pos) as first_pos from g group by doc_id, island"""
)
def bullet_merge(spark, sf_dir):
    return sequence.merge_continuations(lines_of(spark, sf_dir), F.col("line"), F.length("line") > 200, ["doc_id"], ["pos"])


@query(LINES + """, r as (select *, row_number() over (partition by doc_id, lower(line) order by pos) as nth from lines) select doc_id, pos, line from r where nth = 1""")
def ci_paragraph_dedup(spark, sf_dir):
    return dedup.first_wins(lines_of(spark, sf_dir), [F.col("doc_id"), F.lower("line")], ["pos"]).select("doc_id", "pos", "line")


@query(LINES + """, r as (select *, row_number() over (partition by doc_id, line order by pos) as nth from lines) select doc_id, pos, line from r where nth = 1 or length(line) >= 80""")
def short_block_dedup(spark, sf_dir):
    return dedup.short_first_wins(lines_of(spark, sf_dir), F.col("line"), ["pos"], ["doc_id"]).select("doc_id", "pos", "line")


@query("""with r as (select conv_id, turn, role, row_number() over (partition by conv_id, md5(text) order by turn) as nth from conversations) select conv_id, turn, role from r where nth = 1 or role = 'system'""")
def forced_block_dedup(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return dedup.first_wins_or_forced(turns, F.md5("text"), ["turn"], F.col("role") == "system", ["conv_id"]).select("conv_id", "turn", "role")


@query(
    LINES
    + """, p as (select source, count(distinct doc_id) as pages from lines group by source), s as (select source, lower(line) as line, count(distinct doc_id) as n from lines where length(line) < 120 group by all)
select source, line, n, pages from s join p using (source) where n >= greatest(3, floor(0.05 * pages)::int)"""
)
def boilerplate_lines(spark, sf_dir):
    return aggregates.boilerplate_lines(lines_of(spark, sf_dir), "source", "doc_id", "line", share=0.05)


@query("""select doc_id, ((contains(lower(text), 'the ')::int + contains(lower(text), 'license')::int + contains(lower(text), 'and ')::int) >= 2 and length(text) >= 500) as passes from documents""")
def marker_gate(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", (predicates.is_marked(t, ("the ", "license", "and ")) & (F.length(t) >= 500)).alias("passes"))


@query(
    LINES + """, b as (select doc_id, pos, line, length(line) as n from lines where pos < 8 and length(line) between 90 and 420) select doc_id, arg_min(line, pos) as summary from b group by doc_id"""
)
def first_fitting_summary(spark, sf_dir):
    return sequence.first_fitting(lines_of(spark, sf_dir), F.length("line").between(90, 420), F.col("pos"), "line", ["doc_id"], 8, "summary")


@query(
    LINES
    + """, r as (select doc_id, pos, length(line) >= 80 as member, row_number() over (partition by doc_id order by pos) - row_number() over (partition by doc_id, length(line) >= 80 order by pos) as run from lines)
select doc_id, pos, case when member then run end as run from r"""
)
def consecutive_runs(spark, sf_dir):
    return sequence.runs(lines_of(spark, sf_dir), F.length("line") >= 80, ["doc_id"], ["pos"]).select("doc_id", "pos", "run")


@query("""select doc_id, lower(regexp_replace(text, '[^a-zA-Z0-9]+', '-', 'g')) as words, md5(text) as md5, sha256(text) as sha256, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') as escaped from documents""")
def scalar_strings(spark, sf_dir):
    t = F.col("text")
    escaped = F.replace(F.replace(text.escape_html(t), F.lit("&quot;"), F.lit('"')), F.lit("&#x27;"), F.lit("'"))
    return table(spark, sf_dir, "documents").select("doc_id", F.lower(F.regexp_replace(t, "[^a-zA-Z0-9]+", "-")).alias("words"), F.md5(t).alias("md5"), F.sha2(t.cast("binary"), 256).alias("sha256"), escaped.alias("escaped"))


# --- previous snapshot


@query("""select d.doc_id, d.source from documents d where not exists (select 1 from documents p where p.doc_id % 2 = 0 and p.text = d.text)""")
def new_items_anti(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("key"))
    return joins.new_rows(docs, docs.where("doc_id % 2 = 0"), "key").select("doc_id", "source")


@query("""with p as (select o_orderkey, case when o_orderkey % 6 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d') end as pub from orders where o_orderkey % 2 = 0)
select c.o_orderkey, case when p.o_orderkey is not null then nullif(p.pub, '') else case when c.o_orderkey % 5 = 0 then 'run' else strftime(c.o_orderdate + interval 1 day, '%Y-%m-%d') end end as pub from orders c left join p using (o_orderkey)""")
def carry_forward_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    previous = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 6 == 0, "").otherwise(day(F.col("o_orderdate"))).alias("pub"))
    fresh = F.when(F.col("o_orderkey") % 5 != 0, day(F.date_add("o_orderdate", 1)))
    return joins.carry_forward(orders, previous, "o_orderkey", "pub", fresh, F.lit("run")).select("o_orderkey", "pub")


@query("""with t as (select s_suppkey as guid, concat('Customer#', lpad((s_suppkey % 50)::varchar, 9, '0')) as slug, s_name from supplier),
a as (select guid, max(struct_pack(s_name := s_name)) as r from t group by guid), b as (select slug, max(struct_pack(s_name := s_name)) as r from t group by slug)
select c_custkey, coalesce(a.r.s_name, b.r.s_name) as old_s_name from customer left join a on c_custkey = a.guid left join b on c_name = b.slug""")
def two_key_lookup(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("guid"), F.concat(F.lit("Customer#"), F.lpad((F.col("s_suppkey") % 50).cast("string"), 9, "0")).alias("slug"), "s_name")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("guid"), F.col("c_name").alias("slug"))
    return joins.two_key_lookup(customers, supplier, "guid", "slug", ["s_name"]).select("c_custkey", "old_s_name")


@query("""select o_orderkey, coalesce(case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%Y-%m-%d') end, case when c_acctbal > 0 then c_mktsegment end, o_orderpriority) as picked from orders left join customer on o_custkey = c_custkey""")
def precedence_lookup(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    picked = joins.precedence((F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")), (F.col("c_acctbal") > 0, F.col("c_mktsegment")), (F.lit(True), F.col("o_orderpriority")))
    return joined.select("o_orderkey", picked.alias("picked"))


@query("""with a as (select o_custkey as k, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as nth from orders),
b as (select l_suppkey as k, l_orderkey, l_linenumber, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber) as nth from lineitem) select k, nth, o_orderkey, l_orderkey, l_linenumber from a join b using (k, nth)""")
def positional_join(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey")
    b = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), "l_orderkey", "l_linenumber")
    return joins.positional(a, b, ["k"], ["o_orderkey"], ["l_orderkey", "l_linenumber"])


@query("""with s as (select p_partkey as k, p_size as o from part), f as (select l_partkey + 50 as k, count(*) as n from lineitem group by 1)
select k, s.o, f.n, case when s.k is null then 'leftover' when f.k is null then 'unfilled' else 'filled' end as state from s full outer join f using (k)""")
def full_outer_leftovers(spark, sf_dir):
    slots = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("o"))
    found = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") + 50).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return joins.full_outer_leftovers(slots, found, "k", "o").select("k", "o", "n", "state")


@query("""select d.doc_id, d.source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def missing_page_heal(spark, sf_dir):
    return joins.missing_outputs(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("""with c as (select rtrim(regexp_replace(url, '[?#].*$', ''), '/') as u from pages), p as (select case when page_id % 3 = 0 then concat(u, '/old') else u end as u from (select page_id, rtrim(regexp_replace(url, '[?#].*$', ''), '/') as u from pages))
select (select count(*) from (select u from c except select u from p)) as added, (select count(*) from (select u from p except select u from c)) as removed""")
def set_change_detect(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("u"))
    moved = F.when(F.col("page_id") % 3 == 0, F.concat("u", F.lit("/old"))).otherwise(F.col("u"))
    now, then = pages.select("u").distinct(), pages.select(moved.alias("u")).distinct()
    marked = now.withColumn("side", F.lit(1)).unionByName(then.withColumn("side", F.lit(2))).groupBy("u").agg(F.sum("side").alias("sides"))
    return marked.agg(F.count_if(F.col("sides") == 1).alias("added"), F.count_if(F.col("sides") == 2).alias("removed"))


@query("""with d as (select source, md5(concat(doc_id::varchar, chr(9), coalesce(lang, ''), chr(9), coalesce(text, ''))) as m from documents),
s as (select source, count(*) as items, sum(('0x' || substr(m, 1, 13))::bigint) as a, sum(('0x' || substr(m, 14, 13))::bigint) as b from d group by source)
select source, items, md5(concat(items::varchar, '|', a::varchar, '|', b::varchar)) as signature from s""")
def feed_signatures(spark, sf_dir):
    return aggregates.feed_signature(table(spark, sf_dir, "documents"), "source", "doc_id", ["lang", "text"])


@query("""with v as (select doc_id, 2 * (doc_id % 2) as version from documents where doc_id % 4 <> 3) select d.doc_id, case when v.doc_id is null then 'new' when v.version < 2 then 'stale' when d.doc_id % 5 = 0 then 'changed' else 'kept' end as action,
 md5(d.text) as body from documents d left join v using (doc_id)""")
def incremental_upsert(spark, sf_dir):
    from ..streaming import incremental

    docs = table(spark, sf_dir, "documents")
    now = docs.select("doc_id", F.md5("text").alias("body"), F.when(F.col("doc_id") % 5 == 0, F.lit("x")).otherwise(F.md5("text")).alias("print"))
    stored = docs.where("doc_id % 4 <> 3").select("doc_id", F.md5("text").alias("print"), (2 * (F.col("doc_id") % 2)).cast("int").alias("version"))
    return incremental.plan_upsert(now, stored, "doc_id", "print", version=2).select("doc_id", "action", "body")


# --- top-k


@query("""with c as (select *, row_number() over (partition by o_custkey order by o_orderkey) as a from orders), k as (select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey) as b from c where a <= 8 and o_orderstatus <> 'P')
select o_custkey, o_orderkey from k where b <= 3""")
def candidate_topk(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    order = [topk.newest_first(F.col("o_orderdate"), "last"), F.col("o_orderkey")]
    return topk.two_stage(orders, ["o_custkey"], ["o_orderkey"], 8, F.col("o_orderstatus") != "P", order, 3).select("o_custkey", "o_orderkey")


@query("""with e as (select user_id, event_id, event_type = 'purchase' as fresh, row_number() over (partition by user_id, event_type = 'purchase' order by event_id) as nth from events) select event_id, fresh and nth > 5 as deferred from e""")
def work_budget(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return topk.within_budget(events, ["user_id"], F.col("event_type") == "purchase", ["event_id"], 5).select("event_id", "deferred")


@query("""select source, max_by(doc_id, (length(text), -doc_id)) as doc_id, max(length(text)) as chars from documents group by source""".replace("max_by(doc_id, (length(text), -doc_id))", "arg_max(doc_id, row(length(text), -doc_id))"))
def argmax_candidate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.length("text").alias("chars"))
    return aggregates.best_candidate(docs, ["source"], [F.col("chars")], ["doc_id", "chars"], "doc_id")


@query("""select l_orderkey, round(coalesce(median(l_quantity), 10.0), 4) as median_size, max(l_quantity) as max_size, sum((l_returnflag = 'R')::int) >= greatest(1, count(*) // 2) as bold, string_agg(l_linestatus, ' ' order by l_linenumber, l_linestatus) as text from lineitem group by 1""")
def median_style(spark, sf_dir):
    styled = aggregates.page_style(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_quantity", F.col("l_returnflag") == "R", "l_linestatus", "l_linenumber")
    return styled.withColumn("median_size", F.round("median_size", 4))


# --- layout


@query("""with e as (select user_id, event_id, epoch_us(ts) as a, epoch_us(ts) + 3600000000 as b from events), r as (select *, max(b) over (partition by user_id order by a, event_id rows between unbounded preceding and 1 preceding) as reach from e),
i as (select *, sum(coalesce(a > reach, false)::int) over (partition by user_id order by a, event_id) as island from r) select user_id, island::bigint as island, min(a) as lo, max(b) as hi, count(*) as n from i group by 1, 2""")
def gap_islands_cluster(spark, sf_dir):
    at = F.unix_micros(utc("ts"))
    events = table(spark, sf_dir, "events").select("user_id", "event_id", at.alias("a"), (at + 3_600_000_000).alias("b"))
    merged = sequence.merge_overlapping(events, "a", "b", F.lit(0), ["user_id"], ["a", "event_id"])
    return merged.groupBy("user_id", "island").agg(F.min("a").alias("lo"), F.max("b").alias("hi"), F.count(F.lit(1)).alias("n"))


@query("""select l_orderkey, l_linenumber, sum((l_discount >= 0.05)::int) over (partition by l_orderkey order by l_linenumber range between unbounded preceding and 1 following)::bigint as band from lineitem""")
def band_rank_order(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return sequence.band_rank(lines, F.col("l_discount") >= 0.05, "l_linenumber", ["l_orderkey"]).select("l_orderkey", "l_linenumber", "band")


@query("""with e as (select user_id, event_id, epoch_us(ts) as a, event_type from events) select x.event_id, (select min(b.a) from e b where b.user_id = x.user_id and b.event_type = 'purchase' and b.a > x.a) as until from e x where x.event_type = 'click'""")
def range_next_bound(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.unix_micros(utc("ts")).alias("a"))
    return joins.next_bound(events.where("event_type = 'click'"), events.where("event_type = 'purchase'"), ["user_id"], "a", "until").select("event_id", "until")


@query("""with e as (select event_id, user_id, event_type, epoch_us(ts) as a from events) select distinct x.event_id from e x join e y on x.user_id = y.user_id and x.event_type = 'click' and y.event_type = 'view' and abs(x.a - y.a) < 600000000""")
def side_by_side(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(utc("ts")).alias("t"))
    return joins.has_near(events.where("event_type = 'click'"), events.where("event_type = 'view'"), ["user_id"], "t", 600_000_000).select("event_id")


RECTS = """with r as (select l_orderkey as doc, l_linenumber as n, l_quantity as x0, (l_partkey % 40)::double as y0, l_quantity + 10 + 100 * l_tax as x1, (l_partkey % 40 + 8)::double as y1, l_returnflag = 'R' as fig from lineitem)"""


def rects(spark, sf_dir) -> DataFrame:
    y = (F.col("l_partkey") % 40).cast("double")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("x0"), y.alias("y0"), (F.col("l_quantity") + 10 + 100 * F.col("l_tax")).alias("x1"), (y + 8).alias("y1"), (F.col("l_returnflag") == "R").alias("fig"))


@query(
    RECTS
    + """ select t.doc, t.n from r t where not t.fig and not exists (select 1 from r c where c.fig and c.doc = t.doc
 and greatest(least(t.x1, c.x1) - greatest(t.x0, c.x0), 0) * greatest(least(t.y1, c.y1) - greatest(t.y0, c.y0), 0) >= 0.3 * ((t.x1 - t.x0) * (t.y1 - t.y0)) and (t.x1 - t.x0) * (t.y1 - t.y0) > 0)"""
)
def rect_overlap_anti(spark, sf_dir):
    boxes = rects(spark, sf_dir)
    return joins.not_covered(boxes.where("NOT fig"), boxes.where("fig"), ["doc"], 0.3).select("doc", "n")


@query(RECTS + """ select doc, min(x0) as x0, min(y0) as y0, round(max(x1), 6) as x1, max(y1) as y1 from r where fig group by doc""")
def cluster_boxes(spark, sf_dir):
    return aggregates.bounding_boxes(rects(spark, sf_dir).where("fig"), ["doc"]).withColumn("x1", F.round("x1", 6))


@query(
    RECTS
    + """, k as (select *, (x1 - x0) < 30 as narrow, (x1 - x0) < 30 and x0 < 25 and x1 > 25 as crosses from r), p as (select *, sum(narrow::int) over (partition by doc) >= 4 and sum(crosses::int) over (partition by doc) <= 0.25 * sum(narrow::int) over (partition by doc) as two from k),
c as (select *, case when not two then 'full' when x0 < 22.5 and x1 > 25 * 1.1 and x1 - x0 > 30 then 'full' when (x0 + x1) / 2 < 25 then 'left' else 'right' end as col from p),
b as (select *, sum((two and col = 'full')::int) over (partition by doc order by y0 range between unbounded preceding and 1 following) as band from c)
select doc, n, row_number() over (partition by doc order by band, case when two then case col when 'full' then 0 when 'left' then 1 else 2 end else 0 end, round(y0), x0, n) as nth from b"""
)
def reading_order(spark, sf_dir):
    boxes = rects(spark, sf_dir).withColumn("page", F.lit(1))
    return layout.reading_order(boxes, 50.0, ["n"]).select("doc", "n", "nth")


# --- JSON, dates, quality


@query("""select event_id, json_extract_string(props, '$.k') as k, coalesce(json_extract_string(props, '$.title'), json_extract_string(props, '$.k'), '') as label, try_cast(json_extract_string(props, '$.k') as int) % 2 = 0 as even from events""")
def json_props_path(spark, sf_dir):
    p = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", json.path(p, "$.k").alias("k"), F.coalesce(json.any_path(p, "$.title", "$.k"), F.lit("")).alias("label"), (json.path(p, "$.k").try_cast("int") % 2 == 0).alias("even"))


@query("""select o_orderkey, o_orderdate as ts, strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S GMT') as rfc, strftime(o_orderdate, '%B %d, %Y') as human from orders""")
def multi_format_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", utc("o_orderdate").alias("d"))
    k = F.col("o_orderkey") % 4
    printed = F.when(k == 0, F.date_format("d", "MMMM d, yyyy")).when(k == 1, F.date_format("d", "MMM. d, yyyy")).when(k == 2, F.date_format("d", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(dates.format_rfc822(F.col("d")))
    parsed = orders.withColumn("raw", printed).withColumn("p", F.coalesce(dates.parse_any(F.col("raw")), dates.parse_first(F.col("raw"))))
    return parsed.select("o_orderkey", F.col("p").cast("timestamp_ntz").alias("ts"), dates.format_rfc822(F.col("p")).alias("rfc"), dates.human_date(F.col("p")).alias("human"))


@query("""select doc_id::varchar as key, 'long' as rule from documents where length(text) < 200 union all select doc_id::varchar, 'language' from documents where lang not in ('en', 'de') union all
select d.doc_id::varchar, 'quality' from documents d left join labels l using (doc_id) where coalesce(l.quality, 1) <> 1""")
def dq_violations(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    rules = {"long": F.length("text") >= 200, "language": F.col("lang").isin("en", "de"), "quality": F.coalesce("quality", F.lit(1)) == 1}
    return quality.violations(docs, F.col("doc_id").cast("string"), rules)


@query("""select quality, toxic, count(*) as n, count(*) filter (where doc_id % 2 = 0) as even from labels group by all""")
def status_counts(spark, sf_dir):
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id") % 2 == 0).alias("even"))


# --- forms of dates, URLs and stored pages


@query(
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as compact, strftime(o_orderdate, '%Y-%m-%d') as posted, strftime(o_orderdate, '%Y-%m-%d') as archived, o_orderkey % 2 = 1 as timed, strftime(o_orderdate, '%Y-%m-%d 00:00:00') as day,
 case when o_orderkey % 3 = 0 then '2026-01-02' else strftime(o_orderdate, '%Y-%m-%d') end as build, case when o_orderkey % 5 = 0 then '2026-01-02' else strftime(o_orderdate, '%Y-%m-%d') end as known from orders"""
)
def date_forms(spark, sf_dir):
    d, k, run = F.col("d"), F.col("o_orderkey"), F.lit("2026-01-02").cast("timestamp")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", utc("o_orderdate").alias("d"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    rfc = F.concat(F.date_format(d, "EEE, dd MMM yyyy"), F.when(k % 2 == 1, " 08:30:00 GMT").otherwise(" 00:00:00 GMT"))
    return orders.select(
        "o_orderkey",
        iso(dates.compact_date(F.concat(F.lit("report-"), F.date_format(d, "yyyyMMdd"), F.lit(".pdf")))).alias("compact"),
        iso(dates.date_in_text(F.concat(F.lit("A note. Posted on "), F.date_format(d, "MMMM d, yyyy"), F.lit(" by us")), "Posted on")).alias("posted"),
        iso(dates.parse_first(iso(d), dates.ARCHIVE_FORMATS)).alias("archived"),
        dates.not_a_plain_day(rfc).alias("timed"),
        F.date_format(dates.day_of(dates.parse_rfc822(rfc)), "yyyy-MM-dd HH:mm:ss").alias("day"),
        iso(dates.build_date(k % 3 == 0, run, d)).alias("build"),
        iso(dates.or_run(F.when(k % 5 != 0, d), run)).alias("known"),
    )


@query(
    r"""with p as (select page_id, url, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1) as path, regexp_replace(url, '^https?://', '') as bare from pages)
select page_id, ends_with(lower(path), '.html') as is_html, ends_with(lower(concat(path, '.PDF')), '.pdf') as is_pdf, concat('https://proxy.example/http://', bare) as plain, concat('https://proxy.example/https://', bare) as secure,
 concat('https://own.example/item/f/', page_id, '/') as item, 'f' as feed, page_id::varchar as slug, page_id % 2 = 0 as localized from p"""
)
def url_forms(spark, sf_dir):
    url, base = F.col("url"), "https://own.example"
    item = urls.item_page_url(base, F.lit("f"), F.col("page_id").cast("string"))
    proxies, back = urls.proxy_urls(url, "https://proxy.example"), urls.item_of_path(item)
    return table(spark, sf_dir, "pages").select(
        "page_id", F.endswith(F.lower(urls.url_path(url)), F.lit(".html")).alias("is_html"), urls.is_pdf_url(F.concat(urls.url_path(url), F.lit(".PDF"), F.lit("?a=b"))).alias("is_pdf"),
        proxies[0].alias("plain"), proxies[1].alias("secure"), item.alias("item"), back["feed"].alias("feed"), back["slug"].alias("slug"),
        urls.is_localized(F.when(F.col("page_id") % 2 == 0, item).otherwise(F.lit("/item/g/x/")), base, F.lit("f")).alias("localized"),
    )


@query(
    r"""with p as (select page_id, html, strpos(lower(html), '</h1>') as h, strpos(lower(html), '</head>') as e from pages)
select page_id, md5(case when h > 0 then concat(substr(html, 1, h + 4), '<p>x</p>', substr(html, h + 5)) else html end) as after_title, md5(case when e > 0 then concat(substr(html, 1, e - 1), '<style></style>', substr(html, e)) else html end) as styled,
 md5(case when contains(html, '<article') then html else 'new' end) as once, md5(regexp_replace(html, '(?is)[ 	]*<script[^>]*>.*?</script>[ 	]*
?', '', 'g')) as without_scripts, case page_id % 3 when 0 then 'png' when 1 then 'jpg' else 'webp' end as extension,
 concat('<svg><path d="', page_id, '"/></svg>') as svg, concat('a', page_id) as srcset, length(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g')) as chars from p"""
)
def page_edits(spark, sf_dir):
    page, k = F.col("html"), F.col("page_id")
    image = F.when(k % 3 == 0, F.lit("http://h/i.PNG?w=1")).when(k % 3 == 1, F.lit("http://h/i.jpeg")).otherwise(F.lit("http://h/i"))
    drawn = F.concat(F.lit('<?xml version="1.0"?><svg width="9"><script>no</script><path d="'), k.cast("string"), F.lit('" onload="x()"/></svg>'))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(text.insert_after_h1(page, F.lit("<p>x</p>"))).alias("after_title"), F.md5(text.insert_before_head_end(page, F.lit("<style></style>"))).alias("styled"),
        F.md5(text.once(page, "<article", F.lit("new"))).alias("once"), F.md5(text.drop_elements(page, "script")).alias("without_scripts"), text.image_extension(image, F.lit("image/webp; q=1")).alias("extension"),
        text.clean_svg(drawn).alias("svg"), text.srcset_first(F.concat(F.lit("a"), k.cast("string"), F.lit(" 1x, b 2x"))).alias("srcset"), F.length(text.drop_comments(page)).alias("chars"),
    )


@query(
    """with n as (select doc_id, concat('The year ', doc_id, ' of rates') as title, 'The markets moved again.' as description from documents)
select doc_id, title, 'This year was long.' as description, 'May 4, 2025' as date, concat('line one of ', doc_id, '  line two') as listed, 'May 2025' as listed_date, doc_id % 2 = 0 as stray from n"""
)
def listing_fields(spark, sf_dir):
    from . import extraction

    k = F.col("doc_id").cast("string")
    card = extraction.card_fields(F.concat(F.lit("The year "), k, F.lit(" of rates This year was long. May 4, 2025 Learn more about it")))
    listed = extraction.up_to_line(F.concat(F.lit("line one of "), k, F.lit("\n\n ![i](http://i) line two [Read more about x](http://x)\nMay 2025\nnot this")))
    odd = F.concat(F.when(F.col("doc_id") % 2 == 0, F.lit("{ stray <p>")).otherwise(F.lit("")), F.lit('x({"id": '), k, F.lit(', "a": "}"})'))
    whole = html.balanced_json(odd) == F.concat(F.lit('{"id": '), k, F.lit(', "a": "}"}'))
    title = F.regexp_replace(card["title"], r" This.*$", "")
    return table(spark, sf_dir, "documents").select("doc_id", title.alias("title"), F.regexp_replace(card["description"], r" May.*$", "").alias("description"), card["date"].alias("date"), listed["description"].alias("listed"), listed["date"].alias("listed_date"), (whole & (F.col("doc_id") % 2 == 0)).alias("stray"))


# --- Python functions (no SQL side)


@query()
def html_whitelist(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", html.whitelist_html(F.col("html"), F.col("url")).alias("clean"), text.html_to_text(F.regexp_extract("html", H1, 1)).alias("title"))


@query()
def balanced_json_scan(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = html.balanced_json(F.concat(F.col("html"), F.lit('<script>x({"a": "}", "id": '), F.col("page_id").cast("string"), F.lit("})</script>")))
    return pages.select("page_id", F.length("html").alias("n"), found.alias("found"))


@query()
def html_components(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rows = pages.select("page_id", F.explode(html.html_tokens(F.col("html"))).alias("e"))
    return rows.select("page_id", "e.pos", "e.depth", "e.tag", "e.path", F.length("e.text").alias("chars"))


@query("""select event_type, min(event_id) as event_id from events group by event_type""")
def stream_dedup_batch(spark, sf_dir):
    from ..streaming import incremental

    return incremental.first_of_each(spark, f"{sf_dir}/events.parquet", "event_type", "event_id")
