"""Line dedup by a log-template tree, with native DataFrame operations.

Lines become templates by fixed-depth parsing: a token with a digit is a variable field
(``<*>``); the tree branches by the number of tokens and by the ``LEAD`` leading tokens.
In a leaf that several different lines reach, each further position has a dominant
token; a line that agrees with at least ``AGREE`` percent of the leaf's dominant tokens
(leading tokens included) takes the leaf's template, in which the other positions are
variable.  Any other line is its own template.  Templates found in ``MIN_TEXTS`` or more
different texts are dropped from all of them.  A line of fewer than ``MIN_TOKENS`` tokens
has too few for a template besides its own masked line, and short lines recur by chance:
it is dropped where that line is found in ``SHORT_TEXTS`` or more different texts.  A line
of more than ``LONG_TOKENS`` tokens does not recur by chance: it is also dropped where its
masked line is found in ``LONG_TEXTS`` or more different texts.  Blank lines stay.

Copies of a document count as one text: they are a matter for document dedup, and their
lines do not become boilerplate by them.  A line is parsed once; the parsed lines are a
table in the shared folder whose columns later steps read as they need, removed once the
lines to drop are known.  Texts are told apart by hash and length.  Distinct texts are
counted after partial aggregation, so a line in a third of all texts is a few rows for each
task.

Defined results: a null text stays null, with no lines; an empty text has one empty line,
which stays; lines are cut at ``\\n`` and tokens at ASCII white space; what is kept is
kept byte for byte; an empty table gives no rows.  A column named like an output gives
way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, kept, small, unkept, written

LEAD = 3
AGREE = 60
MIN_TEXTS = 3
MIN_TOKENS = 4
SHORT_TEXTS = 10
LONG_TOKENS = 50
LONG_TEXTS = 2
FIELD = "<*>"


def _masked(line: Column) -> Column:
    """The line with single spaces between tokens and variable fields masked."""
    spaced = F.trim(F.regexp_replace(line, r"[\x09-\x0D\x20]+", " "))
    fields = F.regexp_replace(spaced, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)
    return F.when(line.rlike(r"[0-9\x09-\x0D]|  "), fields).otherwise(F.trim(line))


def parsed_lines(texts: DataFrame, text_col: str) -> DataFrame:
    """key and bytes (of the text), pos, size (tokens), leaf, line (hashes) and masked of every line."""
    keyed = texts.where(F.col(text_col).isNotNull()).select(F.xxhash64(text_col).alias("key"), F.octet_length(text_col).alias("bytes"), F.col(text_col).alias("text"))
    lines = keyed.select("key", "bytes", F.posexplode(F.split("text", "\n")).alias("pos", "raw")).select("key", "bytes", "pos", _masked(F.col("raw")).alias("masked"))
    size = F.octet_length("masked") - F.octet_length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    lines = lines.withColumn("size", size)
    return lines.select("key", "bytes", "pos", "size", F.xxhash64("size", F.substring_index("masked", " ", LEAD)).alias("leaf"), F.xxhash64("masked").alias("line"), "masked")


def _generalised(lines: DataFrame, distinct: DataFrame, agree: int, min_texts: int) -> DataFrame:
    """line, leaf of the lines that take their leaf's template."""
    leaves = distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum("texts").alias("texts")).where((F.col("n") > 1) & (F.col("texts") >= min_texts)).select(F.col("leaf").alias("l_leaf"))
    leaves = kept(leaves)
    n = leaves.count()
    shared = lines.select("leaf", "line", "masked").join(small(leaves, n, 8), F.col("leaf") == F.col("l_leaf"), "left_semi")
    shared = kept(shared.groupBy("line").agg(F.first("leaf").alias("leaf"), F.first("masked").alias("masked")))
    tokens = shared.select("leaf", F.posexplode(F.split("masked", " ")).alias("at", "token")).groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("n"))
    best = tokens.groupBy("leaf", "at").agg(F.min(F.struct((-F.col("n")).alias("less"), "token"))["token"].alias("token"))
    dominant = kept(best.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "token"))), lambda x: x["token"]).alias("dominant")))
    same = F.size(F.filter(F.zip_with(F.split("masked", " "), F.col("dominant"), lambda a, b: a == b), lambda x: x))
    return shared.join(_counted(dominant, F.octet_length(F.array_join("dominant", "")) + 24 * F.size("dominant")), "leaf").where(same * 100 >= F.size("dominant") * agree).select(F.col("line").alias("g_line"), F.col("leaf").alias("g_leaf"))


def _counted(df: DataFrame, row_bytes: Column) -> DataFrame:
    """A kept table, marked for broadcast if the bytes of its rows were counted and fit."""
    return small(df, int(df.agg(F.sum(row_bytes + 32)).first()[0] or 0), 1)


def recurring_lines(texts: DataFrame, text_col: str, agree: int = AGREE, min_texts: int = MIN_TEXTS, short_texts: int = SHORT_TEXTS, long_texts: int = LONG_TEXTS) -> DataFrame:
    """key, bytes, positions: the lines (from 0, sorted) of each text that are to be dropped, as a table."""
    parsed, path = written(parsed_lines(texts, text_col), "lines")
    lines = parsed.where(F.col("size") >= MIN_TOKENS)
    once = lines.groupBy("leaf", "line", "size", "key", "bytes").agg(F.count(F.lit(1)).alias("n"))
    distinct = kept(once.groupBy("leaf", "line", "size").agg(F.count(F.lit(1)).alias("texts")))
    general = kept(_generalised(lines, distinct, agree, min_texts))
    n = general.count()
    # a leaf's template is told from a line by its sign bit, kept apart by the second column
    template = lambda df: df.join(small(general, n, 16), F.col("line") == F.col("g_line"), "left").withColumns({"general": F.col("g_line").isNotNull(), "template": F.coalesce("g_leaf", "line")})
    alone = distinct.join(small(general, n, 16), F.col("line") == F.col("g_line"), "left_anti").where(F.col("texts") >= min_texts).select(F.col("line").alias("r_template"), F.lit(False).alias("r_general"))
    grouped = lines.select("line", "key", "bytes").join(small(general, n, 16), F.col("line") == F.col("g_line")).select("g_leaf", "key", "bytes").distinct().groupBy("g_leaf").count()
    grouped = grouped.where(F.col("count") >= min_texts).select(F.col("g_leaf").alias("r_template"), F.lit(True).alias("r_general"))
    recurring = alone.unionAll(grouped)
    # a short line is alone in its leaf but for masked copies
    short = parsed.where((F.col("size") < MIN_TOKENS) & (F.col("masked") != ""))
    often = short.select("line", "key", "bytes").distinct().groupBy("line").count().where(F.col("count") >= short_texts)
    recurring = kept(recurring.unionAll(often.select("line", F.lit(False))))
    named = template(parsed.where(F.col("masked") != "").select("key", "bytes", "pos", "line"))
    gone = named.join(small(recurring, recurring.count(), 16), (F.col("template") == F.col("r_template")) & (F.col("general") == F.col("r_general")), "left_semi").select("key", "bytes", "pos")
    passages = kept(distinct.where((F.col("size") > LONG_TOKENS) & (F.col("texts") >= long_texts)).select(F.col("line").alias("p_line")))
    long = parsed.where(F.col("size") > LONG_TOKENS).join(small(passages, passages.count(), 8), F.col("line") == F.col("p_line"), "left_semi")
    gone = gone.unionAll(long.select("key", "bytes", "pos"))
    found, _ = written(gone.groupBy("key", "bytes").agg(F.sort_array(F.collect_set("pos")).alias("positions")), "gone")
    unkept(passages, recurring, general, distinct)
    dropped(texts.sparkSession, path)
    return found


def dedup_lines(documents: DataFrame, text_col: str = "text", agree: int = AGREE, min_texts: int = MIN_TEXTS, short_texts: int = SHORT_TEXTS, long_texts: int = LONG_TEXTS) -> DataFrame:
    """All columns, the text without its recurring lines, with ``n_lines`` and ``n_dropped``."""
    columns = [c for c in documents.columns if c not in ("n_lines", "n_dropped") or c == text_col]
    own = documents.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)])
    text = f"__c{columns.index(text_col)}"
    gone = recurring_lines(own.select(text), text, agree, min_texts, short_texts, long_texts).withColumnsRenamed({"key": "__key", "bytes": "__bytes", "positions": "__gone"})
    same = (F.xxhash64(text) == F.col("__key")) & (F.octet_length(text) == F.col("__bytes"))
    joined = own.join(_counted(gone, 4 * F.size("__gone")), same, "left")
    lines = F.split(F.col(text), "\n")
    left = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n"))
    shown = [left.alias(c) if c == text_col else F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)]
    count = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    return joined.select(*shown, count.alias("n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"))


#: DuckDB SQL of dedup_lines over documents with the defaults; hashes give way to the strings themselves.
LINES_SQL = rf"""
with texts as (select distinct text from documents where text is not null),
raw as (select text, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from texts),
spaced as (select text, pos, trim(regexp_replace(l, '[\x09-\x0D\x20]+', ' ', 'g'), ' ') as l from raw),
tokens as (select text, pos, list_transform(string_split(l, ' '), lambda t: case when regexp_matches(t, '[0-9]') then '{FIELD}' else t end) as ts from spaced),
lines as (select text, pos, ts, len(ts) as size, ts[1:{LEAD}] as lead from tokens where len(ts) >= {MIN_TOKENS}),
uniq as (select ts, size, lead, count(distinct text) as texts from lines group by all),
leaves as (select size, lead from uniq group by all having count(*) > 1 and sum(texts) >= {MIN_TEXTS}),
shared as (select u.* from uniq u join leaves using (size, lead)),
positions as (select size, lead, unnest(ts) as token, generate_subscripts(ts, 1) as i from shared),
counted as (select size, lead, i, token, count(*) as n from positions group by all),
ranked as (select *, row_number() over (partition by size, lead, i order by n desc, token) as nth from counted),
dominant as (select size, lead, i, token from ranked where nth = 1),
agreeing as (select s.ts, s.size, s.lead, sum(case when s.ts[d.i] = d.token then 1 else 0 end) as same from shared s join dominant d using (size, lead) group by all),
general as (select ts, size, lead from agreeing where same * 100 >= size * {AGREE}),
templated as (select l.text, l.pos, l.ts, l.size, l.lead, g.ts is not null as general, case when g.ts is null then l.ts end as own from lines l left join general g on l.ts = g.ts),
recurring as (select general, size, lead, own from templated group by all having count(distinct text) >= {MIN_TEXTS}),
gone as (select t.text, t.pos from templated t join recurring r on t.general = r.general and t.size = r.size and t.lead = r.lead and t.own is not distinct from r.own),
short as (select text, pos, ts from tokens where len(ts) < {MIN_TOKENS} and ts <> ['']),
often as (select ts from short group by ts having count(distinct text) >= {SHORT_TEXTS}),
passages as (select ts from uniq where size > {LONG_TOKENS} and texts >= {LONG_TEXTS}),
gone_too as (select text, pos from gone union all select s.text, s.pos from short s join often using (ts)
  union select l.text, l.pos from lines l join passages using (ts)),
left_over as (select r.text, coalesce(string_agg(case when g.pos is null then r.l end, chr(10) order by r.pos), '') as kept, count(g.pos) as n_dropped, count(*) as n_lines
  from raw r left join gone_too g on r.text = g.text and r.pos = g.pos group by r.text)
select d.doc_id, k.kept as text, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_dropped, 0) as n_dropped from documents d left join left_over k on d.text = k.text
"""
