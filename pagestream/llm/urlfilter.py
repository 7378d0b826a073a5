"""URL filters: rules first, then logistic regression on hashed character n-grams.

Everything runs on DataFrame functions.  The features of a URL are the character n-grams
of its host and of its path (marked apart), hashed by crc32 into ``BUCKETS`` signed by
count.  The model is fitted by full-batch gradient descent, itself one DataFrame
expression over a small labelled table (a built-in one, or a table of the caller with
columns url and label); its weights become a constant array in the scoring
expression, so scoring is one narrow pass.

Defined results: a null url or one without ``://`` has empty host and path and the
method's verdict for no features; user names and ports count as part of the host; repeated
rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, unkept

BUCKETS = 4096
HOST_GRAMS, PATH_GRAMS = (3, 4), (3,)
ROUNDS = 40
STEP = 4.0
MOMENTUM = 0.9
DECAY = 0.0002

#: Fixed values: (action, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

# The words that the built-in labelled hosts are made of.
BLOCKED_WORDS = "casino poker slots bets betting bonus jackpot adult xxx porn sexcam escort pills viagra pharma cheap replica spam farm ads adserver track tracker click popup banner win winner prize free crack keygen warez torrent loan payday malware phishing".split()
ALLOWED_WORDS = "university news museum library science history garden music health school recipes travel weather journal archive wiki docs blog books film nature city hospital sports forum research culture market energy water music theatre gallery review daily".split()
SYLLABLES = "an en in on er re th ti st nd ou ea ing ha he sh or es".split()
PREFIXES = ("", "www.", "blog.", "m.", "news.")
ENDINGS = ("example.com", "example.org", "example.net")
PATHS = ("/en/{n}", "/de/{n}.html", "/fr/{n}/", "/es/{n}?utm_source=feed", "/en/{n}#top", "/{word}/{n}?page=2&ref=x")


def _built_in() -> list[tuple[str, int]]:
    """(url, 1 to block) of the built-in table: pairs of words of a class, alike in prefix, ending and path."""
    pairs = lambda words: [(a, words[(7 * i + 3) % len(words)]) for i, a in enumerate(words)]
    bad = [f"{a}-{b}" for a, b in pairs(BLOCKED_WORDS)] + [f"{b}{a}" for a, b in pairs(BLOCKED_WORDS)] + [f"{a}-x" for a in BLOCKED_WORDS]
    n = len(SYLLABLES)
    made = ["".join(SYLLABLES[(i * k + k) % n] for k in range(1, 3 + i % 2)) for i in range(2 * n)] + list(SYLLABLES)
    good = [f"{a}-{b}" for a, b in pairs(ALLOWED_WORDS)] + ALLOWED_WORDS + made
    out = []
    for label, hosts in ((1, bad), (0, good)):
        for i, h in enumerate(hosts):
            path = PATHS[i % len(PATHS)].format(n=101 * (i + 3), word=hosts[(i + 5) % len(hosts)])
            out.append((f"http{'s' * (i % 2)}://{PREFIXES[i % len(PREFIXES)]}{h}.{ENDINGS[(i // 2) % len(ENDINGS)]}{path}", label))
    return out


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty where there is none."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits the host or a parent of it and the start of the path; else nulls."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, action = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(act)).otherwise(action)
    return text, action


def gram_buckets(host: Column, path: Column) -> Column:
    """Hashed n-grams of ``^host$`` and of the path, each with a mark of its part."""
    def grams(mark: str, text: Column, n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        hashed = lambda i: F.crc32(F.concat(F.lit(mark), F.substring(text, i, F.lit(n))).cast("binary"))
        return F.transform(starts, lambda i: F.pmod(hashed(i), F.lit(BUCKETS)).cast("int"))

    whole = F.concat(F.lit("^"), host, F.lit("$"))
    return F.concat(*[grams("h", whole, n) for n in HOST_GRAMS], *[grams("p", path, n) for n in PATH_GRAMS])


def _prepared(urls: DataFrame, url_col: str) -> DataFrame:
    named = urls.withColumn("__url", F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")))
    host, path = host_path(F.col("__url"))
    return named.withColumns({"__host": host, "__path": path})


def training_table(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: url, label (1: block)."""
    values = ", ".join(f"('{u}', {y})" for u, y in _built_in())
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)")


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label", rounds: int = ROUNDS) -> list[float]:
    """Weights of the buckets; ``labelled`` is small (one task gathers it and goes all rounds).

    Each round adds the gradient of the mean logistic loss by bucket, with Nesterov's
    momentum; the rounds are one aggregate expression over the gathered rows, so fitting is
    one job.  There is no intercept, so a URL without features has probability 0.5 and is
    allowed.
    """
    base = _prepared(labelled.where(F.col(label_col).isNotNull()), url_col)
    known = base.select(F.struct(F.col(label_col).cast("double").alias("y"), gram_buckets(F.col("__host"), F.col("__path")).alias("g")).alias("r"))
    rows = kept(known.agg(F.sort_array(F.collect_list("r")).alias("rows")).withColumn("one", F.lit(1)))
    # the rows that hold each bucket, as often as they do
    held = rows.select(F.posexplode("rows").alias("i", "r")).select("i", F.explode("r.g").alias("k")).groupBy("k").agg(F.sort_array(F.collect_list("i")).alias("i"))
    held = held.agg(F.map_from_entries(F.collect_list(F.struct("k", "i"))).alias("held")).withColumn("one", F.lit(1))
    buckets = F.sequence(F.lit(0), F.lit(BUCKETS - 1))
    both = rows.join(held, "one").withColumn("holders", F.transform(buckets, lambda k: F.coalesce(F.try_element_at("held", k), F.array().cast("array<int>"))))

    def let(value: Column, body: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def one_round(state: Column, _: Column) -> Column:
        w, ahead, n = state["w"], state["ahead"], F.greatest(F.size("rows"), F.lit(1))

        def error(r: Column) -> Column:
            scale = 1 / F.greatest(F.sqrt(F.size(r["g"]).cast("double")), F.lit(1.0))
            total = F.aggregate(r["g"], F.lit(0.0), lambda acc, k: acc + F.get(ahead, k))
            return (r["y"] - 1 / (1 + F.exp(-total * scale))) * scale

        def moved(errors: Column) -> Column:
            gradient = lambda held_by: F.aggregate(held_by, F.lit(0.0), lambda acc, i: acc + F.get(errors, i)) / n
            new = F.transform("holders", lambda held_by, k: F.get(ahead, k) + STEP * (gradient(held_by) - DECAY * F.get(ahead, k)))
            return let(new, lambda x: F.struct(x.alias("w"), F.transform(x, lambda v, k: v + MOMENTUM * (v - F.get(w, k))).alias("ahead")))

        return let(F.transform("rows", error), moved)

    zero = F.array_repeat(F.lit(0.0), BUCKETS)
    done = both.select(F.aggregate(F.sequence(F.lit(1), F.lit(max(rounds, 1))), F.struct(zero.alias("w"), zero.alias("ahead")), one_round)["w"].alias("w")).first()
    unkept(rows)
    return list(done["w"]) if rounds > 0 else [0.0] * BUCKETS


def _probability(grams: Column, w: Sequence[float]) -> Column:
    table = F.from_json(F.lit(json.dumps([float(x) for x in w])), "array<double>")  # folded into one constant
    total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(table, g))
    score = total / F.greatest(F.sqrt(F.size(grams).cast("double")), F.lit(1.0))
    return 1 / (1 + F.exp(-score))


def judge_urls(pages: DataFrame, weights: Sequence[float], keep: Sequence[str], url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``keep`` columns with host, path, rule, probability (of block) and verdict (allow or block)."""
    base = _prepared(pages, url_col)
    rule, action = rule_for(F.col("__host"), F.col("__path"), rules)
    scored = base.select(*[F.col(f"`{c}`") for c in keep], F.col("__host").alias("host"), F.col("__path").alias("path"), rule.alias("rule"), action.alias("__action"), _probability(gram_buckets(F.col("__host"), F.col("__path")), weights).alias("probability"))
    return scored.withColumn("verdict", F.coalesce("__action", F.when(F.col("probability") > 0.5, F.lit("block")).otherwise(F.lit("allow")))).drop("__action")
