"""Text functions over documents, pages, customers, parts and log lines built from events."""

from larkframe.functions import dates as dt
from larkframe.functions import text as tx
from larkframe.operators.quantiles import quantiles
from larkframe.plans.base import *
from larkframe.plans.aggregates import guarded_corr
from larkframe.sources.readers import parse_number

VOWELS = "[aeiou]"


@query("str_length", "SELECT doc_id, length(text) AS n FROM documents")
def str_length(t):
    return t.documents.select("doc_id", F.length("text").alias("n"))


@query("str_count", "SELECT doc_id, len(regexp_extract_all(text, '[aeiou]')) AS vowels, len(regexp_extract_all(text, '[A-Za-z]+')) AS words FROM documents")
def str_count(t):
    return t.documents.select("doc_id", tx.count(col("text"), VOWELS).alias("vowels"), tx.count(col("text"), "[A-Za-z]+").alias("words"))


@query("str_trim", r"""SELECT doc_id, md5(regexp_replace(text, '\A[ \t\n\r]+|[ \t\n\r]+\z', '', 'g')) AS trimmed,
md5(regexp_replace(regexp_replace('  ' || text || ' ', '\s+', ' ', 'g'), '\A\s+|\s+\z', '', 'g')) AS squished FROM documents""")
def str_trim(t):
    padded = F.concat(F.lit("  "), "text", F.lit(" "))
    return t.documents.select("doc_id", F.md5(tx.trim(col("text"))).alias("trimmed"), F.md5(tx.squish(padded)).alias("squished"))


@query("str_case", """SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), '-') AS title,
upper(p_name[1]) || lower(p_name[2:]) AS sentence FROM part""")
def str_case(t):
    hyphened = F.upper(F.regexp_replace("p_name", " ", "-"))
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"), tx.title(hyphened).alias("title"), tx.sentence(col("p_name")).alias("sentence"))


@query("str_replace", r"""SELECT c_custkey, regexp_replace(c_name, '0', 'o') AS first, regexp_replace(c_name, '0', 'o', 'g') AS every,
regexp_replace(c_name, '([A-Za-z]+)#([0-9]+)', '\2-\1') AS swapped FROM customer""")
def str_replace(t):
    n = col("c_name")
    return t.customer.select("c_custkey", tx.replace_first(n, "0", "o").alias("first"), F.regexp_replace(n, "0", "o").alias("every"),
                             F.regexp_replace(n, "([A-Za-z]+)#([0-9]+)", "$2-$1").alias("swapped"))


@query("str_remove", "SELECT c_custkey, regexp_replace(c_name, '0', '') AS first, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits FROM customer")
def str_remove(t):
    n = col("c_name")
    return t.customer.select("c_custkey", tx.replace_first(n, "0", "").alias("first"), F.regexp_replace(n, "[^0-9]", "").alias("digits"))


@query("str_detect", "SELECT doc_id, regexp_matches(text, '(?i)the') AS the, regexp_matches(text, '[0-9]{3}') AS digits FROM documents")
def str_detect(t):
    return t.documents.select("doc_id", col("text").rlike("(?i)the").alias("the"), col("text").rlike("[0-9]{3}").alias("digits"))


@query("str_extract", r"SELECT page_id, nullif(regexp_extract(url, 'page=[0-9]+'), '') AS page, nullif(regexp_extract(url, '^https?'), '') AS scheme FROM pages")
def str_extract(t):
    return t.pages.select("page_id", tx.extract(col("url"), "page=[0-9]+").alias("page"), tx.extract(col("url"), "^https?").alias("scheme"))


@query("str_lookbehind", r"SELECT page_id, nullif(regexp_extract(url, '://([^/?#]+)', 1), '') AS host, nullif(regexp_extract(url, '#(.+)$', 1), '') AS fragment FROM pages")
def str_lookbehind(t):
    return t.pages.select("page_id", tx.extract(col("url"), "(?<=://)[^/?#]+").alias("host"), tx.extract(col("url"), "(?<=#).+$").alias("fragment"))


@query("str_match", r"SELECT page_id, " + ", ".join(rf"nullif(regexp_extract(url, '^(https?)://([^/]+)/([a-z]{{2}})/(\d+)', {i}), '') AS g{i}" for i in range(1, 5)) + " FROM pages")
def str_match(t):
    p = r"^(https?)://([^/]+)/([a-z]{2})/(\d+)"
    return t.pages.select("page_id", *[tx.group(col("url"), p, i).alias(f"g{i}") for i in range(1, 5)])


@query("str_split_fixed", "SELECT p_partkey, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b, NULL::varchar AS c FROM part")
def str_split_fixed(t):
    p = F.split("p_name", " ", 3)
    return t.part.select("p_partkey", *[F.get(p, F.lit(i)).alias(n) for i, n in enumerate("abc")])


@query("str_c", """SELECT c_custkey, c_name || '-' || nullif(c_mktsegment, 'BUILDING') AS strict, c_name || ' ' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA') AS loose FROM customer""")
def str_c(t):
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select("c_custkey", F.concat("c_name", F.lit("-"), seg).alias("strict"), F.concat_ws(" ", "c_name", F.coalesce(seg, F.lit("NA"))).alias("loose"))


@query("str_sub", "SELECT p_partkey, substr(p_brand, 1, 3) AS a, substr(p_brand, -2) AS b FROM part")
def str_sub(t):
    return t.part.select("p_partkey", F.substring("p_brand", 1, 3).alias("a"), F.substring("p_brand", -2, 2).alias("b"))


@query("str_glue", "SELECT p_partkey, p_name || ' (' || p_brand || ') costs ' || printf('%.2f', p_retailprice) AS line FROM part")
def str_glue(t):
    return t.part.select("p_partkey", F.format_string("%s (%s) costs %.2f", "p_name", "p_brand", "p_retailprice").alias("line"))


@query("sprintf_pad", "SELECT 'TICK-' || lpad(o_orderkey::varchar, 8, '0') AS ticket, o_custkey FROM orders")
def sprintf_pad(t):
    return t.orders.select(F.format_string("TICK-%08d", "o_orderkey").alias("ticket"), "o_custkey")


@query("parse_number", "SELECT o_orderkey, o_totalprice AS price FROM orders")
def parse_number_(t):
    text = F.concat(F.lit("USD $"), F.format_number("o_totalprice", 2), F.lit(" net"))
    return t.orders.select("o_orderkey", parse_number(text).alias("price"))


def emails(t) -> DataFrame:
    """E-mail addresses in good and bad spellings."""
    k, base = col("c_custkey") % 5, F.concat(F.lower("c_mktsegment"), F.lit("."), col("c_custkey").cast("string"))
    e = (F.when(k == 0, F.concat(base, F.lit("@mail.example.com"))).when(k == 1, F.concat(base, F.lit("@example.org")))
         .when(k == 2, F.concat(base, F.lit("@example"))).when(k == 3, F.concat(base, F.lit("..x@example.net"))).otherwise(F.concat(base, F.lit(".example.com"))))
    return t.customer.select("c_custkey", e.alias("email"))


EMAILS_SQL = """e AS (SELECT c_custkey, lower(c_mktsegment) || '.' || c_custkey || CASE c_custkey % 5 WHEN 0 THEN '@mail.example.com' WHEN 1 THEN '@example.org'
WHEN 2 THEN '@example' WHEN 3 THEN '..x@example.net' ELSE '.example.com' END AS email FROM customer)"""


@query("email_parse", rf"""WITH {EMAILS_SQL} SELECT c_custkey, regexp_extract(email, '^[^@]+') AS username, nullif(regexp_extract(email, '@(.+)$', 1), '') AS domain,
regexp_extract(email, '[^.]+$') AS tld, regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}$') AND NOT contains(email, '..') AS valid FROM e""")
def email_parse(t):
    return emails(t).select("c_custkey", *[c.alias(n) for n, c in tx.email_parts(col("email")).items()])


@query("phone_normalise", """SELECT c_custkey, '(' || substr(d, 1, 3) || ') ' || substr(d, 4, 3) || '-' || substr(d, 7, 4) AS phone FROM (
SELECT c_custkey, lpad((2000000000 + c_custkey * 7919)::varchar, 10, '0') AS d FROM customer)""")
def phone_normalise(t):
    d = (F.lit(2000000000) + col("c_custkey") * 7919).cast("string")
    a, b, c = F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4)
    k = col("c_custkey") % 4
    raw = (F.when(k == 0, F.concat(a, F.lit("-"), b, F.lit("-"), c)).when(k == 1, F.concat(F.lit("("), a, F.lit(") "), b, F.lit("-"), c))
           .when(k == 2, F.concat(F.lit("+1 "), a, F.lit("."), b, F.lit("."), c)).otherwise(d))
    return t.customer.select("c_custkey", tx.phone(raw).alias("phone"))


@query("name_split", """SELECT c_custkey, 'Nr' || c_custkey || ' ' || c_mktsegment[1] || lower(c_mktsegment[2:]) AS display, 'nr' || c_custkey || '.' || lower(c_mktsegment) AS mail FROM customer""")
def name_split(t):
    d = t.customer.select("c_custkey", F.concat(tx.title(col("c_mktsegment")), F.lit(",  Nr"), col("c_custkey").cast("string")).alias("n"))
    p = F.split("n", ",")
    last, first = F.trim(F.get(p, F.lit(0))), F.trim(F.get(p, F.lit(1)))
    return d.select("c_custkey", F.concat_ws(" ", first, last).alias("display"), F.lower(F.concat_ws(".", first, last)).alias("mail"))


@query("sku_build", "SELECT p_partkey, upper(substr(p_name, 1, 3)) || '-' || regexp_extract(p_brand, '[0-9]+') || '-' || (1990 + p_size) AS sku FROM part")
def sku_build(t):
    return t.part.select("p_partkey", F.concat_ws("-", F.upper(F.substring("p_name", 1, 3)), tx.extract(col("p_brand"), "[0-9]+"), (1990 + col("p_size")).cast("string")).alias("sku"))


@query("product_clean", """SELECT p_partkey, p_brand AS brand, CASE WHEN p_size < 10 THEN NULL ELSE p_size * 8 END AS storage_gb, p_size AS ram_gb,
CASE WHEN regexp_matches(p_name, 'red|blue|green|black|white') THEN regexp_extract(p_name, 'red|blue|green|black|white') END AS colour FROM part""")
def product_clean(t):
    """Brand, storage, memory and colour from free text with varying spelling."""
    storage = F.when(col("p_size") >= 10, F.concat((col("p_size") * 8).cast("string"), F.when(col("p_size") % 2 == 0, "GB").otherwise(" gb"))).otherwise("")
    raw = F.concat_ws("  ", F.upper("p_brand"), storage, F.concat(col("p_size").cast("string"), F.lit("GB RAM")), F.upper("p_name"))
    x = tx.squish(F.lower(raw))
    return t.part.select("p_partkey", tx.title(tx.extract(x, r"brand#\d+")).alias("brand"), tx.group(x, r"(\d+) ?gb(?! ram)").try_cast("int").alias("storage_gb"),
                         tx.group(x, r"(\d+) ?gb ram").try_cast("int").alias("ram_gb"), tx.extract(x, "red|blue|green|black|white").alias("colour"))


def log_lines(t) -> DataFrame:
    level = F.when(col("event_type") == "error", "ERROR").when(col("value") > 25, "WARN").otherwise("INFO")
    ip = F.concat_ws(".", F.lit("10"), (col("user_id") % 200).cast("string"), (col("event_id") % 250).cast("string"), F.lit("7"))
    msg = F.when(col("value") > 15, F.format_string("query took %.2f ms user=%d", "value", "user_id")).otherwise(
        F.concat(F.lit("request from "), ip, F.lit(" ok")))
    line = F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] "), level, F.lit(" ["), "event_type", F.lit("]: "), msg)
    return t.events.select("event_id", line.alias("line"))


LEVEL_SQL = "CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value > 25 THEN 'WARN' ELSE 'INFO' END"


@query("log_parse", f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, {LEVEL_SQL} AS level, event_type AS service,
CASE WHEN value > 15 THEN user_id::varchar END AS "user", CASE WHEN NOT value > 15 THEN '10.' || (user_id % 200) || '.' || (event_id % 250) || '.7' END AS ip,
CASE WHEN value > 15 THEN round(value, 2) END AS duration FROM events""")
def log_parse(t):
    f = tx.log_fields(col("line"))
    f["at"] = F.date_format(f["at"], "yyyy-MM-dd HH:mm:ss")
    f.pop("message")
    return log_lines(t).select("event_id", *[c.alias(n) for n, c in f.items()])


@query("log_summary", f"""SELECT event_type AS service, {LEVEL_SQL} AS level, hour(ts)::int AS hour, count(*) AS n, round(avg(({LEVEL_SQL} = 'ERROR')::int), 6) AS error_share,
sum(CASE WHEN value > 15 THEN round(value * 100)::bigint END) / (100::double * count(CASE WHEN value > 15 THEN 1 END)) AS mean_ms FROM events GROUP BY ALL""")
def log_summary(t):
    d = log_lines(t).select(*[c.alias(n) for n, c in tx.log_fields(col("line")).items()])
    return d.groupBy("service", "level", F.hour("at").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), r(F.avg((col("level") == "ERROR").cast("double"))).alias("error_share"), F.try_divide(F.sum(F.round(col("duration") * 100).cast("long")), 100.0 * F.count("duration")).alias("mean_ms"))


# Kinds of our own tickets, told by how their subjects begin or end; what no rule fits is a question.
KINDS = {"fault": r"E-\d+$", "money back": "^Refund", "account": "^Password"}


def tickets(t) -> DataFrame:
    """Support tickets made from events: subject, priority, times."""
    subject = (F.when(col("event_type") == "error", F.concat(F.lit("App Error E-"), (col("event_id") % 1000).cast("string")))
               .when(col("event_type") == "click", F.lit("Refund request")).when(col("event_type") == "view", F.lit("Password help"))
               .otherwise(F.concat(F.lit("Question on "), "event_type")))
    created = col("ts").cast("timestamp")
    hours = F.round(col("value") * 60).cast("int")
    return t.events.select(
        "event_id", subject.alias("subject"), created.alias("created"), F.when(col("value") > 25, "High").when(col("value") > 10, "Medium").otherwise("Low").alias("priority"),
        F.concat(F.lit("u"), col("user_id").cast("string"), F.lit("@"), F.lower("event_type"), F.lit(".example.com")).alias("email"),
        F.when(col("event_id") % 7 != 0, F.timestamp_add("MINUTE", hours, created)).alias("resolved"))


def classified(subject: Column, kinds: dict[str, str], rest: str) -> Column:
    """Name of the first rule whose pattern the text has, else ``rest``."""
    return F.coalesce(*[F.when(subject.rlike(p), name) for name, p in kinds.items()], F.lit(rest))


def enriched(t) -> DataFrame:
    hours = (F.unix_micros("resolved") - F.unix_micros("created")) / 3.6e9
    return tickets(t).select(
        "*", classified(col("subject"), KINDS, "question").alias("issue"), tx.extract(col("subject"), r"E-\d+").alias("code"), tx.group(col("email"), "@(.+)$").alias("domain"),
        F.hour("created").alias("hour"), dt.is_weekend(col("created")).alias("weekend"), hours.alias("hours"))


TICKETS_SQL = """tk AS (SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'fault' WHEN 'click' THEN 'money back' WHEN 'view' THEN 'account' ELSE 'question' END AS issue,
CASE WHEN event_type = 'error' THEN 'E-' || (event_id % 1000) END AS code, event_type || '.example.com' AS domain, hour(ts)::int AS hour, dayofweek(ts) IN (0, 6) AS weekend,
CASE WHEN value > 25 THEN 'High' WHEN value > 10 THEN 'Medium' ELSE 'Low' END AS priority, CASE WHEN event_id % 7 <> 0 THEN round(value * 60) / 60 END AS hours FROM events)"""


@query("ticket_enrich", f"WITH {TICKETS_SQL} SELECT event_id, issue, code, domain, hour, weekend, priority, round(hours, 4) AS hours FROM tk")
def ticket_enrich(t):
    return enriched(t).select("event_id", "issue", "code", "domain", "hour", "weekend", "priority", r(col("hours"), 4).alias("hours"))


@query("ticket_summary", f"WITH {TICKETS_SQL} SELECT issue, priority, count(*) AS n, round(avg((hours IS NOT NULL)::int) * 100, 4) AS resolved, round(avg(hours), 4) AS mean, round(median(hours), 4) AS med FROM tk GROUP BY 1, 2")
def ticket_summary(t):
    d = enriched(t)
    g = d.groupBy("issue", "priority").agg(F.count(F.lit(1)).alias("n"), r(F.avg(col("hours").isNotNull().cast("double")) * 100, 4).alias("resolved"), r(F.avg("hours"), 4).alias("mean"))
    med = quantiles(d, ["issue", "priority"], "hours", {"med": 0.5})
    return match_join(g, med, ["issue", "priority"], "left").withColumn("med", r(col("med"), 4))


@query("ticket_volume", f"""WITH {TICKETS_SQL} SELECT 'day' AS series, cast(ts::date AS varchar) AS a, '' AS b, count(*) AS n, NULL::double AS share FROM tk GROUP BY 2
UNION ALL SELECT 'hour', hour::varchar, weekend::varchar, count(*), NULL FROM tk GROUP BY 2, 3
UNION ALL SELECT 'type', issue, priority, count(*), round(count(*) / sum(count(*)) OVER (PARTITION BY issue), 6) FROM tk GROUP BY 2, 3""")
def ticket_volume(t):
    d = enriched(t)
    none = F.lit(None).cast("double")

    def series(name, a, b):
        return d.groupBy(a.cast("string").alias("a"), b.cast("string").alias("b")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("series"), "a", "b", "n")

    kinds = share_of(d.select(col("issue").alias("a"), col("priority").alias("b")), ["a", "b"], ["a"], "share").withColumn("share", r(col("share")))
    return (series("day", F.to_date("created"), F.lit("")).withColumn("share", none)
            .unionByName(series("hour", col("hour"), col("weekend")).withColumn("share", none))
            .unionByName(kinds.withColumn("series", F.lit("type"))))


def reviews(t) -> DataFrame:
    d = t.documents.join(t.labels, "doc_id")
    x = col("text")
    good, bad = tx.count(x, "(?i)the|and"), tx.count(x, "(?i)haha|!")
    return d.select("doc_id", "lang", "quality", F.length(x).alias("chars"), tx.count(x, r"\S+").alias("words"), tx.count(x, r"[.!?]+").alias("sentences"),
                    x.rlike(r"\d").alias("has_digit"), x.rlike(r"[!?]{2,}").alias("excited"), (good - bad).alias("score"),
                    F.when(good > bad, "positive").when(good < bad, "negative").otherwise("neutral").alias("mood"))


REVIEWS_SQL = r"""rv0 AS (SELECT doc_id, lang, quality, text, len(regexp_extract_all(text, '(?i)the|and'))::int AS good, len(regexp_extract_all(text, '(?i)haha|!'))::int AS bad FROM documents JOIN labels USING (doc_id)),
rv AS (SELECT doc_id, lang, quality, length(text)::int AS chars, len(regexp_extract_all(text, '\S+'))::int AS words, len(regexp_extract_all(text, '[.!?]+'))::int AS sentences,
regexp_matches(text, '\d') AS has_digit, regexp_matches(text, '[!?]{2,}') AS excited, good - bad AS score, CASE WHEN good > bad THEN 'positive' WHEN good < bad THEN 'negative' ELSE 'neutral' END AS mood FROM rv0)"""


@query("review_features", f"WITH {REVIEWS_SQL} SELECT * FROM rv")
def review_features(t):
    return reviews(t)


@query("review_summary", f"""WITH {REVIEWS_SQL} SELECT 'cor' AS kind, 'words' AS name, round(corr(words, quality), 6) AS v, count(*) AS n FROM rv UNION ALL SELECT 'cor', 'score', round(corr(score, quality), 6), count(*) FROM rv
UNION ALL SELECT 'mean', mood, round(avg(quality), 6), count(*) FROM rv GROUP BY 2""")
def review_summary(t):
    d = reviews(t)
    n = F.count(F.lit(1)).alias("n")
    cors = [d.agg(r(guarded_corr(c, "quality")).alias("v"), n).select(F.lit("cor").alias("kind"), F.lit(c).alias("name"), "v", "n") for c in ("words", "score")]
    mood = d.groupBy(col("mood").alias("name")).agg(r(F.avg("quality")).alias("v"), n).withColumn("kind", F.lit("mean"))
    return cors[0].unionByName(cors[1]).unionByName(mood)


@query("multi_pattern_date", "SELECT o_orderkey, cast(o_orderdate::date AS varchar) AS d FROM orders")
def multi_pattern_date(t):
    """Dates written in four spellings, read by the format that fits the shape."""
    k, d = col("o_orderkey") % 4, col("o_orderdate")
    x = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MM/dd/yyyy")).when(k == 2, F.date_format(d, "dd.MM.yyyy")).otherwise(F.date_format(d, "MMM d, yyyy")))
    shapes = {r"^\d{4}-": "yyyy-MM-dd", r"^\d{2}/": "MM/dd/yyyy", r"^\d{2}\.": "dd.MM.yyyy", "^[A-Z]": "MMM d, yyyy"}
    out = F.coalesce(*[F.when(col("x").rlike(p), F.try_to_timestamp(col("x"), F.lit(f)).cast("date")) for p, f in shapes.items()])
    return t.orders.select("o_orderkey", x.alias("x")).select("o_orderkey", out.cast("string").alias("d"))
