"""URL filter: rules, and a character language-model ratio for the URLs that no rule decides.

Two smoothed variable-order Markov models give the probability of a URL's
characters, one learned from accepted URLs and one from rejected ones (those
that the rules decide).  The probability of a character after up to ``ORDER``
characters blends all shorter contexts (Witten-Bell: a context that was
followed by T different characters in N places gives T / (N + T) to the next
shorter one).  A URL is allowed if the difference of the two log-likelihoods
per character reaches a threshold, which is calibrated on a fifth of the rule-decided URLs
that the models have not seen.  DataFrame expressions only.

Log ratios are rounded to ``SCALE``-ths and summed as integers, so the result
does not depend on the order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, table

ORDER = 4
SCALE = 1_000_000
#: a character before the first and after the last one; they occur in no URL
BEFORE, AFTER = "\x02", "\x03"
#: probability of a character without any context (order minus one)
UNIFORM = 1.0 / 256
#: bins of the ratio per character, for the threshold
BIN, MAX_BIN = 0.01, 1200

#: (host and path of the rule, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits the host (or a parent of it) and the path's start; null if none does."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def verdict_of(rule: Column, rules=RULES) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def _grams(df: DataFrame, url: str, *keep: str) -> DataFrame:
    """One row per character and the end: the character after its ORDER predecessors."""
    chars = F.filter(F.split(F.col(url), ""), lambda c: c != "")
    padded = F.concat(F.array(*[F.lit(BEFORE)] * ORDER), chars, F.array(F.lit(AFTER)))
    return df.withColumn("cs", padded).select(
        *keep, F.explode(F.transform(F.sequence(F.lit(1), F.size("cs") - ORDER),
                                     lambda i: F.array_join(F.slice(F.col("cs"), i, ORDER + 1), ""))).alias("g"))


def gram_scores(counts: DataFrame) -> DataFrame:
    """(g, score): rounded log ratio of a gram's last character after the others, from (g, a, r) counts.

    ``a`` and ``r`` count a gram in accepted and rejected URLs (zero where it only occurs in URLs to judge).
    """
    levels = {ORDER: counts}
    for k in range(ORDER - 1, -1, -1):  # grams of k + 1 characters
        levels[k] = (levels[k + 1].select(F.expr("substring(g, 2)").alias("g"), "a", "r")
                     .groupBy("g").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    shorter = None
    for k in range(ORDER + 1):
        context = Window.partitionBy(F.substring("g", 1, k)) if k else None
        if k:
            # a context's grams differ in one character, so a window holds no more rows than there are characters
            stats = [F.sum("a").over(context).alias("na"), F.sum("r").over(context).alias("nr"),
                     F.sum((F.col("a") > 0).cast("long")).over(context).alias("ta"), F.sum((F.col("r") > 0).cast("long")).over(context).alias("tr")]
            level = levels[k].select("g", "a", "r", *stats).withColumn("h", F.expr("substring(g, 2)"))
            level = level.join(shorter, F.col("h") == F.col("sg"))
        else:
            t = levels[0].agg(F.sum("a").alias("na"), F.sum("r").alias("nr"), F.sum((F.col("a") > 0).cast("long")).alias("ta"),
                              F.sum((F.col("r") > 0).cast("long")).alias("tr")).first()  # one row
            level = levels[0].select("g", "a", "r", *[F.lit(t[c] or 0).cast("long").alias(c) for c in ("na", "nr", "ta", "tr")])
            level = level.withColumn("pa", F.lit(UNIFORM)).withColumn("pr", F.lit(UNIFORM))
        blend = [F.when(F.col(n) + F.col(d) > 0, (F.col(c) + F.col(d) * F.col(p)) / (F.col(n) + F.col(d))).otherwise(F.col(p))
                 for n, d, c, p in (("na", "ta", "a", "pa"), ("nr", "tr", "r", "pr"))]
        shorter = level.select(F.col("g").alias("sg"), blend[0].alias("pa"), blend[1].alias("pr"))
    return shorter.select(F.col("sg").alias("g"), F.round((F.log("pa") - F.log("pr")) * SCALE).cast("long").alias("score"))


def threshold_bin(judged: DataFrame) -> int:
    """The bin from which on URLs are allowed: best sum of the two classes' hit rates, then closest to zero.

    ``judged`` has bin, verdict and number of the calibration URLs; the table of bins has a fixed size.
    """
    bins = {r["bin"]: (r["a"], r["r"]) for r in judged.groupBy("bin").agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("r")).collect()}
    accepted, rejected = sum(a for a, _ in bins.values()), sum(r for _, r in bins.values())
    if not accepted or not rejected:
        return 0
    best, below_a, below_r = [], 0, 0
    for b in range(-MAX_BIN, MAX_BIN + 2):
        # whole numbers, so that equal sums are equal
        best.append((-((accepted - below_a) * rejected + below_r * accepted), abs(b), b))
        a, r = bins.get(b, (0, 0))
        below_a, below_r = below_a + a, below_r + r
    return min(best)[2]


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id, url, host, path, rule, verdict, ratio) of every row.

    ``ratio`` is the log-likelihood ratio per character.  A null URL is judged
    like an empty one; repeated rows stay and count as often as they occur;
    without accepted or without rejected URLs the threshold is zero; an empty
    table gives no rows; extra columns are ignored.
    """
    scratch = Scratch(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumn("u", F.coalesce("url", F.lit(""))).withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("by_rule", verdict_of(F.col("rule"), rules))
    # a fifth of the URLs, by hash, is for calibration
    rows = rows.withColumn("calibrates", F.md5(F.col("u").cast("binary")).substr(1, 1).isin("0", "1", "2"))
    # a URL and its copies are one row from here on
    urls = rows.groupBy("u", "by_rule", "calibrates").agg(F.count("*").alias("n"))
    urls = scratch.put("urls", urls.withColumn("k1", F.xxhash64("u")).withColumn("k2", F.hash("u")))
    learns = F.when(~F.col("calibrates"), F.col("n")).otherwise(F.lit(0))
    seen = urls.withColumn("a", F.when(F.col("by_rule") == "allow", learns).otherwise(F.lit(0))).withColumn(
        "r", F.when(F.col("by_rule") == "block", learns).otherwise(F.lit(0)))
    counts = scratch.put("grams", _grams(seen, "u", "a", "r").groupBy("g").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    scores = scratch.put("scores", gram_scores(counts).withColumnRenamed("g", "sg"))
    # both sides are plain exchanges, so a gram that most URLs have is split between tasks
    sums = (_grams(urls, "u", "k1", "k2").join(scores, F.col("g") == F.col("sg"))
            .groupBy("k1", "k2").agg((F.sum("score") / F.count("*") / F.lit(float(SCALE))).alias("ratio")))
    ratios = scratch.put("ratios", sums.withColumn("bin", F.greatest(F.least(F.floor(F.col("ratio") / BIN), F.lit(MAX_BIN)), F.lit(-MAX_BIN)).cast("int"))
                         .withColumnRenamed("k1", "j1").withColumnRenamed("k2", "j2"))
    held = urls.filter("calibrates and by_rule is not null").join(ratios, (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2")))
    cut = threshold_bin(held.select("bin", F.col("by_rule").alias("verdict"), "n"))
    out = (rows.withColumn("k1", F.xxhash64("u")).withColumn("k2", F.hash("u"))
           .join(ratios, (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2"))))
    method = F.when(F.col("bin") >= cut, F.lit("allow")).otherwise(F.lit("block"))
    return out.select("id", "url", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "ratio")


def op1_urls(spark, sf_dir: str) -> DataFrame:
    out = filter_urls(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def _op1_sql() -> str:
    """The same computation in DuckDB."""
    rule = " ".join(
        f"WHEN (host = '{n}' OR ends_with(host, '.{n}')) AND starts_with(path, '/{rest}') THEN '{r}'"
        for r, _ in sorted(RULES, key=lambda x: (len(x[0]), x[0]), reverse=True) for n, _, rest in [r.partition("/")])
    verdict = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
    levels = [f"g{ORDER} AS (SELECT g, sum(a) AS a, sum(r) AS r FROM grams GROUP BY g)"]
    for k in range(ORDER - 1, -1, -1):
        levels.append(f"g{k} AS (SELECT substring(g, 2) AS g, sum(a) AS a, sum(r) AS r FROM g{k + 1} GROUP BY 1)")
    for k in range(ORDER + 1):
        over = f"(PARTITION BY substring(g, 1, {k}))" if k else "()"
        levels.append(f"c{k} AS (SELECT g, a, r, sum(a) OVER {over} AS na, sum(r) OVER {over} AS nr, "
                      f"count(*) FILTER (a > 0) OVER {over} AS ta, count(*) FILTER (r > 0) OVER {over} AS tr FROM g{k})")
        pa, pr, frm = ("s.pa", "s.pr", f"c{k} c JOIN p{k - 1} s ON s.g = substring(c.g, 2)") if k else (f"{UNIFORM}::DOUBLE", f"{UNIFORM}::DOUBLE", "c0 c")
        levels.append(f"p{k} AS (SELECT c.g, CASE WHEN na + ta > 0 THEN (a::DOUBLE + ta::DOUBLE * {pa}) / (na + ta)::DOUBLE ELSE {pa} END AS pa, "
                      f"CASE WHEN nr + tr > 0 THEN (r::DOUBLE + tr::DOUBLE * {pr}) / (nr + tr)::DOUBLE ELSE {pr} END AS pr FROM {frm})")
    return f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS u,
    translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{UPPER}', '{LOWER}') AS host, coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path FROM pages
), ruled AS (SELECT *, CASE {rule} END AS rule FROM parts),
rows AS (SELECT *, CASE rule {verdict} END AS by_rule, substring(md5(u), 1, 1) IN ('0', '1', '2') AS calibrates FROM ruled),
pieces AS (
  SELECT u, by_rule, calibrates, count(*) AS n,
    repeat('{BEFORE}', {ORDER}) || u || '{AFTER}' AS s FROM rows GROUP BY u, by_rule, calibrates
), grams AS (
  SELECT u, substring(s, i::INT, {ORDER + 1}) AS g, CASE WHEN by_rule = 'allow' AND NOT calibrates THEN n ELSE 0 END AS a,
    CASE WHEN by_rule = 'block' AND NOT calibrates THEN n ELSE 0 END AS r
  FROM (SELECT *, unnest(range(1, length(u) + 2)) AS i FROM pieces)
), {", ".join(levels)},
scores AS (SELECT g, round((ln(pa) - ln(pr)) * {SCALE})::BIGINT AS score FROM p{ORDER}),
ratios AS (
  SELECT u, greatest(least(floor(sum(score)::DOUBLE / count(*) / {SCALE}::DOUBLE / {BIN}::DOUBLE), {MAX_BIN}), -{MAX_BIN})::INT AS bin
  FROM grams JOIN scores USING (g) GROUP BY u
), held AS (SELECT bin, by_rule, n FROM pieces JOIN ratios USING (u) WHERE calibrates AND by_rule IS NOT NULL),
cuts AS (
  SELECT b, (SELECT coalesce(sum(n), 0) FROM held WHERE by_rule = 'allow' AND bin >= b) AS ta, (SELECT coalesce(sum(n), 0) FROM held WHERE by_rule = 'block' AND bin < b) AS tr
  FROM range(-{MAX_BIN}, {MAX_BIN + 2}) t(b)
), sizes AS (SELECT coalesce(sum(n) FILTER (by_rule = 'allow'), 0) AS na, coalesce(sum(n) FILTER (by_rule = 'block'), 0) AS nr FROM held),
cut AS (
  SELECT CASE WHEN na = 0 OR nr = 0 THEN 0 ELSE (SELECT b FROM cuts ORDER BY ta * nr + tr * na DESC, abs(b), b LIMIT 1) END AS b FROM sizes
)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN bin >= (SELECT b FROM cut) THEN 'allow' ELSE 'block' END) AS verdict
FROM rows JOIN ratios USING (u)
"""


OP1_SQL = _op1_sql()
