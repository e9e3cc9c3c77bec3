"""URL rules by a sort-merge range join (DataFrame and SQL functions only).

A rule is (verdict, host, path): it fits its host and all subdomains where the url's path starts
with its path; of the rules that fit, the longest (host and path together, then host) wins, of two
for the same host and path the first. The canonical key of a url, for each length that a rule's
path has, is that length, so much of the path, and the host reversed with a closing dot: a rule
then is the interval of keys that start with its own. Rules nest, so one sorted pass over their
ends with a stack of the open ones gives the winner from each end to the next, and one sorted sweep
over urls and ends together carries the last winner seen to every url.

``judge`` takes the rules as a sequence and gives their ends to every part; ``judge_by_table`` takes them
as a table of any size, whose ends are range-partitioned with the urls, each part beginning with the
rule that is open at its border.

Defined results: a null url, or one without ``://``, has an empty host and path; it and a url that
no rule fits get a null rule and the default verdict. Repeated rows stay repeated. Columns of the
input named host, path, rule or verdict are replaced, those starting with ``_url_`` are dropped.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.scratch import materialize, shuffle_partitions

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    host = F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def key(host: Column, path: Column, length: int) -> Column:
    """Null where the path is shorter. The length's fixed width and the path's fixed length keep keys of different rules apart."""
    return F.when(F.length(path) >= length, F.concat(F.lit(f"{length:06d}"), F.substring(path, 1, length), F.reverse(host), F.lit(".")))


def turning_points(rules) -> list[tuple[int, str, int]]:
    """(path length, key, winner from there on or -1), by a sorted pass over the rules' ends with a stack of the open rules."""
    firsts = {}
    for n, (_, host, path) in enumerate(rules):
        firsts.setdefault(f"{len(path):06d}{path}{host[::-1]}", (len(path), n))
    points = []
    ends = sorted([(low + ".", 1, length, n) for low, (length, n) in firsts.items()] + [(low + "/", 0, length, n) for low, (length, n) in firsts.items()])
    open_rules: list[int] = []
    for at, opens, length, n in ends:
        open_rules.append(n) if opens else open_rules.remove(n)
        if points and points[-1][1] == at:
            points.pop()
        points.append((length, at, open_rules[-1] if open_rules else -1))
    return points


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT, url: str = "url") -> DataFrame:
    """Adds ``host, path, rule, verdict``. The rules are a Python sequence, so their number is the caller's own bound.

    The sweep runs in as many independent parts as there are shuffle partitions; urls are dealt to
    them evenly whatever they are, so that one host or one url with a third of all rows is spread,
    and each part gets all ends of rules.
    """
    spark = pages.sparkSession
    parts = shuffle_partitions(spark)
    lengths = sorted({len(path) for _, _, path in rules})
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict") and not c.startswith("_url_")]
    host, path = host_and_path(F.col(url))
    urls = pages.withColumn("_url_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts))).withColumn("_url_host", host).withColumn("_url_path", path)
    urls = urls.select(*names, "_url_part", "_url_host", "_url_path", F.lit(1).alias("_url_is"))
    for n in lengths:
        urls = urls.withColumn(f"_url_key{n}", key(F.col("_url_host"), F.col("_url_path"), n)).withColumn(f"_url_win{n}", F.lit(None).cast("int"))
    if rules:
        ends = spark.createDataFrame(turning_points(rules), "_url_length int, _url_key string, _url_win int")
        ends = ends.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("_url_part"), F.lit(0).alias("_url_is"))
        for n in lengths:
            own = F.col("_url_length") == n
            ends = ends.withColumn(f"_url_key{n}", F.when(own, F.col("_url_key"))).withColumn(f"_url_win{n}", F.when(own, F.col("_url_win")))
        urls = urls.unionByName(ends.drop("_url_length", "_url_key", "_url_win"), allowMissingColumns=True)
    best = F.lit(-1)
    sizes = F.array(*(F.lit(len(h) + len(p)) for _, h, p in rules))
    hosts = F.array(*(F.lit(len(h)) for _, h, p in rules))
    for n in lengths:
        sweep = W.partitionBy("_url_part").orderBy(F.col(f"_url_key{n}").asc_nulls_first(), "_url_is").rowsBetween(W.unboundedPreceding, 0)
        urls = urls.withColumn(f"_url_win{n}", F.coalesce(F.last(f"_url_win{n}", ignorenulls=True).over(sweep), F.lit(-1)))
    out = urls.filter("_url_is = 1")
    for n in lengths:
        w, b = F.col(f"_url_win{n}"), best
        rank = lambda c: F.struct(F.get(sizes, c), F.get(hosts, c))
        best = F.when(w < 0, b).when(b < 0, w).when(rank(w) > rank(b), w).otherwise(b)
    rule = F.get(F.array(*(F.lit(h + p) for _, h, p in rules)), F.col("_url_best"))
    verdict = F.get(F.array(*(F.lit(v) for v, _, _ in rules)), F.col("_url_best"))
    out = out.withColumn("_url_best", F.nullif(best, F.lit(-1)))
    return out.select(
        *names, F.col("_url_host").alias("host"), F.col("_url_path").alias("path"),
        (rule if rules else F.lit(None).cast("string")).alias("rule"), F.coalesce(verdict if rules else F.lit(None), F.lit(default)).alias("verdict"),
    )


def judge_by_table(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, url: str = "url") -> DataFrame:
    """Adds ``host, path, rule, verdict``. ``rules``: ``verdict, host, path, ord``; of two for the same host and path the one with the smaller ``ord`` (then verdict) holds, those with a null host, path or verdict don't.

    The sweep is over the distinct keys of the urls and the rules' ends together, in ranges of keys.
    Where a rule ends, the one around it goes on: it has the same path, and a host that the inner's
    ends with, and is found by joining the ends of hosts. The driver holds the distinct lengths of
    the rules' paths and sees nothing else; the unpartitioned window runs over parts, a row each.
    """
    spark = pages.sparkSession
    parts = shuffle_partitions(spark)
    own = rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").groupBy("host", "path").agg(F.min(F.struct("ord", "verdict")).alias("x"))
    low = lambda host, path: F.concat(F.lpad(F.length(path).cast("string"), 6, "0"), path, F.reverse(host))
    own = materialize(own.select("host", "path", F.col("x.verdict").alias("verdict"), low(F.col("host"), F.col("path")).alias("low")), "url-rules", exchanged=True)
    lengths = sorted(r["n"] for r in own.select(F.length("path").alias("n")).distinct().collect())
    labels = F.size(F.split("host", r"\."))
    ups = own.filter(labels > 1).select("low", "path", "host", F.explode(F.sequence(F.lit(1), labels - 1)).alias("k"))
    ups = ups.select("low", low(F.expr("substring_index(host, '.', -k)"), F.col("path")).alias("up"))
    around = ups.join(own.select(F.col("low").alias("up")), "up").groupBy("low").agg(F.max_by("up", F.length("up")).alias("up"))
    begins = own.select(F.concat("low", F.lit(".")).alias("key"), F.col("low").alias("win"), F.lit(0).alias("is_url"))
    ends = own.join(around, "low", "left").select(F.concat("low", F.lit("/")).alias("key"), F.coalesce("up", F.lit("")).alias("win"), F.lit(0).alias("is_url"))

    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict") and not c.startswith("_url_")]
    host, path = host_and_path(F.col(url))
    urls = pages.select(*names, host.alias("_url_host"), path.alias("_url_path"))
    distinct = urls.select("_url_host", "_url_path").distinct()
    keys = F.array_compact(F.array(F.lit(None).cast("string"), *(key(F.col("_url_host"), F.col("_url_path"), n) for n in lengths)))
    asked = materialize(distinct.select("_url_host", "_url_path", F.explode(keys).alias("key")), "url-keys", exchanged=True)
    every = begins.unionByName(ends).unionByName(asked.select("key").distinct().select("key", F.lit(None).cast("string").alias("win"), F.lit(1).alias("is_url")))
    dealt = materialize(every.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "url-sweep", exchanged=True)
    last = dealt.groupBy("part").agg(F.max_by("win", F.when(F.col("is_url") == 0, F.col("key"))).alias("last"))
    border = last.select(F.col("part").alias("of"), F.last("last", ignorenulls=True).over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)).alias("open"))
    sweep = W.partitionBy("part").orderBy("key", "is_url").rowsBetween(W.unboundedPreceding, 0)
    swept = dealt.withColumn("here", F.last("win", ignorenulls=True).over(sweep)).filter("is_url = 1").join(F.broadcast(border), F.col("part") == F.col("of"))
    found = swept.select(F.col("key").alias("at"), F.coalesce("here", "open").alias("low")).filter("low <> ''")
    # Keys written anew give both sides of a join an exchange of their own, so that a hot one's partition can be split.
    met = asked.join(found, asked["key"] == found["at"])
    rank = F.struct(F.length("low"), F.length("low") - F.substring("low", 1, 6).cast("int"))
    best = met.groupBy("_url_host", "_url_path").agg(F.max_by("low", rank).alias("low")).select(F.concat("_url_host", F.lit("")).alias("h"), F.concat("_url_path", F.lit("")).alias("p"), F.col("low").alias("best"))
    told = best.join(own, best["best"] == own["low"]).select("h", "p", F.concat("host", "path").alias("_url_rule"), F.col("verdict").alias("_url_verdict"))
    out = urls.join(told, (urls["_url_host"] == told["h"]) & (urls["_url_path"] == told["p"]), "left")
    return out.select(*names, F.col("_url_host").alias("host"), F.col("_url_path").alias("path"), F.col("_url_rule").alias("rule"), F.coalesce("_url_verdict", F.lit(default)).alias("verdict"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT row_number() OVER () AS n, page_id, coalesce(translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM h),
r(v, rh, rp) AS (VALUES {", ".join(map(str, RULES))}),
m AS (SELECT n, max_by(rh || rp, length(rh || rp) * 100000 + length(rh)) AS rule, max_by(v, length(rh || rp) * 100000 + length(rh)) AS verdict
      FROM p JOIN r ON ends_with('.' || host, '.' || rh) AND starts_with(path, rp) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM p LEFT JOIN m USING (n)
"""
