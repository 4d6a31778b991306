"""URL filter rules by a sort-merge range join, in DataFrame functions only.

A host turns into a key by reversing its labels: ``www.example.com`` becomes ``com.example.www.``.  A rule for a host and
its subdomains is then the interval of all keys that begin with the rule's own, and intervals are nested or apart.  Keys and
interval starts are sorted together and swept once: at each point the interval opened last brings the stack of intervals
that were open around it, and those on the stack that do not reach the point have closed.

Two sweeps follow each other.  The first finds the hosts with rules that a URL's host lies in; the second, for each of these,
the rules whose path begins the URL's path, which are intervals of paths.  A stack holds nested rules only, so a row never
carries rules it does not lie in, however many its host has.  The longest fitting rule decides.

Each sweep runs in many partitions: by first label or by host with rules, and by a salt of the row, with the rules repeated
once per salt, so that a label or a host with a third of all URLs is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import checkpointed

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _host_stacks(rules: DataFrame) -> DataFrame:
    """``(key, stack)`` per host with rules: the keys of the hosts with rules that it lies in, itself included."""
    hosts = rules.select("key").distinct()
    labels = F.split(F.expr("left(key, length(key) - 1)"), r"\.")
    around = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))
    inside = hosts.select("key", F.explode(around).alias("outer")).join(hosts.select(F.col("key").alias("outer")), "outer")
    return inside.groupBy("key").agg(F.collect_list("outer").alias("stack"))


def _path_stacks(rules: DataFrame) -> DataFrame:
    """``(key, path, stack)`` per rule: the rules of its host whose path begins its own, itself included, as
    (length of rule, length of host, rule, verdict, path)."""
    heads = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    told = F.struct(F.length("rule").alias("n"), F.length("key").alias("m"), "rule", "verdict", "path").alias("told")
    inside = rules.select("key", "path", F.explode(heads).alias("head")).join(rules.select("key", F.col("path").alias("head"), told), ["key", "head"])
    return inside.groupBy("key", "path").agg(F.collect_list("told").alias("stack"))


def _swept(points: DataFrame, starts: DataFrame, by: list[str], at: str, salts: int) -> DataFrame:
    """``points`` with ``open``: the stack of the last of ``starts(by, at, stack)`` that sorts at or before each, by salt."""
    every = starts.withColumns({"salt": F.explode(F.sequence(F.lit(0), F.lit(salts - 1))), "point": F.lit(False)})
    union = points.withColumn("point", F.lit(True)).unionByName(every, allowMissingColumns=True)
    sweep = Window.partitionBy(*by, "salt").orderBy(at, "point").rowsBetween(Window.unboundedPreceding, 0)
    return union.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("point").select(*points.columns, "open")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", salts: int | None = None) -> DataFrame:
    """``(row, host, path, rule, verdict)`` per row of ``pages``.

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if the URL's path starts with the rule's path.
    The longest fitting rule wins, counted in characters of host and path, then of the host; ``rule`` shows both together.
    Of rules that repeat host and path with other verdicts, ``block`` wins.  Without a fitting rule ``rule`` is null and
    the verdict is ``default``: what no rule names is allowed.

    Null URLs and those without ``://`` have empty host and path and fit no rule.  Ports and user names belong to the host as
    written.  Rules with a null or empty host are ignored; a null path is empty.  Repeated rows stay; empty tables work.
    """
    salts = salts or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    clean = rules.where("host is not null and host != ''").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    clean = clean.groupBy("host", "path").agg(F.coalesce(F.max(F.when(F.col("verdict") == "block", "block")), F.max("verdict")).alias("verdict"))
    clean = clean.select(host_key(F.col("host")).alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")

    columns = [F.col(f"`{c}`") for c in pages.columns]
    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")
    points = pages.select(F.struct(*columns).alias("row"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    points = points.withColumns({"key": host_key(F.col("host")), "salt": salt}).withColumn("label", F.substring_index("key", ".", 1))
    hosts = _host_stacks(clean).withColumn("label", F.substring_index("key", ".", 1))
    found = _swept(points, hosts, ["label"], "key", salts)
    around = F.filter("open", lambda outer: F.col("key").startswith(outer))
    found = checkpointed(found.select("row", "host", "path", "salt", F.coalesce(around, F.array().cast("array<string>")).alias("hosts")))

    one = F.monotonically_increasing_id()  # of rows read from a written table: the same whenever a task runs again
    found = found.withColumn("one", one)
    asked = found.select("one", "path", "salt", F.explode("hosts").alias("key"))
    ruled = _swept(asked, _path_stacks(clean), ["key"], "path", salts)
    fits = F.filter("open", lambda r: F.col("path").startswith(r.path))
    best = ruled.select("one", F.array_max(fits).alias("best")).groupBy("one").agg(F.max("best").alias("best"))
    judged = found.join(best, "one", "left")
    return judged.select("row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
