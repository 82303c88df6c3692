"""Robots rules, domain policies and rates: verdicts as joins to policy tables, waits as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as t


def robots_lines(files: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """`keys`, n, key and value of the lines `key: value` of robots files; comments are cut off."""
    rows = files.select(*keys, F.posexplode(t.lines(F.col(body))).alias("n", "line")).withColumn("line", t.trim(F.regexp_replace("line", "#.*", "")))
    return rows.where(F.contains("line", F.lit(":"))).select(*keys, "n", F.lower(t.trim(F.substring_index("line", ":", 1))).alias("key"), t.trim(F.regexp_extract("line", "^[^:]*:(.*)$", 1)).alias("value"))


def sitemaps(files: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """`keys`, nth (from 0) and url of the sitemaps that robots files name, wherever they stand."""
    found = robots_lines(files, keys, body).where("key = 'sitemap'").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("all"))
    return found.select(*keys, F.posexplode(F.col("all.value")).alias("nth", "url"))


def robots_rules(files: DataFrame, host: str = "host", body: str = "body", version: str | None = None) -> DataFrame:
    """host, agent, allow, disallow, delay and request_rate of robots files: rules belong to the last User-agent line above them.

    With a `version` column, such as the time of fetching, each version of a host's file has rules of its own.
    """
    keys = [host] if version is None else [host, version]
    rows = robots_lines(files, keys, body)
    above = Window.partitionBy(*keys).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("agent", F.last(F.when(F.col("key") == "user-agent", F.col("value")), ignorenulls=True).over(above)).where("agent is not null")
    listed = lambda k: F.array_sort(F.collect_list(F.when(F.col("key") == k, F.col("value"))))
    rate = F.max_by(F.when(F.col("key") == "request-rate", F.col("value")), F.when(F.col("key") == "request-rate", F.col("n")))
    return rows.groupBy(*keys, "agent").agg(listed("allow").alias("allow"), listed("disallow").alias("disallow"), F.max(F.when(F.col("key") == "crawl-delay", F.col("value").try_cast("double"))).alias("delay"), rate.alias("request_rate"))


def rule_matches(rule: Column, path: Column) -> Column:
    """An empty rule matches nothing; others match as prefixes, less a final `*`."""
    return (rule != "") & F.startswith(path, F.regexp_replace(rule, r"\*$", ""))


def path_allowed(allow: Column, disallow: Column, path: Column) -> Column:
    """Allow rules win; without a matching rule, or without rules, a path is allowed."""
    hit = lambda rules: F.coalesce(F.exists(rules, lambda r: rule_matches(r, path)), F.lit(False))
    return hit(allow) | ~hit(disallow)


def chosen_rules(rules: DataFrame, agent: str, keys: list[str]) -> DataFrame:
    """`keys` and rule: of each file the agent's rules, else those for all."""
    return rules.where(F.col("agent").isin(agent, "*")).groupBy(*keys).agg(F.max_by(F.struct("allow", "disallow", "delay", "request_rate"), (F.col("agent") == agent).cast("int")).alias("rule"))


def of_domain(hosts: DataFrame, listed: DataFrame, columns: list[str], name: str) -> DataFrame:
    """host and a struct `name` of `columns` of the most exact domain in `listed` that is the host or one above it."""
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = hosts.select("host").distinct().where(F.col("host").isNotNull()).select("host", F.explode(parents).alias("domain")).join(listed, "domain")
    return met.groupBy("host").agg(F.max_by(F.struct(*columns), F.length("domain")).alias(name))


def verdicts(urls: DataFrame, rules: DataFrame, policies: DataFrame, agent: str, default_delay: float = 1.0, blacklist: list[str] = ()) -> DataFrame:
    """Adds allowed, restrictions, recommendations and delay to rows of url, host and path.

    `rules` is what `robots_rules` gives, `policies` has domain, allows_automation, requires_attribution; a policy holds
    for subdomains too, and a host without one is refused. Both join on equal keys: a host is matched to policies through
    the list of its own parent domains.
    """
    return decided(urls.join(chosen_rules(rules, agent, ["host"]), "host", "left"), policies, urls.columns, default_delay, blacklist)


def decided(ruled: DataFrame, policies: DataFrame, columns: list[str], default_delay: float = 1.0, blacklist: list[str] = (), whitelist: DataFrame | None = None) -> DataFrame:
    """`columns` of rows that carry their `rule`, with allowed, restrictions, recommendations and delay.

    With a whitelist (column domain), hosts outside it and its subdomains are refused before all else.
    """
    out = ruled.join(of_domain(ruled, policies, ["allows_automation", "requires_attribution"], "policy"), "host", "left")
    outside = F.lit(False)
    if whitelist is not None:
        out = out.join(of_domain(ruled, whitelist.select("domain"), ["domain"], "_white"), "host", "left")
        outside = F.col("_white").isNull()
    robots = path_allowed(F.col("rule.allow"), F.col("rule.disallow"), F.col("path"))
    tos = F.coalesce(F.col("policy.allows_automation"), F.lit(False))
    black = F.coalesce(F.col("host").isin(*blacklist), F.lit(False)) if blacklist else F.lit(False)
    delay = F.coalesce(F.nullif(F.col("rule.delay"), F.lit(0.0)), F.lit(default_delay))
    said = F.array_compact(F.array(F.when(~robots, "Blocked by robots.txt"), F.when(~tos, "Terms of Service prohibit automation")))
    advice = F.array_compact(F.array(F.when(F.col("policy.requires_attribution"), "Attribution required"), F.format_string("Respect crawl delay of %.1fs", delay), F.lit("Use respectful crawling practices"), F.lit("Monitor for rate limiting")))
    shut = outside | black
    return out.select(
        *columns, (~shut & robots & tos).alias("allowed"),
        F.when(outside, F.array(F.lit("Domain not in whitelist"))).when(black, F.array(F.lit("Domain is blacklisted"))).otherwise(said).alias("restrictions"),
        F.when(shut, F.array().cast("array<string>")).otherwise(advice).alias("recommendations"), F.when(shut, 0.0).otherwise(delay).alias("delay"),
    )


def waits(requests: DataFrame, key: str, ts: str, order: str, delay: Column) -> DataFrame:
    """Adds wait: seconds a request must hold back after the one before it of the same key."""
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.lag(F.unix_micros(F.col(ts).cast("timestamp"))).over(Window.partitionBy(key).orderBy(ts, order))
    return requests.withColumn("wait", F.coalesce(F.greatest(F.lit(0.0), delay - gap / 1e6), F.lit(0.0)))


def recent_rates(requests: DataFrame, key: str, ts: str, order: str, ok: Column, n: int = 20) -> DataFrame:
    """Adds the success rate of the last n requests of the same key."""
    w = Window.partitionBy(key).orderBy(ts, order).rowsBetween(-(n - 1), 0)
    return requests.withColumn("success_rate", F.avg(ok.cast("double")).over(w))


def error_backoff(requests: DataFrame, key: str, ts: str, order: str, failed: Column) -> DataFrame:
    """Adds errors (failures in a row up to here) and backoff in seconds: none up to three, then 30 each, at most 300."""
    up = Window.partitionBy(key).orderBy(ts, order).rowsBetween(Window.unboundedPreceding, 0)
    run = Window.partitionBy(key, "_good").orderBy(ts, order).rowsBetween(Window.unboundedPreceding, 0)
    out = requests.withColumn("_good", F.sum((~failed).cast("long")).over(up)).withColumn("errors", F.sum(failed.cast("long")).over(run)).drop("_good")
    return out.withColumn("backoff", F.when(F.col("errors") > 3, F.least(F.col("errors") * 30, F.lit(300))).otherwise(0).cast("long"))


def domain_stats(results: DataFrame, domain: str, ok: Column, quality: Column, ts: str) -> DataFrame:
    return results.groupBy(domain).agg(F.count("*").alias("processed"), F.count_if(ok).alias("successful"), F.avg(F.when(ok, quality)).alias("avg_quality"), F.max(ts).alias("last_seen"))


def within_budget(df: DataFrame, size: Column, order: list[str], budget: float, splits: int = 64, few: int = 100_000) -> DataFrame:
    """Rows in order while the total of all before them is under the budget; sizes are not negative, a null one counts as 0.

    The key at which the budget runs out is found by splitting the key range: each round takes bounds from the rows of
    least hash, sums sizes between them (two passes without a sort) and goes on within the one range that spans the budget.
    All rows before that range pass by a plain filter; only the rows of the last range, `few` or those that share one key,
    are summed one by one. Bounds are values, so the same row falls into the same range in every pass. Nulls sort first.
    """
    whole = isinstance(df.select(size.alias("size")).schema["size"].dataType, T.IntegralType)
    key = F.struct(*order)
    kinds = [df.schema[c].dataType for c in order]
    rows = df.select(F.struct("*").alias("row"), key.alias("key"), F.coalesce(size.cast("decimal(38,0)" if whole else "double"), F.lit(0)).alias("size"))

    def value(bound) -> Column:
        return F.struct(*[F.lit(v).cast(k).alias(c) for v, k, c in zip(bound, kinds, order)])

    low = high = None  # rows up to low pass, rows beyond high do not
    before = 0
    while True:
        part = rows
        if low is not None:
            part = part.where(F.col("key") > value(low))
        if high is not None:
            part = part.where(F.col("key") <= value(high))
        found = part.select("key").orderBy(F.xxhash64("key"), "key").limit(16 * splits).select("key").orderBy("key").collect()
        bounds = list(dict.fromkeys(tuple(r.key) for r in found[15::16]))
        bounds = [b for b in bounds if b != high]
        if not bounds:
            break
        shard = F.size(F.filter(F.array(*map(value, bounds)), lambda b: b < F.col("key")))
        sums = {r[0]: (int(r[1]) if whole else r[1], r[2]) for r in part.groupBy(shard.alias("shard")).agg(F.sum("size"), F.count("*")).collect()}
        at = 0
        while at < len(bounds) and before + sums.get(at, (0, 0))[0] < budget:
            before += sums.get(at, (0, 0))[0]
            at += 1
        low, high = (bounds[at - 1] if at else low), (bounds[at] if at < len(bounds) else high)
        if sums.get(at, (0, 0))[1] <= few:
            break
    last = rows
    if low is not None:
        last = last.where(F.col("key") > value(low))
    if high is not None:
        last = last.where(F.col("key") <= value(high))
    earlier = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("so_far", F.coalesce(F.sum("size").over(earlier), F.lit(0))).where(F.col("so_far") < F.lit(budget - before)).select("row.*")
    return last if low is None else rows.where(F.col("key") <= value(low)).select("row.*").unionByName(last)

