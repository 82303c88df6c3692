"""The table of crawl sources: validation, jobs from start URLs, filter rules, due sources, outcomes and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.library import blank


def problem(ident: Column, name: Column, base_url: Column, start_urls: Column) -> Column:
    """Why a source is refused; null where it is not."""
    return (
        F.when(blank(ident), "source ID is required").when(blank(name), "source name is required").when(blank(base_url), "base URL is required")
        .when(F.coalesce(F.size(start_urls), F.lit(0)) < 1, "at least one start URL is required")
    )


def jobs(sources: DataFrame) -> DataFrame:
    """One job per start URL, numbered, with the source's metadata and its own id and name."""
    own = F.create_map(F.lit("source_id"), F.col("id"), F.lit("source_name"), F.col("name"))
    kept = F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("source_id", "source_name"))
    rows = sources.select("id", "priority", F.posexplode("start_urls").alias("n", "url"), F.map_concat(kept, own).alias("metadata"))
    return rows.select(F.format_string("%s-%d", "id", "n").alias("job_id"), F.col("id").alias("source_id"), "url", "priority", "metadata")


def passes_rules(rules: list[dict[str, str]]) -> Column:
    """Rows that some include rule matches (if there are any) and no exclude rule does; a rule has kind, field and pattern."""
    match = lambda r: F.regexp_like(F.coalesce(F.col(r["field"]), F.lit("")), F.lit(r["pattern"]))
    keep, includes = F.lit(True), [r for r in rules if r["kind"] == "include"]
    if includes:
        keep = F.lit(False)
        for r in includes:
            keep = keep | match(r)
    for r in rules:
        if r["kind"] == "exclude":
            keep = keep & ~match(r)
    return keep


def by_rules(rows: DataFrame, rules: list[dict[str, str]]) -> DataFrame:
    """Rows that pass, with the transform rules applied to their fields in order: each replaces what its pattern matches by its `value`."""
    out = rows.where(passes_rules(rules))
    for r in rules:
        if r["kind"] == "transform":
            out = out.withColumn(r["field"], F.regexp_replace(F.col(r["field"]), r["pattern"], r.get("value", "")))
    return out


#: Left out unless a source says otherwise: addresses of binary files.
DEFAULT_RULES = [{"kind": "exclude", "field": "url", "pattern": r"(?i)\.(jpg|jpeg|png|gif|pdf|zip|exe|mp4|mp3)$"}]


def due(sources: DataFrame, now: Column) -> DataFrame:
    return sources.where((F.col("status") == "active") & (F.coalesce("next_crawl", F.lit("1970-01-01").cast("timestamp_ntz")) < now))


def after_crawl(sources: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Sources with new status and next crawl: one interval on after success, two after an error; others stay."""
    step = lambda k: F.timestamp_add("SECOND", (F.col("interval_s") * k).cast("int"), now)
    both = sources.join(outcomes.select("id", "ok"), "id", "left")
    return both.withColumns({
        "status": F.when(F.col("ok"), "active").when(~F.col("ok"), "error").otherwise(F.col("status")),
        "next_crawl": F.when(F.col("ok"), step(1)).when(~F.col("ok"), step(2)).otherwise(F.col("next_crawl")),
    }).drop("ok")


def health(sources: DataFrame, queue_length: int) -> DataFrame:
    """One row: sources by state, and whether the service is well (queue of at most 500, no source in error)."""
    out = sources.agg(F.count("*").alias("sources"), F.count_if(F.col("status") == "active").alias("active"), F.count_if(F.col("status") == "error").alias("errors"))
    return out.withColumn("healthy", F.lit(queue_length <= 500) & (F.col("errors") == 0))
