"""From fetched pages to documents: robots rules as they were at the time, one pass with a reason for every refusal, batches once.

A fetched page has url, host, path, at (its time), status, content_type and html. `routed` judges each in the order compliance,
status, media type, size, quality, and keeps what it refuses with the reason. `ingest` writes batches of a stream so that a document is
taken once, whatever is run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions import assessment, web
from corpusloom.operators import compliance
from corpusloom.streaming.events import run_to_end

MOST_BYTES, THRESHOLD = 10 << 20, 0.6
#: Scores where the validator fails, and where there is none.
FAILED, UNJUDGED = 0.5, 0.8


def seconds(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp")) / 1e6


def validity(files: DataFrame, hours: float) -> DataFrame:
    """Robots files (host, fetched_at, ...) with since and until in seconds: until the next is fetched, or `hours` have passed."""
    since = seconds(F.col("fetched_at"))
    following = F.lead(since).over(Window.partitionBy("host").orderBy("fetched_at"))
    return files.withColumns({"since": since, "until": F.least(since + hours * 3600, following)})


def rules_at(pages: DataFrame, files: DataFrame, agent: str, hours: float = 24.0) -> DataFrame:
    """`pages` with the rule that held for the agent at their time; without one where no file was valid.

    Both sides meet by host and span of `hours`, of which a file's validity touches two at most, so a host with many pages is spread
    over its spans and nothing is compared across them.
    """
    width = hours * 3600
    slot = lambda c: F.floor(c / width)
    known = validity(files.dropDuplicates(["host", "fetched_at"]), hours)
    ruled = known.select("host", "fetched_at", "since", "until").join(compliance.chosen_rules(compliance.robots_rules(files.dropDuplicates(["host", "fetched_at"]), version="fetched_at"), agent, ["host", "fetched_at"]), ["host", "fetched_at"], "left")
    spans = ruled.select(F.col("host").alias("_host"), "since", "until", "rule", F.explode(F.sequence(slot(F.col("since")), slot(F.col("until")))).alias("_slot"))
    at = seconds(F.col("at"))
    met = pages.join(spans, (F.col("host") == F.col("_host")) & (slot(at) == F.col("_slot")) & (at >= F.col("since")) & (at < F.col("until")), "left")
    return met.select(*pages.columns, "rule")


def judged(docs: DataFrame) -> DataFrame:
    """The five-dimension assessment as a validator: adds overall, null where a text cannot be assessed."""
    return assessment.assess(docs).select(*docs.columns, "overall")


def routed(
    pages: DataFrame, robots: DataFrame, policies: DataFrame, agent: str, validator: Callable[[DataFrame], DataFrame] | None = judged, threshold: float = THRESHOLD,
    hours: float = 24.0, most_bytes: int = MOST_BYTES, whitelist: DataFrame | None = None, blacklist: list[str] = (),
) -> DataFrame:
    """`pages` without html, with id, accepted, reason, delay, title, text, metadata and quality.

    `validator` adds `overall` to rows of id, text and metadata; null counts as `FAILED`, none at all as `UNJUDGED`. Pages refused
    before have no text and no quality; those below the threshold keep theirs.
    """
    verdict = compliance.decided(rules_at(pages, robots, agent, hours), policies, pages.columns, blacklist=blacklist, whitelist=whitelist)
    early = (
        F.when(web.url_problem(F.col("url")).isNotNull(), web.url_problem(F.col("url")))
        .when(~F.col("allowed"), F.concat(F.lit("URL not allowed: "), F.array_join("restrictions", ", ")))
        .when(F.coalesce(F.col("status") != 200, F.lit(True)), F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("unknown"))))
        .when(~F.coalesce(web.supported(F.col("content_type")), F.lit(False)), F.concat(F.lit("Unsupported content type: "), F.coalesce("content_type", F.lit(""))))
        .when(F.octet_length("html") > most_bytes, "Content exceeds maximum size limit")
    )
    html = F.when(F.col("_early").isNull(), F.coalesce("html", F.lit("")))
    docs = verdict.withColumn("_early", early).withColumns({
        "id": web.stable_id(F.col("url")), "title": web.title(html), "text": web.pattern_text(html),
        "metadata": F.when(F.col("_early").isNull(), F.map_concat(web.head_entries(html), F.create_map(F.lit("source_url"), F.col("url")))),
    })
    docs = docs.select(*[c for c in pages.columns if c != "html"], "id", "delay", "title", "text", "metadata", "_early")
    docs = docs.withColumn("overall", F.lit(UNJUDGED)) if validator is None else validator(docs).withColumn("overall", F.coalesce("overall", F.lit(FAILED)))
    quality = F.when(F.col("_early").isNull(), F.col("overall"))
    low = F.when(quality < threshold, F.format_string("Quality score %.2f below threshold %.2f", quality, F.lit(threshold)))
    out = docs.withColumns({"quality": quality, "reason": F.coalesce("_early", low)})
    return out.withColumn("accepted", F.col("reason").isNull()).drop("_early", "overall")


def ingest(pages: DataFrame, route: Callable[[DataFrame], DataFrame], path: str, progress: str) -> StreamingQuery:
    """Routes a stream of pages batch by batch into Parquet at `path`, each document id once: of a batch the first by time and url.

    What earlier batches hold, accepted or refused, is the durable list of ids seen. A batch writes under its own number and leaves its
    own number out of that list, so one that runs again after a crash gives the same rows again in the same place.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ident = batch.withColumn("_id", web.stable_id(F.col("url")))
        rows = ident.groupBy("_id").agg(F.min_by(F.struct(*batch.columns), F.struct("at", "url")).alias("page"))
        seen = spark.read.schema("id string, batch long").parquet(path) if _exists(spark, path) else spark.createDataFrame([], "id string, batch long")
        fresh = rows.join(seen.where(F.col("batch") != number).select(F.col("id").alias("_id")), "_id", "left_anti").select("page.*")
        route(fresh).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return run_to_end(pages, each, progress)


def _exists(spark, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
