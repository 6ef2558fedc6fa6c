"""Keyword jobs: decode (A7), validate (C19), fan out to sources (D4), publish.

A job is a JSON message {keyword, interval, platforms, news_sources, force, limit}. The fan-out
pairs each job with the sources it asks for: the registry is a literal array, filtered per job and
exploded - no join at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur import schemas as S
from murmur.sources.registry import all_sources

DEFAULT_INTERVAL = "30d"
DEFAULT_LIMIT = 50


def decode(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON message text -> job columns (unparseable text -> all NULL, dropped by validation)."""
    return messages.withColumn("_j", F.from_json(F.col(value_col).cast("string"), S.JOB)).select(
        *[c for c in messages.columns if c != value_col], "_j.*")


def validate(jobs: DataFrame) -> DataFrame:
    """A job needs a non-blank keyword; defaults: interval 30d, platforms/news_sources all,
    force false, limit 50 (0 = unlimited)."""
    return jobs.where(F.trim(F.col("keyword")) != "").select(
        *[c for c in jobs.columns if c not in S.JOB.fieldNames()],
        "keyword",
        F.coalesce("interval", F.lit(DEFAULT_INTERVAL)).alias("interval"),
        F.coalesce("platforms", F.lit("all")).alias("platforms"),
        F.coalesce("news_sources", F.lit("all")).alias("news_sources"),
        F.coalesce("force", F.lit(False)).alias("force"),
        F.coalesce("limit", F.lit(DEFAULT_LIMIT)).alias("limit"))


def fan_out(jobs: DataFrame) -> DataFrame:
    """One row per (job, source) the job asks for (`all` = no filter; news_sources lists the
    news sites to use, comma separated)."""
    registry = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p.kind).alias("kind")) for n, p in sorted(all_sources().items())])
    wanted_sites = F.split(F.regexp_replace(F.lower(F.col("news_sources")), r"\s+", ""), ",")

    def keep(s):
        kind_ok = (F.col("platforms") == "all") | (F.col("platforms") == s["kind"])
        site_ok = (s["kind"] != "news") | (F.col("news_sources") == "all") | F.array_contains(wanted_sites, s["name"])
        return kind_ok & site_ok

    return (jobs.withColumn("_s", F.explode(F.filter(registry, keep)))
            .withColumn("source", F.col("_s.name")).drop("_s"))


def to_messages(jobs: DataFrame, key_col: str | None = None) -> DataFrame:
    """Jobs -> JSON message values (for a Kafka or file sink)."""
    value = F.to_json(F.struct("keyword", "interval", "platforms", "news_sources", "force", "limit")).alias("value")
    return jobs.select(*([key_col] if key_col else []), value)


def publish(messages: DataFrame, path: str) -> None:
    """Append messages to a topic folder as JSON lines, which `streaming.jobs.job_stream` reads (a
    broker would be `messages.write.format("kafka")`)."""
    messages.write.mode("append").json(path)
