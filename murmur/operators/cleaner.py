"""The cleaner: raw zone -> (contents, comments, rejects) (C1 routing, B9 rejects, C16 times).

Routing is a per-row label from a literal (type, source) -> parser map (JVM-side, no join); each
parser branch filters the raw rows first (the filter reaches the scan / the `type`, `source`
partitions) and the branch outputs are unioned. Rows that cannot be parsed are kept in a rejects
table with a reason instead of being skipped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.json import payload
from murmur.functions.text import first_nonblank
from murmur.functions.times import parse_publish_time
from murmur.operators.extract import comment_ids
from murmur.sources.registry import all_sources


def routing_table() -> dict[tuple[str, str], str]:
    out = {}
    for name, plugin in all_sources().items():
        if plugin.content_parser != "none":
            out[("content", name)] = plugin.content_parser
        if plugin.comment_parser != "none":
            out[("comment", name)] = plugin.comment_parser
    return out


def parser_of(type_col: Column, source_col: Column) -> Column:
    """Parser name for each row; 'none' for unknown (type, source)."""
    table = routing_table()
    m = F.create_map(*[x for (t, s), p in sorted(table.items()) for x in (F.lit(f"{t}:{s}"), F.lit(p))])
    return F.coalesce(F.try_element_at(m, F.concat_ws(":", type_col, source_col)), F.lit("none"))


def route(raw: DataFrame) -> DataFrame:
    return raw.withColumn("parser", parser_of(F.col("type"), F.col("source")))


def rejects(raw: DataFrame) -> DataFrame:
    """Rows the cleaner cannot turn into warehouse rows, with the first failing reason."""
    p = parser_of(F.col("type"), F.col("source"))
    payload_blank = F.coalesce(F.col("raw"), F.lit("")) == ""
    bad_json = F.try_parse_json(F.col("raw")).isNull()
    key_blank = (F.coalesce(F.col("content_id"), F.lit("")) == "") & (F.coalesce(F.col("url"), F.lit("")) == "")
    no_id = F.lit(False)
    for parser, ids in comment_ids(payload("raw")).items():
        no_id = no_id | ((p == parser) & ~F.exists(ids, lambda c: F.coalesce(c, F.lit("")) != ""))
    reason = (F.when(~F.col("type").isin("content", "comment") | F.col("type").isNull(), "unknown type")
              .when(p == "none", "no parser")
              .when((F.col("type") == "content") & (p == "html_article") & payload_blank, "empty payload")
              .when((F.col("type") == "comment") & (payload_blank | bad_json), "bad payload")
              .when((F.col("type") == "content") & (p == "html_article") & key_blank, "missing key")
              .when((F.col("type") == "comment") & no_id, "missing id")
              .when(F.col("keyword").isNull() | F.col("source").isNull(), "missing key"))
    return raw.select("ingest_seq", "type", "source", reason.alias("reason")).where(F.col("reason").isNotNull())


def _union(frames: list[DataFrame]) -> DataFrame | None:
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _branches(raw: DataFrame, kind: str) -> DataFrame | None:
    """The outputs of all registered parsers of a row type; sources that share a parse function are
    one branch, so the cleaner runs one job per function, not per source."""
    groups: dict = {}
    for name, plugin in sorted(all_sources().items()):
        if getattr(plugin, f"{kind}_parser") != "none":
            groups.setdefault(getattr(plugin, f"{kind}s"), []).append(name)
    return _union([parse(raw.where((F.col("type") == kind) & F.col("source").isin(*names))) for parse, names in groups.items()])


def clean(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw rows -> (contents, comments, rejects). Each branch reads only its rows."""
    timed = lambda df: df.withColumn("published_ts", parse_publish_time(F.col("published_at")))
    return timed(_branches(raw, "content")), timed(_branches(raw, "comment")), rejects(raw)


def fresh(raw: DataFrame, known: DataFrame) -> DataFrame:
    """The raw rows still worth parsing: of article rows (their key stands in the envelope) the first per
    (source, key) in ingest order, and only keys that the warehouse does not have (`known`: source,
    source_id). Just keys are aggregated and joined; all other rows pass."""
    article = (F.col("type") == "content") & (parser_of(F.col("type"), F.col("source")) == "html_article")
    keyed = raw.withColumn("_key", F.when(article, first_nonblank("content_id", "url")))
    rows = keyed.where(F.col("_key").isNotNull())
    first = rows.groupBy("source", "_key").agg(F.min("ingest_seq").alias("ingest_seq"))
    have = known.select("source", F.col("source_id").alias("_key")).join(first.select("source", "_key"), ["source", "_key"], "left_semi")
    wanted = first.join(have, ["source", "_key"], "left_anti")
    parsed = rows.join(wanted, ["source", "_key", "ingest_seq"], "left_semi")
    return parsed.unionByName(keyed.where(F.col("_key").isNull())).drop("_key")
