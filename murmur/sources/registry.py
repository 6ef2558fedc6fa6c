"""Source registry (A9/K3): each named source contributes DataFrame transforms from raw-zone rows
to warehouse rows. A plugin is a pair of functions `(raw_df) -> contents_df` and
`(raw_df) -> comments_df`; the cleaner routes rows by (type, source) and unions the outputs.

Adding a source = decorating one class; nothing else changes. The live fetching side of a plugin
(HTTP search, comment APIs) is outside Spark; in a deployment it would be a Python data source
(`pyspark.sql.datasource.DataSource`) writing raw rows, which this registry then parses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_REGISTRY: dict[str, type] = {}


def register_source(name: str):
    def deco(cls):
        cls.name = name
        _REGISTRY[name] = cls
        return cls
    return deco


def get_source(name: str):
    return _REGISTRY.get(name)


def all_sources() -> dict[str, type]:
    _load_builtin()
    return dict(_REGISTRY)


class SourcePlugin:
    """Base plugin: `contents` / `comments` parse rows of this source (already filtered). Sources
    whose functions are the same object are parsed together. `kind` is what jobs ask for."""

    name = ""
    kind = "news"
    content_parser = "none"
    comment_parser = "none"

    @staticmethod
    def contents(raw: DataFrame) -> DataFrame | None:
        return None

    @staticmethod
    def comments(raw: DataFrame) -> DataFrame | None:
        return None


def _load_builtin():
    # importing the module registers the built-in sources
    from murmur.sources import builtin  # noqa: F401

