"""Built-in sources: four news sites (HTML articles, threaded comments), a video site and a forum
(JSON posts and flat comments)."""

from __future__ import annotations

from murmur.operators import extract as X
from murmur.sources.registry import SourcePlugin, register_source


class _News(SourcePlugin):
    content_parser = "html_article"

    @staticmethod
    def contents(raw):
        return X.extract_articles(raw)


@register_source("detik")
class Detik(_News):
    comment_parser = "thread_json"

    @staticmethod
    def comments(raw):
        return X.flatten_comment_threads(raw)


@register_source("cnn")
class Cnn(_News):
    comment_parser = "thread_json"

    @staticmethod
    def comments(raw):
        return X.flatten_comment_threads(raw)


@register_source("liputan6")
class Liputan6(_News):
    pass


@register_source("merdeka")
class Merdeka(_News):
    pass


@register_source("youtube")
class Youtube(SourcePlugin):
    kind = "socmed"
    content_parser = "video_json"
    comment_parser = "video_comment"

    @staticmethod
    def contents(raw):
        return X.json_contents(raw, "youtube")

    @staticmethod
    def comments(raw):
        return X.flat_comments(raw, "youtube")


@register_source("reddit")
class Reddit(SourcePlugin):
    kind = "socmed"
    content_parser = "forum_json"
    comment_parser = "forum_comment"

    @staticmethod
    def contents(raw):
        return X.json_contents(raw, "reddit")

    @staticmethod
    def comments(raw):
        return X.flat_comments(raw, "reddit")
