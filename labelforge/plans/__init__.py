"""Registered queries over the test tables and their SQL counterparts."""

from importlib import import_module

MODULES = ("text_queries", "set_queries", "feature_queries", "model_queries", "page_queries", "stream_queries")


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
