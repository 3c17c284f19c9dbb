"""The registered queries of this package."""

from importlib import import_module

MODULES = [
    "quality_classifier", "bpe", "html_content", "quality_rules", "token_store", "simhash", "lm_scoring",
    "decontaminate", "secrets", "warc", "spelling", "toxicity", "phrases",
]


def _load():
    for module in MODULES:
        import_module(f"veinworks.llm.{module}")
    from veinworks.llm import base

    return base


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().SQL)
