"""All registered queries, merged from the per-domain suites."""

from importlib import import_module

_DOMAINS = ("qc", "normalize", "review", "scoring", "models", "structure", "resources", "files")

QUERIES: dict = {}
ORACLE: dict = {}
for _domain in _DOMAINS:
    _module = import_module(f"varloom.plans.suite_{_domain}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
