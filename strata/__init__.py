"""strata: layered (bronze / silver / gold) batch analytics on Spark DataFrames.

Sub-packages:

* ``sources``   -- contract-checked readers (CSV, Parquet/Delta layers, the derived feed), checksums, file operations
* ``functions`` -- Column-expression builders (flags, bands, lookups, rule scores, blank predicates, rounding)
* ``operators`` -- DataFrame -> DataFrame transforms (bronze, silver, gold, quality rules, profiler, verification)
* ``plans``     -- layer IO, reports, publication, the end-to-end layered run and the query catalogue

Every operator is built from DataFrame operations and built-in functions; there are no Python UDFs.
"""

from strata.session import get_session, scratch_dir


def __getattr__(name):
    # convenience re-exports, imported on first use so that ``import strata`` needs no active Spark context
    if name == "run_layers":
        from strata.plans.flow import run_layers

        return run_layers
    if name in ("evaluate", "run_checks"):
        from strata.operators import quality

        return getattr(quality, name)
    if name == "rulesets":
        from strata.operators import rulesets

        return rulesets
    raise AttributeError(name)


__all__ = ["evaluate", "get_session", "rulesets", "run_checks", "run_layers", "scratch_dir"]
