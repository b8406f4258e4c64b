"""Queries over the given tables; ``load()`` returns them with their SQL."""


def load():
    from importlib import import_module
    from pathlib import Path

    from trajspark.plans.registry import ORACLES, QUERIES

    for path in sorted(Path(__file__).parent.glob("*_queries.py")):
        import_module(f"trajspark.plans.{path.stem}")
    return QUERIES, ORACLES
