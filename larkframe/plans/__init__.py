"""All named queries. Importing the modules registers them."""

from importlib import import_module
from pathlib import Path

from larkframe.registry import ORACLES, QUERIES

for _m in sorted(p.stem for p in Path(__file__).parent.glob("*.py") if p.stem != "__init__"):
    import_module(f"larkframe.plans.{_m}")

from larkframe.plans.verbs import flagship  # noqa: E402

__all__ = ["ORACLES", "QUERIES", "flagship"]
