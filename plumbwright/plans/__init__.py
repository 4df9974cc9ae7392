"""Ready-made queries over the test tables, each with an equivalent SQL text."""

from plumbwright.plans import checks, models, monitoring, sources, texts
from plumbwright.plans.base import PLANS

__all__ = ["PLANS", "checks", "models", "monitoring", "sources", "texts"]
