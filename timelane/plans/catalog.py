"""Everything registered: queries and the check SQL that goes with them."""

from __future__ import annotations

from timelane.plans import checks_media, checks_operations, checks_timeline
from timelane.plans.registry import queries

__all__ = ["queries", "checks"]


def checks() -> dict[str, str]:
    return {**checks_timeline.checks(), **checks_media.checks(), **checks_operations.checks()}
