"""Every query by name, with its SQL twin where one can be written."""

from __future__ import annotations

from importlib import import_module

#: The modules of plans, in the order of their operators' ids.
PLANS = ("aggregates", "relational", "text", "analysis", "reports")

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _name in PLANS:
    _plan = import_module(f"rostrum.plans.{_name}")
    QUERIES |= _plan.QUERIES
    ORACLES |= _plan.ORACLES
