"""Profile tables of nested columns and flatten them under per-column policies."""

from flatweave.operators.census import CATEGORIES, DEFAULT_POLICY, census
from flatweave.operators.flatten import flatten
from flatweave.plans.layout import FlatLayout, flat_layout
from flatweave.plans.workflows import Flat, flat_from_scan, quick_flat, quick_path, scan, scan_path
from flatweave.session import cleanup, configured
from flatweave.sources.manifest import set_policies

__all__ = ["CATEGORIES", "DEFAULT_POLICY", "Flat", "FlatLayout", "census", "cleanup", "configured",
           "flat_from_scan", "flat_layout", "flatten", "quick_flat", "quick_path", "scan",
           "scan_path", "set_policies"]
