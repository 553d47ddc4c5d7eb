"""Print the formatted physical plan of registered queries.

Usage: python tools/show_plans.py [sf_dir] [key ...]   (default: the headline KPI and star queries)
Shows what reaches the scans (``ReadSchema``, ``PushedFilters``), where the
exchanges are, and which joins broadcast.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staykit.plans.catalog import REGISTRY  # noqa: E402
from staykit.session import local_session  # noqa: E402

DEFAULT = ("kpi_region_month", "kpi_segment_month", "kpi_host_region_month", "star_fact", "star_owner")


def main(argv) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or DEFAULT
    spark = local_session(8)
    for k in keys:
        print(f"===== {k}")
        REGISTRY[k](spark, sf).explain(mode="formatted")


if __name__ == "__main__":
    main(sys.argv)
