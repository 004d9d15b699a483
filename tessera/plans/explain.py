"""Print the formatted physical plan of registered queries.

    python -m tessera.plans.explain /root/testdata/sf0.1 item_popularity_named similar_items

Queries with a driver loop or a lineage cut (graph searches, similarity,
ALS) run those steps first; the plan shown is the one of the returned
DataFrame.
"""

from __future__ import annotations

import sys

from tessera.plans.catalogue import QUERIES
from tessera.session import build_session, scratch_scope


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(QUERIES)
    spark = build_session("local[*]", 8)
    for name in names:
        print(f"==== {name}")
        with scratch_scope(spark):
            QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
