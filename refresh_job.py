"""Run the whole job on a cluster: ``spark-submit refresh_job.py --listings ... --out ...``.

The session comes from ``spark-submit`` (cluster settings, ``spark.checkpoint.dir``);
``--cluster-cores`` applies the AQE/shuffle sizing of ``staykit.session.cluster_conf``.
Schedule it monthly with ``--mode append`` to add new snapshot files incrementally.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from staykit.plans import refresh  # noqa: E402
from staykit.session import checkpoint_root, cluster_conf  # noqa: E402


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--listings", required=True, help="folder of monthly listing snapshot CSVs")
    ap.add_argument("--location", required=True, help="folder or file of the locality lookup CSV")
    ap.add_argument("--g01", required=True, help="census G01 CSV")
    ap.add_argument("--g02", required=True, help="census G02 CSV")
    ap.add_argument("--out", required=True, help="root folder of the raw/star/kpi/audit layers")
    ap.add_argument("--mode", choices=("recompute", "append"), default="append")
    ap.add_argument("--cluster-cores", type=int, default=0, help="total executor cores (sizing)")
    args = ap.parse_args(argv)
    builder = SparkSession.builder.appName("staykit-refresh")
    if args.cluster_cores:
        for k, v in cluster_conf(args.cluster_cores).items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_root(spark)
    inputs = {"listings": args.listings, "location": args.location, "g01": args.g01, "g02": args.g02}
    out = refresh.run(spark, inputs, args.out, mode=args.mode)
    print(json.dumps(out, indent=1))
    return out


if __name__ == "__main__":
    main()
