"""Command line: run the layered workflow.

    python -m strata --root /lake --months 2024-12,2025-01,2025-02 \\
        --trips "/raw/yellow/yellow_tripdata_{month}.parquet" --zones /raw/zones/ \\
        --codes /raw/reference/ --weather /raw/weather/ [--source-format csv|parquet] [--run-id ID]
"""

from __future__ import annotations

import argparse
import json

from strata import presets as P
from strata.params import JobParams
from strata.plans import pipeline
from strata.session import build_session


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("--root", required=True, help="table root; tables live at <root>/<layer>/<name>")
    ap.add_argument("--months", default=P.DEFAULT_MONTHS)
    ap.add_argument("--run-id", default="manual")
    ap.add_argument("--trips", required=True, help="trip file path pattern with {month}")
    ap.add_argument("--zones", required=True)
    ap.add_argument("--codes", required=True)
    ap.add_argument("--weather", required=True)
    ap.add_argument("--source-format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--top-k", type=int, default=20)
    ap.add_argument("--export-url", default=None, help="JDBC address; the marts are published there")
    ap.add_argument("--export-option", action="append", default=[], metavar="KEY=VALUE")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    params = JobParams(root=a.root, months=a.months, run_id=a.run_id, source_format=a.source_format, top_k=a.top_k,
                       export_enabled=a.export_url is not None)
    spark = build_session(a.master)
    trips = {m: a.trips.format(month=m) for m in params.slices}
    out = pipeline.run(spark, params, trips, a.zones, a.codes, a.weather, export_url=a.export_url,
                       export_options=dict(x.split("=", 1) for x in a.export_option))
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
