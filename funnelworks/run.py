"""Command line: python -m funnelworks.run SF_DIR TARGET_DIR [--incremental --as-of YYYY-MM-DD]"""

from __future__ import annotations

import argparse

from funnelworks.plans.pipeline import run_pipeline
from funnelworks.session import get_session
from funnelworks.sources.gtm_raw import load_raw_sources


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("sf_dir")
    ap.add_argument("target_dir")
    ap.add_argument("--incremental", action="store_true")
    ap.add_argument("--as-of")
    args = ap.parse_args()
    spark = get_session()
    paths = run_pipeline(
        spark, load_raw_sources(spark, args.sf_dir), args.target_dir, full_refresh=not args.incremental, as_of=args.as_of
    )
    for name, path in paths.items():
        print(name, path)


if __name__ == "__main__":
    main()
