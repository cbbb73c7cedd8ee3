"""Command line: ``python -m demandscope --root DATA --step clean``, or ``--step xai --outlet-id OUT_00001``."""

from __future__ import annotations

import argparse
import json

from .plans.pipeline import REPORTS, STEPS, Pipeline
from .session import session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="demandscope")
    p.add_argument("--root", required=True, help="data folder")
    p.add_argument("--step", choices=[*STEPS, *REPORTS, "xai", "all"], default="optimize")
    p.add_argument("--outlet-id")
    p.add_argument("--output-json", action="store_true", help="print the whole explanation")
    p.add_argument("--corrected-coords", action="store_true", help="points and competitors by corrected coordinates, not as they came")
    p.add_argument("--budget", type=float, default=5_000_000.0)
    p.add_argument("--b", type=float, default=0.0005, help="response parameter")
    a = p.parse_args(argv)
    if a.step == "xai" and not a.outlet_id:
        p.error("--outlet-id is needed for xai")
    pipe = Pipeline(session(), a.root, a.corrected_coords, a.budget, a.b)
    if a.step == "xai":
        told = pipe.explain(a.outlet_id)
        print(json.dumps(told, indent=2) if a.output_json else told["narrative"])
    else:
        pipe.run(a.step)


if __name__ == "__main__":
    main()
