"""Command line: plan, run, report and serve a survey file."""
from __future__ import annotations

import argparse
import os

from .plans import survey as surveys


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="gridloom")
    parser.add_argument("command", choices=["plan", "run", "align", "stitch", "calibrate", "report", "serve"])
    parser.add_argument("--config", required=True)
    parser.add_argument("--rescan", action="store_true")
    parser.add_argument("--port", type=int, default=8080)
    asked = parser.parse_args(arguments)
    survey = surveys.load(asked.config)
    if asked.command == "plan":
        print("\n".join(f"{'done' if surveys.stage_done(survey, s) else 'todo'} {s}" for s in survey.plan()))
    elif asked.command == "report":
        print(surveys.build_report(survey))
    elif asked.command == "serve":
        from .plans.work import serve

        os.makedirs(survey.run_dir, exist_ok=True)
        serve(survey.run_dir, asked.port).serve_forever()
    else:
        from .plans import stages
        from .session import session

        steps = stages.steps(session("gridloom"))
        if asked.command == "run":
            print("\n".join(surveys.run(survey, steps, asked.rescan)))
        else:
            for stage in (s for s in survey.plan() if s.split("/")[0] == asked.command):
                surveys.finish_stage(survey, stage, steps[stage](survey))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
