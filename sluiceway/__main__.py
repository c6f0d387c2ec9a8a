"""Entry for spark-submit: ``-p job.json``, with ``-ft ARRAY`` for a list of jobs."""

from __future__ import annotations

import argparse
import json

from sluiceway import job_stub, presets, run_job, run_jobs


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sluiceway", description=__doc__)
    parser.add_argument("-p", "--path", required=True, help="the job file, a path or a URL")
    parser.add_argument("-ft", "--file_type", default="SINGLE", type=str.upper,
                        choices=["SINGLE", "ARRAY"], help="one job, or an array of jobs")
    parser.add_argument("-c", "--config", action="store_true",
                        help="write a job file to fill in, for the presets -s and -t")
    parser.add_argument("-s", "--source", help=f"one of {', '.join(presets())}")
    parser.add_argument("-t", "--target", help="as for --source")
    given = parser.parse_args(arguments)
    if given.config:
        if not (given.source and given.target):
            parser.error("-c needs both -s and -t")
        with open(given.path, "w", encoding="utf-8") as file:
            json.dump(job_stub(given.source, given.target), file, indent=2)
    elif given.file_type == "ARRAY":
        run_jobs(None, given.path, close_session=True)
    else:
        run_job(None, given.path, close_session=True)


if __name__ == "__main__":
    main()
