"""The command line. Exit status 0 when done, 1 on failure, 2 on wrong use, 130 when interrupted.

python -m trackframe query NAME TABLES    runs a query of the catalogue
python -m trackframe outliers PROJECT     likely-wrong frames of analyzed videos
python -m trackframe frames PROJECT       frames for a start, by ceiling or budget
python -m trackframe pending PROJECT      directories with frames that await refinement
python -m trackframe purge PROJECT        what a purge of frames without labels deletes

PROJECT is a folder with one Parquet table each: videos, predictions, human, machine, refined, disk, counts.
"""

from __future__ import annotations

import argparse
import sys

from .operators import labelsets
from .plans import catalogue, pipelines, report


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="trackframe", description="Queries and extractions over keypoint projects.")
    commands = parser.add_subparsers(dest="command", required=True)
    query = commands.add_parser("query", help="run a query of the catalogue")
    query.add_argument("query", choices=sorted(catalogue.queries()))
    query.add_argument("tables", help="folder of the tables")
    query.add_argument("--rows", type=int, default=20)
    query.add_argument("--out", help="write the result as Parquet instead")
    for name in ("outliers", "frames", "pending", "purge"):
        own = commands.add_parser(name)
        own.add_argument("project")
        own.add_argument("--iteration", type=int, default=0)
        if name in ("outliers", "frames"):
            own.add_argument("--video", action="append", default=[], help="path of a registered video; all by default")
            own.add_argument("--out", help="write the frames to extract as Parquet")
            own.add_argument("--overwrite", action="store_true")
            own.add_argument("--reset", action="store_true")
            own.add_argument("--start", type=float, default=0.0)
            own.add_argument("--stop", type=float, default=1.0)
            own.add_argument("--count", type=int, default=20, help="frames a video")
            own.add_argument("--step", type=int, default=1)
        if name == "outliers":
            own.add_argument("--algorithm", default="jump", choices=["fitting", "jump", "list", "uncertain"])
            own.add_argument("--frame", type=int, action="append", default=[])
            own.add_argument("--bodypart", action="append", default=[])
        if name == "frames":
            own.add_argument("--budget", type=int, default=-1)
            own.add_argument("--balanced", action="store_true")
            own.add_argument("--exclusive", action="store_true")
    return parser


def _extract(spark, options) -> int:
    project = pipelines.Project.load(spark, options.project, options.iteration)
    requested = spark.createDataFrame([(v,) for v in options.video], "path string") if options.video else None
    shared = {"overwrite": options.overwrite, "reset": options.reset, "start": options.start, "stop": options.stop}
    if options.command == "outliers":
        more = {"frames": options.frame} if options.algorithm == "list" else {}
        found = pipelines.extract_outliers(project, requested, options.algorithm, frames_per_video=options.count, step=options.step, bodyparts=tuple(options.bodypart), **shared, **more)
    else:
        found = pipelines.extract_frames(project, requested, options.count, options.budget, options.balanced, options.exclusive, stride=options.step, **shared)
    if options.out:
        found.frames.write.parquet(options.out)
    summary = found.summary()
    print(summary.describe())
    for line in report.failure_lines(found.outcomes.where("status <> 'ok'").collect()):
        print(line)
    return 0 if summary.successful else 1


def _run(spark, options) -> int:
    if options.command in ("outliers", "frames"):
        return _extract(spark, options)
    if options.command == "query":
        result = catalogue.queries()[options.query](spark, options.tables)
        if options.out:
            result.write.parquet(options.out)
        else:
            result.show(options.rows, truncate=False)
        return 0
    project = pipelines.Project.load(spark, options.project, options.iteration)
    if options.command == "pending":
        rows = labelsets.pending_report(labelsets.pending_refinement(project.machine, project.human, project.refined, project.iteration)).collect()
        print("\n".join(f"{r['video']}: {r['pending']}" for r in rows) or "nothing is pending")
    else:
        r = labelsets.purge_preview(project.disk, project.human).first()
        print(report.PurgeSummary(r["directories"], r["labelled_directories"], r["frames"], False).describe())
    return 0


def main(arguments: list[str] | None = None) -> int:
    try:
        options = _parser().parse_args(arguments)
    except SystemExit as stop:
        return int(stop.code or 0)
    from pyspark.sql import SparkSession

    try:
        return _run(SparkSession.builder.getOrCreate(), options)
    except KeyboardInterrupt:
        return 130
    except Exception as error:
        print(f"{options.command}: {error}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
