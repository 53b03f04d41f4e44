"""python -m glossmill run JOB [key=value ...] | experiment FILE | --list-presets"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="glossmill")
    parser.add_argument("--list-presets", action="store_true")
    sub = parser.add_subparsers(dest="command")
    run = sub.add_parser("run")
    run.add_argument("job")
    run.add_argument("overrides", nargs="*")
    run.add_argument("--run-name")
    run.add_argument("--force", action="store_true")
    experiment = sub.add_parser("experiment")
    experiment.add_argument("file")
    args = parser.parse_args(argv)
    if args.list_presets:
        from .functions.landmarks import PRESETS

        for name, indices in sorted(PRESETS.items()):
            print(f"{name}: {len(indices)} landmarks")
        return 0
    if not args.command:
        parser.print_help()
        return 2
    from .plans import adapters, config, processors, runner  # noqa: F401  the first and third register stages
    from .session import local_session, ship_package

    spark = local_session()
    ship_package(spark)
    if args.command == "run":
        words = [*args.overrides, *([f"run_name={args.run_name}"] if args.run_name else [])]
        done = runner.run_job(spark, config.load(args.job, words), resume=not args.force)
        print(", ".join(done.done))
        return 0
    results = runner.run_experiment(spark, args.file)
    print(runner.summary(results))
    return int(any(r["status"] == "failed" for r in results))


if __name__ == "__main__":
    sys.exit(main())
