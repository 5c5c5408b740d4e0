"""Command line of the whole run, for ``spark-submit`` or ``python -m lexforge``."""

from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import SparkSession

from lexforge.plans.run import RunOptions, run
from lexforge.sources.readers import FILES, OPTIONAL_FILES, SourcePaths


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lexforge", description=__doc__)
    parser.add_argument("sources", help="folder of the source files, under their default names")
    parser.add_argument("output", help="folder to write to")
    parser.add_argument("--everything", action="store_true", help="write tables and entries, not the summaries alone")
    parser.add_argument("--cache", help="folder that keeps compiled tables for the next run")
    parser.add_argument("--lemmas", help="JSON lines of (surface, lemma)")
    for f in fields(RunOptions):
        flag, kind = f"--{f.name.replace('_', '-')}", str(f.type)
        if kind == "bool":
            parser.add_argument(flag, action="store_true")
        else:
            parser.add_argument(flag, type=int if kind.startswith("int") else str, default=f.default)
    for name, file in {**FILES, **OPTIONAL_FILES}.items():
        parser.add_argument(f"--{name.replace('_', '-')}", help=f"path of this source, if it is not {file} in that folder")
    given = vars(parser.parse_args(arguments))
    sources, output, everything = (given.pop(n) for n in ("sources", "output", "everything"))
    options = RunOptions(**{f.name: given.pop(f.name) for f in fields(RunOptions)})
    spark = SparkSession.builder.appName("lexforge").getOrCreate()
    run(spark, SourcePaths.in_folder(sources, **{k: v for k, v in given.items() if v}), output, everything, options)


if __name__ == "__main__":
    main()
