"""Command line: python -m traceloom.cli --root DIR --output-dir DIR [options]."""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession

from traceloom.config import EngineConfig
from traceloom.engine import Engine


def parse_args(argv: list[str] | None = None) -> EngineConfig:
    """An option for every field of the configuration; lists repeat or take commas."""
    parser = argparse.ArgumentParser(prog="traceloom", description=__doc__)
    for f in dataclasses.fields(EngineConfig):
        flag = "--" + f.name.replace("_", "-")
        default = f.default if f.default is not dataclasses.MISSING else f.default_factory()
        if isinstance(default, bool):
            parser.add_argument(flag, action="store_true", default=default)
        elif isinstance(default, list):
            parser.add_argument(flag, action="append", type=lambda s: s.split(","), default=None)
        else:
            parser.add_argument(flag, type=type(default), default=default)
    given = vars(parser.parse_args(argv))
    lists = {k: [x for part in v for x in part] for k, v in given.items() if isinstance(v, list)}
    return EngineConfig(**{k: v for k, v in (given | lists).items() if v is not None})


def run(argv: list[str] | None = None) -> dict:
    spark = SparkSession.builder.appName("traceloom").getOrCreate()
    return Engine(spark, parse_args(argv)).run()


if __name__ == "__main__":
    run()
