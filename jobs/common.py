"""What the jobs share: configuration, logging, sessions, and whether a table is there yet."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

HERE = Path(__file__).parent


def config(name: str, path: str | None = None) -> dict:
    """The job's settings: its own file, and over it what the file at ``path`` says."""
    own = json.loads((HERE / f"{name}.json").read_text())
    return own | (json.loads(Path(path).read_text()) if path else {})


def mapped(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The columns of a configuration, by name, as SQL expressions over ``df``."""
    return df.selectExpr(*[f"{expression} as `{name}`" for name, expression in columns.items()])


def existing(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``; None if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def main(name: str, paths: Mapping[str, str], run: Callable[..., object]) -> None:
    """The command line: one option for each path, and --config; the session is made and stopped here only."""
    parser = argparse.ArgumentParser(description=run.__doc__.splitlines()[0])
    for option, text in paths.items():
        parser.add_argument(f"--{option}", required=True, help=text)
    parser.add_argument("--config", help=f"JSON file whose entries go before those of {name}.json")
    given = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    settings = config(name, given.pop("config"))
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, **given, settings=settings)
    finally:
        spark.stop()
