"""Stages with checksummed checkpoints: a run starts after any stage whose outputs are as its checkpoint says."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import content_digest, write_table

#: The stages in order.
STAGES = ("trimming", "alignment", "qc", "master", "quantification", "catalog", "links", "report")

#: Left out of a configuration's digest: they do not change results.
VOLATILE = frozenset({"generated_at_utc"})


def canonical(value: object) -> str:
    """JSON with sorted keys and without volatile ones."""

    def clean(v: object) -> object:
        if isinstance(v, Mapping):
            return {str(k): clean(x) for k, x in v.items() if k not in VOLATILE}
        return [clean(x) for x in v] if isinstance(v, (list, tuple)) else v

    return json.dumps(clean(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def semantic_digest(value: object) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def select_stages(first: str, last: str, stages: tuple[str, ...] = STAGES) -> tuple[str, ...]:
    """The stages from ``first`` to ``last``; fails on unknown names and on an empty range."""
    for name in (first, last):
        if name not in stages:
            raise ValueError(f"unknown stage {name!r}")
    a, b = stages.index(first), stages.index(last)
    if a > b:
        raise ValueError(f"{first} comes after {last}")
    return stages[a : b + 1]


class CheckpointError(RuntimeError):
    """A checkpoint is missing, or what it names has changed."""


@dataclass
class StageRunner:
    """Runs stage functions (spark, inputs, config) -> {table: DataFrame} and keeps their tables as Parquet with checkpoints."""

    spark: SparkSession
    root: str
    config: Mapping[str, object]
    functions: Mapping[str, Callable[[SparkSession, Mapping[str, DataFrame], Mapping[str, object]], Mapping[str, DataFrame]]]
    stages: tuple[str, ...] = STAGES
    loaded: dict[str, DataFrame] = field(default_factory=dict)

    def _checkpoint(self, stage: str):
        """The file system of ``root``, wherever that is, and the path of a stage's record in it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/checkpoints/{stage}.json")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _record(self, stage: str, record: Mapping[str, object]) -> None:
        """Put a stage's record in place in one step."""
        files, path = self._checkpoint(stage)
        made = path.suffix(".making")
        files.mkdirs(path.getParent())
        out = files.create(made, True)
        out.write(bytearray((json.dumps(record, indent=1, sort_keys=True) + "\n").encode()))
        out.close()
        files.delete(path, False)
        files.rename(made, path)

    def _table(self, stage: str, name: str) -> str:
        return f"{self.root}/{stage}/{name}"

    def load(self, stage: str, verify: bool = True) -> dict[str, DataFrame]:
        """Tables of a finished stage; fails if the configuration or the content is not that of the checkpoint."""
        files, path = self._checkpoint(stage)
        if not files.exists(path):
            raise CheckpointError(f"{stage} has no checkpoint")
        record = json.loads("\n".join(r[0] for r in self.spark.read.text(path.toString(), wholetext=True).collect()))
        if record["config"] != semantic_digest(self.config):
            raise CheckpointError(f"{stage} was made with another configuration")
        tables = {}
        for name, known in record["tables"].items():
            df = self.spark.read.parquet(self._table(stage, name))
            if verify and content_digest(df, sorted(df.columns)) != known:
                raise CheckpointError(f"{stage}: {name} has changed")
            tables[name] = df
        return tables

    def run(self, first: str, last: str) -> dict[str, DataFrame]:
        """Run the stages from first to last on the checkpoints of those before."""
        wanted = [s for s in select_stages(first, last, self.stages) if s in self.functions]
        for stage in self.stages[: self.stages.index(first)]:
            if stage in self.functions:
                self.loaded |= self.load(stage)
        for stage in wanted:
            made = self.functions[stage](self.spark, self.loaded, self.config)
            digests = {}
            for name, df in made.items():
                write_table(df, self._table(stage, name))
                back = self.spark.read.parquet(self._table(stage, name))
                digests[name] = content_digest(back, sorted(back.columns))
                self.loaded[name] = back
            self._record(stage, {"stage": stage, "config": semantic_digest(self.config), "tables": digests})
        return self.loaded


def manifest(paths: Mapping[str, str | Path]) -> list[tuple[str, str, str]]:
    """(name, path, sha256) of files, for handing results on."""
    return [(n, str(p), hashlib.sha256(Path(p).read_bytes()).hexdigest()) for n, p in sorted(paths.items())]


def verify_manifest(rows: list[tuple[str, str, str]]) -> None:
    for name, path, known in rows:
        if not Path(path).exists():
            raise CheckpointError(f"{name}: {path} is missing")
        if hashlib.sha256(Path(path).read_bytes()).hexdigest() != known:
            raise CheckpointError(f"{name}: {path} has changed")
