"""Runs in a shared folder: fitted model, score table and parameters of each model and mode, behind a manifest.

The manifest is written last, by one atomic rename, so a run that was cut off is never read as a whole one.
"""

from __future__ import annotations

import json
from importlib import import_module

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    target, files = _path(spark, f"{path}.part")
    out = files.create(target, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    final, _ = _path(spark, path)
    files.delete(final, False)
    if not files.rename(target, final):
        raise OSError(f"could not write {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    return "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())  # one small file


class RunStore:
    """One folder per model and mode (such as base, tuned or search) under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _manifest(self) -> dict:
        target, files = _path(self.spark, f"{self.root}/manifest.json")
        return json.loads(_read_text(self.spark, f"{self.root}/manifest.json")) if files.exists(target) else {}

    def save(self, name: str, mode: str, model: Model | None, scores: DataFrame, params: dict) -> None:
        """Write a run; a run of the same name and mode is replaced when the new one is whole."""
        manifest = self._manifest()
        known = manifest.get(f"{name}/{mode}", {}).get("version", 0)
        folder = f"{self.root}/{name}/{mode}/v{known + 1}"
        entry = {"version": known + 1, "folder": folder, "params": params}
        if model is not None:
            model.write().overwrite().save(f"{folder}/model")
            entry["class"] = f"{type(model).__module__}.{type(model).__qualname__}"
        scores.write.mode("overwrite").parquet(f"{folder}/scores")
        _write_text(self.spark, f"{folder}/params.json", json.dumps(params, sort_keys=True))
        manifest[f"{name}/{mode}"] = entry
        _write_text(self.spark, f"{self.root}/manifest.json", json.dumps(manifest, sort_keys=True))

    def runs(self) -> list[tuple[str, str]]:
        return sorted(tuple(key.split("/")) for key in self._manifest())

    def _entry(self, name: str, mode: str) -> dict:
        try:
            return self._manifest()[f"{name}/{mode}"]
        except KeyError:
            raise KeyError(f"no run {name}/{mode} in {self.root}") from None

    def model(self, name: str, mode: str) -> Model:
        entry = self._entry(name, mode)
        module, kind = entry["class"].rsplit(".", 1)
        return getattr(import_module(module), kind).load(f"{entry['folder']}/model")

    def scores(self, name: str, mode: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._entry(name, mode)['folder']}/scores")

    def params(self, name: str, mode: str) -> dict:
        return json.loads(_read_text(self.spark, f"{self._entry(name, mode)['folder']}/params.json"))
