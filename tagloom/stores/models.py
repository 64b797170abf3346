"""Persisted k-means models."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import SparkSession

from tagloom.stores.buckets import ConcurrentUpdate
from tagloom.stores.hadoop import FileSystem


class ModelStore:
    """Named models under one folder, each with numbered versions.

    A model is saved in a folder of its own first; a small commit file then gives it the next
    number. A number is given once, so of two writers one is refused, and neither a
    half-written model nor a mixture of two is ever loaded. Old versions stay until
    ``drop_before``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._fs = FileSystem(spark, self.root)

    def _commit(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/_versions/{version:08d}"

    def path(self, name: str, version: int | None = None) -> str:
        """The folder of a version, by default of the latest. A model that was saved right
        under its name, without versions, is version 0."""
        version = self.latest(name) if version is None else version
        if version is None:
            raise LookupError(f"there is no model {name}")
        if version == 0:
            return f"{self.root}/{name}"
        if not self._fs.exists(self._commit(name, version)):
            raise LookupError(f"model {name} has no version {version}")
        return f"{self.root}/{name}/{self._fs.read_text(self._commit(name, version))}"

    def versions(self, name: str) -> list[int]:
        """Numbers of the versions that can be loaded, oldest first."""
        plain = [0] if self._fs.exists(f"{self.root}/{name}/metadata") else []
        return plain + [int(v) for v in self._fs.names(f"{self.root}/{name}/_versions") if v.isdigit()]

    def latest(self, name: str) -> int | None:
        return max(self.versions(name), default=None)

    def exists(self, name: str) -> bool:
        return self.latest(name) is not None

    def load(self, name: str, version: int | None = None) -> KMeansModel:
        return KMeansModel.load(self.path(name, version))

    def save(self, name: str, model: KMeansModel, after: int | None) -> int:
        """Save ``model`` as the version that follows ``after`` (``None``: the first one),
        and return its number. Raises ``ConcurrentUpdate`` if that version exists, as when
        another writer was faster; the store is then as that writer left it."""
        version = 1 if after is None else after + 1
        folder = f"model-{uuid.uuid4().hex}"
        model.write().save(f"{self.root}/{name}/{folder}")
        try:
            if self.latest(name) != after:
                raise FileExistsError
            self._fs.create_text(self._commit(name, version), folder)
        except Exception as cause:
            self._fs.delete(f"{self.root}/{name}/{folder}")
            if self.latest(name) == after:
                raise
            raise ConcurrentUpdate(f"model {name} has version {self.latest(name)} since another writer's save") from cause
        return version

    def refit(self, name: str, fit: Callable[[], KMeansModel]) -> KMeansModel:
        """Fit anew and save the model as the next version. Raises ``ConcurrentUpdate`` if
        another version was saved since the fit began."""
        before = self.latest(name)
        model = fit()
        self.save(name, model, before)
        return model

    def fit_or_load(self, name: str, fit: Callable[[], KMeansModel]) -> KMeansModel:
        """Load the latest version if there is one, else fit and save the first. If another
        run saved one meanwhile, that one is loaded."""
        if self.exists(name):
            return self.load(name)
        try:
            return self.refit(name, fit)
        except ConcurrentUpdate:
            return self.load(name)

    def drop_before(self, name: str, version: int) -> None:
        """Delete the versions before ``version``. The latest one always stays."""
        for old in self.versions(name):
            if 0 < old < min(version, self.latest(name)):
                folder = self.path(name, old)
                self._fs.delete(self._commit(name, old))
                self._fs.delete(folder)
