"""Persona, profile and model stores."""

from tagloom.stores.buckets import BucketStore, ConcurrentUpdate
from tagloom.stores.models import ModelStore
from tagloom.stores.persona import IndexPersonaStore, SnapshotPersonaStore
from tagloom.stores.profiles import LogProfileStore, OrderProfileStore

__all__ = [
    "BucketStore",
    "ConcurrentUpdate",
    "IndexPersonaStore",
    "LogProfileStore",
    "ModelStore",
    "OrderProfileStore",
    "SnapshotPersonaStore",
]
