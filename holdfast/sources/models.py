"""Fitted models and their manifests, stored in versions.

A version is a folder of its own, with the model and its manifest. It counts once the file `current` names it, which is
replaced in one step, so a reader gets a model and a manifest that belong together, during a save and after one
that failed halfway. Where renaming a file is no single step (some object stores) closing a new one is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from holdfast.operators.encoding import Feature, manifest_frame, read_manifest
from holdfast.operators.trees import TreeModel, from_nodes, node_table
from holdfast.runtime import publish, read_bytes, remove

CURRENT = "current"


@dataclass(frozen=True)
class StoredModel:
    model: PipelineModel | TreeModel
    features: Sequence[Feature]


def save_model(spark: SparkSession, stored: StoredModel, path: str, keep_older: bool = True) -> str:
    """Store a new version below `path` and make it the current one; gives its name. With `keep_older` false the
    version that was current is removed, which readers that hold it open may still need."""
    version, older = uuid.uuid4().hex, read_bytes(spark, f"{path}/{CURRENT}")
    folder = f"{path}/versions/{version}"
    about = {"version": version, "kind": "pipeline"}
    if isinstance(stored.model, TreeModel):
        about |= {"kind": "trees", "base": stored.model.base, "link": stored.model.link}
        node_table(spark, stored.model).coalesce(1).write.parquet(f"{folder}/nodes")
    else:
        stored.model.write().save(f"{folder}/model")
    manifest_frame(spark, stored.features).coalesce(1).write.parquet(f"{folder}/manifest")
    publish(spark, f"{path}/{CURRENT}", json.dumps(about).encode())
    if older and not keep_older:
        remove(spark, f"{path}/versions/{json.loads(older)['version']}")
    return version


def load_model(spark: SparkSession, path: str) -> StoredModel:
    """The current version."""
    current = read_bytes(spark, f"{path}/{CURRENT}")
    if current is None:
        raise FileNotFoundError(f"no model below {path}")
    about = json.loads(current)
    folder = f"{path}/versions/{about['version']}"
    features = read_manifest(spark.read.parquet(f"{folder}/manifest"))
    if about["kind"] == "trees":
        return StoredModel(from_nodes(spark.read.parquet(f"{folder}/nodes").collect(), about["base"], about["link"]), features)
    return StoredModel(PipelineModel.load(f"{folder}/model"), features)
